"""Identifier checks, sentinel handling and value standardisation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Texts that stand for "no value" in the raw extracts.
MISSING_DATE_TEXT = "None"
MISSING_CELL_DATE = "NaT"
INVALID_IDS = ("", "#N/A")
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Spellings folded into one label (compared trimmed, upper case).
GENDER_SPELLINGS = {"Male": ("M", "MALE"), "Female": ("F", "FEMALE")}
CITIZENSHIP_SPELLINGS = {"Kenyan": ("KENYAN", "CITIZEN")}


def is_valid_id(column: Column) -> Column:
    return column.isNotNull() & ~column.isin(*INVALID_IDS)


def na_to_null(column: Column) -> Column:
    """Text cell of an extract; every not-available token becomes NULL."""
    return F.when(~column.isin(*NA_TOKENS), column)


def _us_date(text: str) -> str:
    """SQL for ``m/d/yyyy`` text as a date, NULL for any other. The text is named once: each use is generated anew."""
    return f"try_to_date({text}, 'M/d/yyyy')"


def parse_optional_us_date(text: str, lenient: bool = False) -> Column:
    """``m/d/yyyy`` text (a SQL expression) as a date, 'None' as NULL; bad text is an error unless lenient."""
    if lenient:
        return F.expr(_us_date(text))
    bad = f"cast(raise_error(concat('bad date: ', {text})) as date)"
    return F.expr(f"if({text} is null or {text} = '{MISSING_DATE_TEXT}', null, coalesce({_us_date(text)}, {bad}))")


def with_us_dates(df: DataFrame, plain: Sequence[str], optional: Sequence[str] = (), lenient: bool = False) -> DataFrame:
    """Text columns of ``m/d/yyyy``, with or without leading zeros, as dates; in ``optional`` ones 'None' means NULL.

    Bad text is an error unless lenient. Each cell is parsed once, in a projection
    of its own; the next one only looks for cells that have text and no date.
    """
    names = [*plain, *optional]
    parsed = {f"_date_{name}": F.expr(_us_date(f"`{name}`")) for name in names}
    if lenient:
        return df.withColumns({name: parsed[f"_date_{name}"] for name in names})

    def checked(name: str) -> Column:
        missing = f"`{name}` is null" + (f" or `{name}` = '{MISSING_DATE_TEXT}'" if name in optional else "")
        bad = f"cast(raise_error(concat('bad date: ', `{name}`)) as date)"
        return F.expr(f"if(`_date_{name}` is not null or {missing}, `_date_{name}`, {bad})")

    return df.withColumns(parsed).withColumns({name: checked(name) for name in names}).drop(*parsed)


def cell_to_date(column: Column) -> Column:
    """A date cell that may hold a date, a timestamp or the text 'NaT'."""
    return F.nullif(column.cast("string"), F.lit(MISSING_CELL_DATE)).cast("date")


def nan_to_null(column: Column) -> Column:
    return F.nanvl(column.cast("double"), F.lit(None).cast("double"))


def standardise(column: Column, spellings: dict[str, tuple[str, ...]]) -> Column:
    """Known spellings become their label, any other value is kept as it came."""
    folded = F.upper(F.trim(column))
    labels = (F.when(folded.isin(*known), F.lit(label)) for label, known in spellings.items())
    return F.coalesce(*labels, column)


def standard_gender(column: Column) -> Column:
    return standardise(column, GENDER_SPELLINGS)


def standard_citizenship(column: Column) -> Column:
    return standardise(column, CITIZENSHIP_SPELLINGS)
