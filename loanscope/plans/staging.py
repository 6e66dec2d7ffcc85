"""Cleaned and renamed inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from loanscope.functions import bands, cleaning, money
from loanscope.operators import joins
from loanscope.sources import schemas
from loanscope.sources.derived import RawTables

KEY = "loan_id"


def credit_snapshots(raw: DataFrame, *extra: str, lenient_dates: bool = False) -> DataFrame:
    """Loan × snapshot facts. The snapshot date is the one in the rows, not in the file name.

    Rows that were conformed before they were stored pass through.
    """
    if "snapshot_date" in raw.columns:
        return raw

    kept = raw.select(*schemas.CREDIT.fieldNames(), *extra)
    dated = cleaning.with_us_dates(kept, schemas.CREDIT_DATES, schemas.CREDIT_OPTIONAL_DATES, lenient_dates)
    return dated.withColumnsRenamed(schemas.CREDIT_RENAMES)


def latest_snapshot(facts: DataFrame) -> Column:
    """Newest snapshot date as a scalar subquery; it is evaluated once, inside the query."""
    return facts.agg(F.max("snapshot_date").alias("latest")).scalar()


def at_latest_snapshot(facts: DataFrame) -> DataFrame:
    return facts.where(F.col("snapshot_date") == latest_snapshot(facts))


def _select_renamed(raw: DataFrame, schema, renames: dict[str, str]) -> DataFrame:
    return raw.select(*(f"`{name}`" for name in schema.fieldNames())).withColumnsRenamed(renames)


def customers(raw: DataFrame) -> DataFrame:
    """Sales with a usable loan id. A loan may have several."""
    renamed = _select_renamed(raw, schemas.SALES, schemas.SALES_RENAMES)
    return renamed.where(cleaning.is_valid_id(F.col(KEY))).withColumns({
        "sale_date": F.col("sale_date").cast("date"),
        "return_date": cleaning.cell_to_date(F.col("return_date")),
    })


def births(raw: DataFrame) -> DataFrame:
    # This sheet's id header ends with a blank.
    renamed = raw.select(
        F.col("`Loan Id `").alias(KEY), F.col("date_of_birth").cast("date").alias("date_of_birth")
    )
    return renamed.where(cleaning.is_valid_id(F.col(KEY)))


def genders(raw: DataFrame) -> DataFrame:
    renamed = raw.select(
        F.col("`Loan Id`").alias(KEY),
        cleaning.standard_citizenship(F.col("citizenship")).alias("citizenship"),
        cleaning.standard_gender(F.col("gender")).alias("gender"),
    )
    return renamed.where(cleaning.is_valid_id(F.col(KEY)))


def incomes(raw: DataFrame) -> DataFrame:
    renamed = _select_renamed(raw, schemas.INCOME, schemas.INCOME_RENAMES)
    valid = renamed.where(cleaning.is_valid_id(F.col(KEY)))
    with_total = valid.withColumn("total_income", money.total_income(*map(F.col, schemas.INCOME_PARTS)))
    return with_total.withColumn(
        "avg_monthly_income", money.monthly_income(F.col("total_income"), F.col("duration"))
    )


def demographic_sides(raw: RawTables) -> dict[str, DataFrame]:
    return {
        "dob": births(raw.customer_dob),
        "gender": genders(raw.customer_gender),
        "income": incomes(raw.customer_income),
    }


def demographics(raw: RawTables) -> DataFrame:
    """Birth, gender and income records of a loan, fully outer joined; loans may repeat."""
    joined = joins.full_join(demographic_sides(raw), KEY)
    # A loan without an income record has a total of 0, but no monthly income.
    return joined.withColumn("total_income", F.coalesce("total_income", F.lit(0.0))).select(
        KEY, "date_of_birth", "citizenship", "gender", "duration", *schemas.INCOME_PARTS,
        "total_income", "avg_monthly_income",
    )


def survey(raw: DataFrame) -> DataFrame:
    """Survey responses with a loan id and the category of their score."""
    renamed = _select_renamed(raw, schemas.SURVEY, schemas.SURVEY_RENAMES)
    return renamed.where(F.col(KEY).isNotNull()).withColumns({
        "submitted_at": F.col("submitted_at").cast("timestamp_ntz"),
        "nps_category": bands.nps_category(F.col("nps_score")),
    })
