"""Declared column checks and coverage counts. Checks report failures, they never abort."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from loanscope.operators import joins
from loanscope.operators.shares import with_percentages
from loanscope.plans import staging
from loanscope.plans.staging import KEY
from loanscope.sinks import tables
from loanscope.sources.derived import RawTables

# The declared checks.
NOT_NULL = {
    "stg_credit_snapshots": ("loan_id", "snapshot_date"),
    "stg_customers": ("loan_id",),
    "stg_nps": ("loan_id", "nps_score", "nps_category"),
}
UNIQUE = {"stg_customers": ("loan_id",)}
ACCEPTED = {
    "stg_nps": {
        "nps_score": tuple(range(11)),
        "nps_category": ("Promoter", "Passive", "Detractor"),
    },
}


#: One check result: kind of check, model, column, failing rows.
RESULTS = "check string, model string, column_name string, failing_rows bigint"


class Watch:
    """The declared column checks of a model, counted in the pass that stores it.

    ``over`` gives the rows to store; ``rows`` has the counts once that one write has ended. Use it right
    before the write: after a shuffle rows of a repeated task would count again.
    """

    def __init__(self, model: str):
        self.model, self.seen = model, Observation()

    def checks(self) -> list[tuple[str, str]]:
        """Kind and column of each check, in the order of the counts."""
        return [(check, column) for check, column, _ in self._rules()]

    def _rules(self) -> list[tuple[str, str, Column]]:
        nulls = [("not_null", c, F.col(c).isNull()) for c in NOT_NULL.get(self.model, ())]
        return nulls + [("accepted_values", c, ~F.col(c).isin(*values)) for c, values in ACCEPTED.get(self.model, {}).items()]

    def over(self, df: DataFrame) -> DataFrame:
        return df.observe(self.seen, *(F.count_if(fails).alias(f"c{n}") for n, (_, _, fails) in enumerate(self._rules())))

    def rows(self) -> list[tuple[str, str, str, int]]:
        found = self.seen.get
        return [(check, self.model, column, found[f"c{n}"]) for n, (check, column) in enumerate(self.checks())]


def store(df: DataFrame, model: str, path: str) -> tuple[DataFrame, list[tuple[str, str, str, int]]]:
    """Replace the stored model; returns it as read back, and the results of its column checks."""
    watch = Watch(model)
    return tables.replace_table(watch.over(df), path), watch.rows()


def results(spark: SparkSession, rows: list[tuple[str, str, str, int]], check: str) -> DataFrame:
    """Results of one kind of check, a row per model and column."""
    found = spark.createDataFrame(rows, RESULTS).where(F.col("check") == check)
    return found.select("model", "column_name", "failing_rows")


def staged(raw: RawTables) -> dict[str, DataFrame]:
    return {
        "stg_credit_snapshots": staging.credit_snapshots(raw.credit_data),
        "stg_customers": staging.customers(raw.customer_sales),
        "stg_nps": staging.survey(raw.nps_data),
    }


def _as_rows(model: str, aggregated: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    long = aggregated.unpivot([], list(columns), "column_name", "failing_rows")
    return long.select(F.lit(model).alias("model"), "column_name", "failing_rows")


def not_null(raw: RawTables, checks: dict[str, tuple[str, ...]] = NOT_NULL) -> DataFrame:
    """NULLs per checked column; all columns of a model are counted in one pass."""
    models = staged(raw)
    counted = [
        _as_rows(model, models[model].agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns)), columns)
        for model, columns in checks.items()
    ]
    return reduce(DataFrame.unionAll, counted)


def unique(raw: RawTables, checks: dict[str, tuple[str, ...]] = UNIQUE, stored: dict[str, DataFrame] | None = None) -> DataFrame:
    """Number of values that occur more than once, per checked column; of a stored model only that column is read."""
    models = staged(raw) | (stored or {})
    counted = []
    for model, columns in checks.items():
        for column in columns:
            sizes = models[model].where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
            repeated = sizes.agg(F.count_if(F.col("n") > 1).alias(column))
            counted.append(_as_rows(model, repeated, (column,)))
    return reduce(DataFrame.unionAll, counted)


def accepted_values(raw: RawTables, checks: dict[str, dict[str, tuple]] = ACCEPTED) -> DataFrame:
    """Rows holding a value outside the accepted list (NULL is not judged)."""
    models = staged(raw)
    counted = [
        _as_rows(
            model,
            models[model].agg(*(F.count_if(~F.col(c).isin(*values)).alias(c) for c, values in columns.items())),
            tuple(columns),
        )
        for model, columns in checks.items()
    ]
    return reduce(DataFrame.unionAll, counted)


def staging_counts(raw: RawTables) -> DataFrame:
    customers = staging.customers(raw.customer_sales).agg(F.count(F.lit(1)).alias("stg_customers_rows"))
    presence = joins.key_presence(staging.demographic_sides(raw), KEY)
    ids = presence.agg(F.count(F.lit(1)).alias("n"))
    return customers.select("stg_customers_rows", ids.scalar().alias("demographics_unique_loans"))


def demographic_coverage(raw: RawTables) -> DataFrame:
    """Loans with demographics, and how many have a birth date, gender and monthly income."""
    sides = staging.demographic_sides(raw)
    filled = {"dob": "date_of_birth", "gender": "gender", "income": "avg_monthly_income"}
    present = {f"with_{name}": sides[name].where(F.col(column).isNotNull()) for name, column in filled.items()}
    presence = joins.key_presence({**sides, **present}, KEY)
    counts = presence.agg(
        F.count(F.lit(1)).alias("total_unique_loans"),
        *(F.count_if(F.col(f"has_{name}")).alias(name) for name in present),
    )
    return with_percentages(counts, "total_unique_loans", {name: f"{name}_pct" for name in present})


def union_stats(raw: RawTables) -> DataFrame:
    """Rows, loans, snapshots and date range of the unioned facts.

    Two narrow scans instead of one that copies every row per distinct count.
    """
    facts = staging.credit_snapshots(raw.credit_data)
    loans = facts.agg(F.countDistinct(KEY).alias("n"))
    by_date = facts.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("n"))
    return by_date.agg(
        F.sum("n").alias("total_rows"),
        F.count("snapshot_date").alias("snapshot_dates"),
        F.min("snapshot_date").alias("earliest_snapshot"),
        F.max("snapshot_date").alias("latest_snapshot"),
    ).select("*", loans.scalar().alias("unique_loans"))


def snapshot_breakdown(raw: RawTables) -> DataFrame:
    facts = staging.credit_snapshots(raw.credit_data)
    return facts.groupBy("snapshot_date").agg(
        F.countDistinct(KEY).alias("unique_loans"), F.count(F.lit(1)).alias("total_records")
    ).orderBy(F.asc_nulls_last("snapshot_date"))
