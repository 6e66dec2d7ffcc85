"""Ordered CSV exports with one status row each."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from loanscope.plans import marts, reports, staging
from loanscope.sources.derived import RawTables
from loanscope.sources.files import CSV_OPTIONS

STATUS_SCHEMA = "export string, status string, rows bigint, error string"


@dataclass(frozen=True)
class Export:
    name: str
    build: Callable[[RawTables], DataFrame]
    order: tuple[str, ...] = ()
    # The keys may repeat: rows with equal keys are also spread over several sort
    # ranges, by their position in the scan.
    repeated_keys: bool = False


EXPORTS = (
    Export("mart_portfolio_performance", marts.portfolio_performance, ("snapshot_date",)),
    Export("mart_credit_vs_nps", marts.credit_vs_nps, ("loan_id",)),
    Export("mart_cohort_analysis", marts.cohort_analysis,
           ("cohort_quarter", "snapshot_date", "cohort_age_quarters")),
    Export("stg_customers", lambda raw: staging.customers(raw.customer_sales), ("loan_id",), True),
    Export("SUMMARY", reports.summary_metrics),
)


def ordered(df: DataFrame, export: Export) -> DataFrame:
    keys = [F.asc_nulls_last(name) for name in export.order]
    if not keys:
        return df
    if not export.repeated_keys:
        return df.orderBy(*keys)
    return df.withColumn("_position", F.monotonically_increasing_id()).orderBy(*keys, "_position").drop("_position")


def write_csv(df: DataFrame, path: str) -> int:
    """Write part files with headers, in order; rows are counted while writing."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)
    return seen.get["rows"]


def export_all(
    spark: SparkSession, raw: RawTables, out_dir: str, exports=EXPORTS, places: dict[str, str] | None = None,
) -> DataFrame:
    """Run every export; one that fails is reported as skipped and the rest go on.

    An export goes to ``<name>.csv`` below the folder, or to its own place.
    """
    status, places = [], places or {}
    for export in exports:
        try:
            rows = write_csv(ordered(export.build(raw), export), places.get(export.name, f"{out_dir}/{export.name}.csv"))
            status.append((export.name, "OK", rows, None))
        except Exception as error:  # whatever fails in one export, the others still run
            status.append((export.name, "SKIP", None, f"{type(error).__name__}: {error}"))
    return spark.createDataFrame(status, STATUS_SCHEMA)
