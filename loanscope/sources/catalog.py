"""Tables known to the session catalog."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from loanscope.sources import schemas
from loanscope.sources.files import TABLE_PREFIX


def table_names(spark: SparkSession, prefix: str = "") -> list[str]:
    """Names in order. The prefix is literal: '_' stands for itself only."""
    return sorted(table.name for table in spark.catalog.listTables() if table.name.startswith(prefix))


def snapshot_tables(spark: SparkSession) -> list[str]:
    return table_names(spark, TABLE_PREFIX)


def row_counts(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """(table_name, row_count) of the named tables, counted in one job."""
    if not names:
        return spark.createDataFrame([], "table_name string, row_count bigint")
    counts = [
        spark.table(name).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name in names
    ]
    return reduce(DataFrame.unionAll, counts)


def union_snapshots(spark: SparkSession, names: Sequence[str] | None = None) -> DataFrame:
    """Raw facts of all snapshot tables, duplicates kept."""
    names = snapshot_tables(spark) if names is None else names
    if not names:
        return spark.createDataFrame([], schemas.CREDIT)
    columns = schemas.CREDIT.fieldNames()
    return reduce(DataFrame.unionByName, (spark.table(name).select(*columns) for name in names))
