"""Stored tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Folder of the pointer files of a table that is replaced as one act.
POINTERS = "current"


def save_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Replace the table at ``path`` and return it as read back."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Replace the table at ``path`` as one act, and return it as read back.

    Rows go to a new version folder; a pointer file, which Spark makes visible
    only when its job has ended, then names it. Until then, and for good if
    anything fails before, readers get the rows of the last version, and ``df``
    itself may read them. Old versions are kept.
    """
    last = current_version(df.sparkSession, path)
    number = int(last.split("-")[0]) + 1 if last else 1
    version = f"{number:012d}-{uuid.uuid4().hex[:8]}"
    df.write.mode("errorifexists").partitionBy(*partition_by).parquet(f"{path}/versions/{version}")
    pointer = df.sparkSession.createDataFrame([(version,)], "value string").coalesce(1)
    pointer.write.mode("append").text(f"{path}/{POINTERS}")
    return current_table(df.sparkSession, path)


def current_version(spark: SparkSession, path: str) -> str | None:
    """The version that the newest pointer names, None before the first."""
    try:
        return spark.read.text(f"{path}/{POINTERS}").agg(F.max("value")).first()[0]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def current_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(version_path(spark, path))


def version_path(spark: SparkSession, path: str) -> str:
    version = current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"no table at {path}")
    return f"{path}/versions/{version}"


def load_once(spark: SparkSession, name: str, df: DataFrame, path: str | None = None) -> bool:
    """Create a catalog table unless one of that name exists; True if it was created."""
    if spark.catalog.tableExists(name):
        return False
    writer = df.write.mode("errorifexists").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return True


def name_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Make the Parquet table at ``path`` known to the catalog under ``name``, or point a known name to it."""
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source="parquet")
    else:
        spark.sql(f"alter table {name} set location '{path}'")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def stored_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, None if there is none; a folder without data, as a failed first attempt leaves it, counts as none."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def store_once(spark: SparkSession, build: Callable[[], DataFrame], path: str, name: str | None = None) -> DataFrame:
    """The table at ``path``, built and stored if there is none yet; also a catalog table if it gets a name."""
    stored = stored_table(spark, path)
    if stored is None:
        stored = save_parquet(build(), path)
    return name_table(spark, name, path) if name else stored
