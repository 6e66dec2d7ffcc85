"""Session settings the plans rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime settings only; sizes (memory, shuffle partitions) belong to the cluster.
RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even where a later join on the same key then
    # needs a shuffle of its own: the loan-keyed joins here come in chains.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Cells that don't fit their type are errors, not NULLs.
    "spark.sql.ansi.enabled": "true",
    # Rows of thirty typed columns make methods that the JVM only interprets; above this size operators get their own.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A task meets few snapshot dates, so it keeps their files open and does not sort its rows by them.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
}


def configure(spark: SparkSession) -> SparkSession:
    for name, value in RUNTIME.items():
        spark.conf.set(name, value)
    return spark
