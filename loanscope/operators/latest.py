"""Top-1 per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def latest_per_key(df: DataFrame, key: str, *order: Column) -> DataFrame:
    """First row of every key in the given order.

    The ``<= 1`` filter lets Spark keep one row per key and map task before the
    shuffle, so a key with very many rows is never gathered whole.
    """
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.where(F.col("_rn") <= 1).drop("_rn")
