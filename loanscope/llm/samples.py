"""A bounded sample of labelled documents for fitting a classifier."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def held_out(key: Column) -> Column:
    """Whether a document's label may not be learnt from: crc32 of its identifier as text is divisible by 5."""
    return F.coalesce(F.crc32(F.encode(key.cast("string"), "UTF-8")) % 5 == 0, F.lit(False))


def labelled(labels: DataFrame, target: str, key: str = "doc_id") -> DataFrame:
    """(doc_id, label) that may be learnt from; of several labels of a document the smallest counts."""
    rows = labels.select(F.col(key).alias("doc_id"), F.col(target).cast("int").alias("label"))
    rows = rows.filter("doc_id is not null and label in (0, 1)").filter(~held_out(F.col("doc_id")))
    return rows.groupBy("doc_id").agg(F.min("label").alias("label"))


def sample(docs: DataFrame, known: DataFrame, most: dict[int, int], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, label, text) of at most most[label] labelled documents of each label, by order of a hash.

    The identifiers are a bounded table, so they go to the documents and not the other way round.
    """
    taken = reduce(
        DataFrame.unionAll,
        (known.filter(F.col("label") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for v, n in most.items()),
    )
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.join(F.broadcast(taken), "doc_id").select("doc_id", "label", "text")
