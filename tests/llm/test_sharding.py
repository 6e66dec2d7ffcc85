from __future__ import annotations

import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loanscope.llm import feistel_shards

ROWS = [(1, "a", 0), (2, None, 0), (3, "é" * 9, 0), (3, "é" * 9, 0), (None, "x", 0), (None, None, 0)] + [(9, "copy", 0)] * 50


def test_shards(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, shard int")
    rows = feistel_shards.shards(docs, k=7).collect()
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _ in ROWS)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == want
    slots = {s: sorted(r.slot for r in rows if r.shard == s) for s in range(7)}
    assert all(v == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    again = feistel_shards.shards(docs.repartition(3), k=7).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    assert {r.law for r in rows} == {"rows"} and {r.grown_shard for r in rows} == {None}


@pytest.mark.parametrize("n", [1, 2, 3, 24, 1000])
def test_permutation_and_inverse(spark, n):
    there = feistel_shards.permuted(spark.range(n).withColumn("p", F.col("id")), "p", n, seed=5)
    rows = feistel_shards.permuted(there.withColumn("q", F.col("p")), "q", n, seed=5, back=True).collect()
    assert sorted(r.p for r in rows) == list(range(n)) and all(r.q == r.id for r in rows)
    assert n < 24 or [r.p for r in sorted(rows)] != list(range(n))


def test_empty_table(spark):
    assert feistel_shards.shards(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_no_python_in_the_plan(spark, sf_dir, capsys):
    feistel_shards.shards(spark.read.parquet(f"{sf_dir}/documents.parquet")).explain()
    assert not any(w in capsys.readouterr().out for w in ("Python", "Arrow", "Pandas"))


def test_many_equal_rows_leave_several_tasks(spark):
    docs = spark.range(0, 300_000, 1, 4).select(F.lit(7).cast("long").alias("doc_id"), F.lit("copy").alias("text"))
    rows = feistel_shards.shards(docs, k=24).withColumn("place", F.spark_partition_id())
    sizes = [r["count"] for r in rows.groupBy("place").count().collect()]
    assert sum(sizes) == 300_000 and max(sizes) < 200_000
    assert rows.select("shard", "slot").distinct().count() == 300_000
