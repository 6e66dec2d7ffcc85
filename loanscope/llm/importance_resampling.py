"""Importance resampling towards a target corpus by hashed word n-grams, counted over concatenated batches.

A task joins the texts of a batch with separator sentinels and finds all words in one regular-expression pass over the
joined bytes. Word starts are looked up among the documents' offsets, so runs of words that cross from one document to
the next are masked; the rest are hashed to buckets and counted with one bincount. A run's checksum continues that of
the run one word shorter, so no run is ever put together.

Corpus and target counts per bucket give log-ratio gains (a table of `buckets` numbers, whatever the input). A document's
weight is the floored mean gain of its features, its score adds Gumbel noise that depends on its identifier alone, and
the highest scores are drawn. Scores are whole numbers within a fixed range (gains are logarithms of 64-bit counts), so
one count per score says where the draw ends and how many rows stand above each score; ranks need no sort of all rows.

A null text has no words, weight 0 and the score of its noise; a null identifier is hashed as an empty one and comes
last among ties. Repeated rows are rows of their own with ranks of their own. An empty target counts nothing in any
bucket, an empty corpus gives no rows. Only the named columns are read, whatever else the tables hold.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from loanscope.llm.shared import repeated, whole, written

BUCKETS = 10_000
#: Documents with fewer words are not drawn.
LEAST_WORDS = 20
#: One in so many of the documents that may be drawn.
PERCENT = 10
SEED = "2024"
#: Bytes of text joined at a time; a longer document is a batch of its own.
JOINED = 1 << 20

#: Bytes of words once A-Z are lower-cased; every byte of a character beyond ASCII counts.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Between documents; no word can hold it, and where a text holds it, it separates words there too.
_SENTINEL = b"\x00"


def joined(texts: Iterator[str], most: int = JOINED) -> Iterator[list[bytes]]:
    """Groups of lower-cased texts of about `most` bytes each."""
    held, size = [], 0
    for text in texts:
        held.append((text or "").encode("utf-8", "surrogatepass").translate(_LOWER))
        size += len(held[-1])
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def features(texts: list[bytes], most_words: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of the text, bucket) of every run of 1 to `most_words` words, and the words of each text."""
    buffer = _SENTINEL.join(texts)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    offsets = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    spans = np.fromiter(chain.from_iterable(m.span() for m in _WORD.finditer(buffer)), np.int64).reshape(-1, 2)
    words = [buffer[a:b] for a, b in spans.tolist()]
    owner = np.searchsorted(offsets, spans[:, 0], "right") - 1
    owners, hashes = [owner], [sums := list(map(crc32, words))]
    for n in range(2, most_words + 1):
        sums = [crc32(word, crc32(b" ", s)) for s, word in zip(sums, words[n - 1:])]
        same = owner[: len(sums)] == owner[n - 1:]
        owners.append(owner[: len(sums)][same])
        hashes.append(np.array(sums, np.uint32)[same])
    hashes = np.concatenate([np.asarray(h, np.uint32) for h in hashes])
    return np.concatenate(owners), hashes.astype(np.int64) % buckets, np.bincount(owner, minlength=len(texts))


def bucket_counts(docs: DataFrame, text: str, most_words: int, buckets: int) -> np.ndarray:
    """How many features of all texts fall in each bucket; each task hands back one table."""

    def count(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for texts in joined(v.as_py() for table in tables for v in table.column(0)):
            total += np.bincount(features(texts, most_words, buckets)[1], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    rows = docs.select(whole(text)).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for bucket, n in rows.collect():  # at most `buckets` rows
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(...)) of the smoothed shares of target and corpus in each bucket."""
    s, t, n = corpus.astype(float), target.astype(float), len(corpus)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def weighted(docs: DataFrame, table: np.ndarray, key: str, text: str, most_words: int) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            start = 0
            for texts in joined(v.as_py() for v in batch.column(1)):
                owner, bucket, words = features(texts, most_words, len(gain))
                n = np.bincount(owner, minlength=len(texts))
                # sums of whole numbers: exact in doubles
                total = np.bincount(owner, gain[bucket], minlength=len(texts)).astype(np.int64)
                yield pa.record_batch(
                    [batch.column(0).slice(start, len(texts)), pa.array(words), pa.array(n), pa.array(total // np.maximum(n, 1))],
                    ["doc_id", "n_words", "n_features", "weight"],
                )
                start += len(texts)

    rows = docs.select(F.col(key).alias("doc_id"), whole(text).alias("text"))
    return rows.mapInArrow(weigh, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_words long, n_features long, weight long")


def scored(rows: DataFrame, seed: str = SEED) -> DataFrame:
    """The rows with score: weight plus Gumbel noise of seed and identifier."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    share = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return rows.withColumn("score", F.col("weight") + F.floor(F.lit(-1000.0) * F.log(-F.log(share))).cast("long"))


def drawn(rows: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """The rows with rank: 1, 2, 3... for the floor(percent * N / 100) highest scores of the N rows with enough words."""
    spark, able = rows.sparkSession, F.col("n_words") >= least_words
    # one row per score: scores are whole numbers of a fixed range
    per_score = rows.filter(able).groupBy("score").count().collect()
    total = sum(n for _, n in per_score) * percent // 100
    above, before = 0, []
    for score, n in sorted(per_score, reverse=True):
        if above >= total:
            break
        before.append((score, above))
        above += n
    least = before[-1][0] if before else None
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    high = able & (F.col("score") >= F.lit(least)) if before else F.lit(False)
    out = rows.filter(~F.coalesce(high, F.lit(False))).select(*columns, F.lit(None).cast("long").alias("rank"))
    if not before:
        return out
    # equal rows become one row with a multiplicity before they are shuffled
    kinds = rows.filter(high).groupBy(*columns).agg(F.count(F.lit(1)).alias("repeats"))
    order = Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), "n_words", "n_features", "weight")
    upto = F.sum("repeats").over(order)
    kinds = kinds.join(spark.createDataFrame(before, "score long, above long"), "score")
    placed = repeated(kinds.withColumn("first", F.col("above") + upto - F.col("repeats") + 1), "repeats", "nth")
    place = F.col("first") + F.col("nth")
    return out.unionAll(placed.select(*columns, F.when(place <= total, place).alias("rank")))


def resampled(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text",
    most_words: int = 1, buckets: int = BUCKETS, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: str = SEED,
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank (null: not drawn) of every row of `docs`."""
    table = gains(bucket_counts(docs, text, most_words, buckets), bucket_counts(target, target_text, most_words, buckets))
    return drawn(written(scored(weighted(docs, table, key, text, most_words), seed)), percent, least_words)
