"""What the operators share: written tables, a Bloom filter of fixed size, and dropping rows without moving texts."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Bits of a Bloom filter at least and at most (1 and 16 MB), and per key in between. Beyond 8 million keys more rows pass.
BLOOM_LEAST, BLOOM_MOST, BLOOM_PER_KEY = 1 << 23, 1 << 27, 16
#: Bytes of text in an Arrow batch that a task hands back.
OUT_BYTES = 4 << 20

#: Rows of an Arrow batch unless the session says otherwise: whole texts are long, and a batch is held in memory.
BATCH_ROWS = 500
#: Bytes of an Arrow batch unless the session says otherwise; a row longer than that is a batch of its own.
BATCH_BYTES = 4 << 20

_local: dict[str, str] = {}


def tuned(spark: SparkSession) -> SparkSession:
    """The session, with smaller Arrow batches if it still has Spark's default of 10,000 rows and 64 MB."""
    for name, default, value in (("maxRecordsPerBatch", "10000", BATCH_ROWS), ("maxBytesPerBatch", "67108864b", f"{BATCH_BYTES}b")):
        name = f"spark.sql.execution.arrow.{name}"
        if spark.conf.get(name, None) in (None, default):  # Spark 4.1 gives None for what nobody has set
            spark.conf.set(name, value)
    return spark


def hand_back() -> None:
    """Give freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the GNU C library has it
    if trim:
        trim(0)


def lean(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The task, handing its memory back to the system at its end: workers live on and serve other stages."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(source)
        finally:
            hand_back()

    return run


def folder(spark: SparkSession) -> str:
    """A fresh path below ``spark.checkpoint.dir``; only a local session may go without that setting."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        name = spark.sparkContext.applicationId
        root = _local.get(name) or _local.setdefault(name, tempfile.mkdtemp(prefix="llm-"))
    return f"{root}/llm-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """The same rows from a table in the shared folder, so that nothing before it runs again."""
    path = folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole(text: str | Column) -> Column:
    """A text column as string, a null as an empty text."""
    return F.coalesce((F.col(text) if isinstance(text, str) else text).cast("string"), F.lit(""))


def repeated(df: DataFrame, times: str, nth: str, run: int = 4096) -> DataFrame:
    """Each row as often as its column `times` says, numbered from 0 in `nth`.

    Large multiplicities are cut into runs, which are dealt over all partitions before they are written out.
    """
    runs = df.withColumn("__llm_run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(times) - 1) / run).cast("long"))))
    many = runs.filter(F.col(times) > run)
    # a fixed number of partitions: the runs are few and small, but not what they become
    spread = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = runs.filter(F.col(times) <= run).unionAll(many.repartition(spread, *many.columns))
    first = F.col("__llm_run") * run
    last = F.least(first + run, F.col(times)) - 1
    return runs.withColumn(nth, F.explode(F.sequence(first, last))).drop("__llm_run", times)


def bloom(keys: DataFrame, stored: bool = False) -> Callable[[Column], Column]:
    """A test for the 64-bit hashes in the only column of `keys`: false means surely absent.

    The filter's size follows the number of keys up to a ceiling; it is built by a distributed aggregate over its words.
    stored: whether reading the keys twice is cheap, as they come from a written table.
    """
    (key,) = keys.columns
    keys = keys if stored else written(keys)
    bits = min(max(BLOOM_LEAST, 1 << (BLOOM_PER_KEY * keys.count()).bit_length()), BLOOM_MOST)
    at = F.explode(F.array(*(F.shiftrightunsigned(key, n).bitwiseAND(F.lit(bits - 1)) for n in (0, 32))))
    words = (
        keys.select(at.alias("at"))
        .groupBy(F.shiftright("at", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits"))
        .toArrow()
    )
    table = np.zeros(bits >> 6, np.int64)
    table[words["word"].to_numpy()] = words["bits"].to_numpy()
    shared = keys.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("boolean")
    def holds(h: pd.Series) -> pd.Series:
        return pd.Series(in_bloom(shared.value, h.to_numpy(np.int64).view(np.uint64)))

    holds.table = shared
    return holds


def in_bloom(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which of the hashes a filter's table may hold."""
    out, last = np.ones(len(h), bool), np.uint64(64 * len(table) - 1)
    for n in (0, 32):
        at = (h >> np.uint64(n)) & last
        out &= (table[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)).astype(np.int64)) & 1 == 1
    return out


def split_by_ids(docs: DataFrame, ids: DataFrame, key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """The rows whose key is not in `ids` (one column), and those whose key is.

    Only rows that pass the Bloom filter are shuffled for the exact join; the texts of all others stay where they are.
    """
    ids = ids.toDF("__llm_id").distinct()
    holds = bloom(ids.select(F.xxhash64(F.col("__llm_id").cast("long")).alias("h")))
    mine = F.col(key).cast("long")
    marked = docs.withColumn("__llm_maybe", holds(F.xxhash64(mine)))
    maybe = marked.filter("__llm_maybe").drop("__llm_maybe")
    same = mine.eqNullSafe(F.col("__llm_id"))
    rest = marked.filter("not __llm_maybe").drop("__llm_maybe").unionAll(maybe.join(ids, same, "left_anti"))
    return rest, maybe.join(ids, same, "left_semi")


def row_hash(text: str) -> Column:
    """What tells rows of one identifier apart."""
    return F.xxhash64(whole(text))


def without_rows(docs: DataFrame, verdicts: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` without the rows named in `verdicts` (doc_id, content, stays: one row for each identifier and row_hash).

    Of equal rows that are named and stay, one does. Only rows that pass a filter of bounded size are shuffled.
    """
    verdicts = written(verdicts.select(F.col("doc_id").alias("__llm_id"), F.col("content").alias("__llm_content"), F.col("stays").alias("__llm_stays")))
    holds = bloom(verdicts.select(F.xxhash64("__llm_id", "__llm_content").alias("h")))
    marked = docs.withColumns({"__llm_own": F.col(key).cast("long"), "__llm_text": row_hash(text)})
    marked = marked.withColumn("__llm_maybe", holds(F.xxhash64("__llm_own", "__llm_text")))
    maybe = marked.filter("__llm_maybe")
    same = F.col("__llm_own").eqNullSafe(F.col("__llm_id")) & (F.col("__llm_text") == F.col("__llm_content"))
    found = maybe.join(verdicts, same, "left")
    one = found.filter("__llm_stays").dropDuplicates(["__llm_own", "__llm_text"])
    parts = (marked.filter("not __llm_maybe"), found.filter("__llm_content is null"), one)
    return reduce(DataFrame.unionAll, (part.select(*docs.columns) for part in parts))


def batches(rows: Iterator[tuple], schema: pa.Schema, size: Callable[[tuple], int] = lambda _: 64, most: int = OUT_BYTES) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of about `most` bytes."""
    held, held_bytes = [], 0
    for row in rows:
        held.append(row)
        held_bytes += size(row)
        if held_bytes >= most:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, held_bytes = [], 0
    if held:
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
