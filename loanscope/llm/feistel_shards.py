"""Sharding by a Feistel permutation with cycle walking over global row numbers, in DataFrame functions only.

Rows are numbered 0 to N - 1 (by hash bucket, then identifier, size and checksum), a keyed Feistel network permutes the
numbers, and position p goes to slot p div k of shard p mod k: a reproducible shuffle whose shard counts differ by one
at most, and whose every position can be computed, and inverted, without a look at other rows. The network works on
pairs (x, y) with x < a, y < b and a * b >= N as small as that goes; what lands at N or above walks on along its cycle.

Numbering needs no global sort: rows are counted per hash bucket, and the offset of a bucket (one row each, a fixed
number of them) is added to the number within. Equal rows are counted before they are shuffled; many of them are dealt
over all partitions in runs before each gets its number. Documents are read once.

A null text has size 8 and the checksum of an empty text; a null identifier is a value of its own. Repeated rows have
places of their own. An empty table gives no rows. `rows` is the law that holds, so grown_shard is null.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from loanscope.llm.shared import repeated, whole, written

BUCKETS = 4096
ROUNDS = 6
#: Steps that a walk may take; each lands outside with a chance below 1 / sqrt(N), and no walk visits a number twice.
WALK = 64


def sides(n: int) -> tuple[int, int]:
    """The two moduli of the network for n numbers."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def _round(x: Column, y: Column, r: int, seed: int, a: int, b: int) -> tuple[Column, Column]:
    """Even rounds add a function of y to x modulo a, odd ones a function of x to y modulo b."""
    if r % 2 == 0:
        return F.pmod(x + F.pmod(F.xxhash64(F.lit(seed * 64 + r), y), F.lit(a)), F.lit(a)), y
    return x, F.pmod(y + F.pmod(F.xxhash64(F.lit(seed * 64 + r), x), F.lit(b)), F.lit(b))


def _unround(x: Column, y: Column, r: int, seed: int, a: int, b: int) -> tuple[Column, Column]:
    if r % 2 == 0:
        return F.pmod(x - F.pmod(F.xxhash64(F.lit(seed * 64 + r), y), F.lit(a)), F.lit(a)), y
    return x, F.pmod(y - F.pmod(F.xxhash64(F.lit(seed * 64 + r), x), F.lit(b)), F.lit(b))


def _once(df: DataFrame, column: str, n: int, seed: int, back: bool) -> DataFrame:
    """One pass of the network over `column`; a step per projection keeps each expression small."""
    a, b = sides(n)
    df = df.withColumns({"_x": F.col(column) % F.lit(a), "_y": F.floor(F.col(column) / F.lit(a)).cast("long")})
    for r in reversed(range(ROUNDS)) if back else range(ROUNDS):
        x, y = (_unround if back else _round)(F.col("_x"), F.col("_y"), r, seed, a, b)
        df = df.withColumns({"_x": x, "_y": y})
    return df.withColumn(column, F.col("_x") + F.col("_y") * F.lit(a)).drop("_x", "_y")


def _walked(p: Column, n: int, seed: int, back: bool) -> Column:
    """Walk on from p while it is outside; a fold of WALK steps that stand still once inside."""
    a, b = sides(n)

    def step(p: Column, _: Column) -> Column:
        x, y = p % F.lit(a), F.floor(p / F.lit(a)).cast("long")
        state = F.struct(x.alias("x"), y.alias("y"))
        moves = F.array(*(F.lit(r) for r in (reversed(range(ROUNDS)) if back else range(ROUNDS))))

        def move(s: Column, r: Column) -> Column:
            out = s
            for k in range(ROUNDS):
                mx, my = (_unround if back else _round)(s["x"], s["y"], k, seed, a, b)
                out = F.when(r == k, F.struct(mx.alias("x"), my.alias("y"))).otherwise(out)
            return out

        onward = F.aggregate(moves, state, move, lambda s: s["x"] + s["y"] * F.lit(a))
        return F.when(p < n, p).otherwise(onward)

    far = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), p, step)
    inside = F.when(far < n, far).otherwise(F.raise_error(F.lit("a walk took too many steps; choose another seed")).cast("long"))
    return F.when(p < n, p).otherwise(inside)


def permuted(df: DataFrame, column: str, n: int, seed: int = 1, back: bool = False) -> DataFrame:
    """`column`, numbers 0 to n - 1, replaced by their places in the shuffle (`back`: by the numbers of the places)."""
    return _once(df, column, n, seed, back).withColumn(column, _walked(F.col(column), n, seed, back)) if n else df


def numbered(rows: DataFrame, columns: list[str]) -> tuple[DataFrame, int]:
    """`columns` of all rows with a reproducible `number` from 0 to n - 1, and n."""
    kinds = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("repeats"))
    kinds = written(kinds.withColumn("bucket", F.pmod(F.xxhash64(*columns), F.lit(BUCKETS))))
    counts = kinds.groupBy("bucket").agg(F.sum("repeats").alias("rows"))
    # at most BUCKETS rows, whatever the input
    before = F.sum("rows").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("bucket", F.coalesce(before, F.lit(0)).alias("offset"), "rows")
    n = counts.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    within = F.sum("repeats").over(Window.partitionBy("bucket").orderBy(*columns))
    placed = kinds.withColumn("upto", within).join(F.broadcast(offsets.select("bucket", "offset")), "bucket")
    placed = placed.withColumn("first", F.col("offset") + F.col("upto") - F.col("repeats"))
    out = repeated(placed, "repeats", "nth").select(*columns, (F.col("first") + F.col("nth")).alias("number"))
    return out, n


def shards(docs: DataFrame, k: int = 24, key: str = "doc_id", text: str = "text", seed: int = 1) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row, and its number before the shuffle."""
    data = F.encode(whole(text), "UTF-8")
    rows = docs.select(F.col(key).alias("doc_id"), (F.octet_length(data) + 8).cast("long").alias("size"), F.crc32(data).alias("text_crc32"))
    rows, n = numbered(rows, ["doc_id", "size", "text_crc32"])
    placed = permuted(rows.withColumn("place", F.col("number")), "place", n, seed)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), (F.col("place") % k).cast("int").alias("shard"),
        F.floor(F.col("place") / k).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "number",
    )
