"""Outer equi joins that stay split when one key holds a large part of the rows.

Adaptive execution splits a hot partition only where a join reads both sides
straight from shuffles on the join key; in a chain of joins on one key, or below
a union or window, it does not. The joins here deal rows out themselves: the
number of rows of each key and side comes from one aggregate over the key
columns, combined map-side, which is stored: every join of a chain asks it. A key with
more than HOT_ROWS rows on a side has them dealt to several pieces by a hash of the row and
its place among equal ones, and the matching rows of the other side go to each of these pieces; all other keys have
one piece. Such joins run on (key, pieces), so a hot key never lands in one task, wherever the join stands. Without hot
keys a join is a plain one on the key, and a chain of them shuffles and sorts its rows once.

Outer joins are inner joins over sides that have first been completed with the
keys they miss, which the same aggregate tells. Rows are never dropped, so
many-to-many keys fan out exactly as in the plain outer join.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from loanscope.sources.scratch import scratch_dir


#: Rows of a key and side that one task may take.
HOT_ROWS = 1_000_000


def key_sizes(sides: Mapping[str, DataFrame], key: str) -> DataFrame:
    """One row per non-null key, with the number of rows ``n_<side>`` and a boolean ``has_<side>`` per side."""
    tagged = [
        df.select(key, *(F.lit(int(name == own)).cast("bigint").alias(f"n_{name}") for name in sides)).where(
            F.col(key).isNotNull()
        )
        for own, df in sides.items()
    ]
    sums = reduce(DataFrame.unionAll, tagged).groupBy(key).agg(*(F.sum(f"n_{name}").alias(f"n_{name}") for name in sides))
    return sums.select("*", *((F.col(f"n_{name}") > 0).alias(f"has_{name}") for name in sides))


def stored_sizes(sides: Mapping[str, DataFrame], key: str) -> DataFrame:
    """``key_sizes``, written once and read by every join that needs them."""
    sizes = key_sizes(sides, key)
    path = f"{scratch_dir(sizes.sparkSession)}/key_sizes"
    sizes.write.parquet(path)
    return sizes.sparkSession.read.schema(sizes.schema).parquet(path)


def key_presence(sides: Mapping[str, DataFrame], key: str) -> DataFrame:
    """One row per non-null key, with a boolean ``has_<side>`` per side."""
    return key_sizes(sides, key).select(key, *(f"has_{name}" for name in sides))


def rows_of(*sides: str) -> Column:
    """Rows per key of the join of some sides, each completed with the keys it misses."""
    return reduce(lambda a, b: a * b, (F.greatest(F.col(f"n_{name}"), F.lit(1)) for name in sides))


def split_join(left: DataFrame, right: DataFrame, key: str, sizes: DataFrame, left_rows: Column, right_rows: Column) -> DataFrame:
    """Inner join on a key whose rows per side ``sizes`` knows."""
    pieces = lambda rows: F.greatest(F.ceil(rows / F.lit(HOT_ROWS)), F.lit(1)).cast("int")
    found = sizes.select(key, pieces(left_rows).alias("_lefts"), pieces(right_rows).alias("_rights"))
    found = found.where("_lefts > 1 or _rights > 1")
    if not (few := found.collect()):  # at most one key per HOT_ROWS rows
        return left.join(right, key)
    hot = F.broadcast(sizes.sparkSession.createDataFrame(few, found.schema))

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        # Equal rows are told apart by their place among the rows of their partition in the order of a hash. They are
        # interchangeable, so a task that runs again deals out the same rows, in whatever order it met them.
        hashed = df.withColumn("_seed", F.xxhash64(*df.columns)).sortWithinPartitions("_seed")
        seeded = hashed.withColumn("_seed", F.xxhash64("_seed", F.monotonically_increasing_id()))
        mine = F.pmod("_seed", F.coalesce(f"_{own}s", F.lit(1))).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.coalesce(f"_{other}s", F.lit(1)) - 1))
        return seeded.join(hot, key, "left").select(*df.columns, mine.alias(f"_{own}"), every.alias(f"_{other}"))

    on = [key, "_left", "_right"]
    return dealt(left, "left", "right").join(dealt(right, "right", "left"), on).drop("_left", "_right")


def pad(side: DataFrame, presence: DataFrame, needed: Column, key: str, **values: Column) -> DataFrame:
    """Add one row per needed key; its other columns are NULL unless given in ``values``."""
    missing = presence.where(needed).select(key, *(v.alias(name) for name, v in values.items()))
    return side.unionByName(missing, allowMissingColumns=True)


def full_join(sides: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Full outer join of several sides on one non-null key."""
    sizes, names = stored_sizes(sides, key), list(sides)
    padded = [pad(df, sizes, ~F.col(f"has_{name}"), key) for name, df in sides.items()]
    result = padded[0]
    for n, side in enumerate(padded[1:], 1):
        result = split_join(result, side, key, sizes, rows_of(*names[:n]), rows_of(names[n]))
    return result


def left_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    sizes: DataFrame | None = None,
    unmatched: Column | None = None,
    matchable: Column | None = None,
    left_rows: Column | None = None,
    right_rows: Column | None = None,
) -> DataFrame:
    """Left join on one key; ``right`` may repeat keys.

    ``sizes``, with ``unmatched`` (the left keys the right side lacks) and the
    rows per key of both sides, is for callers that have them already. Left rows
    with a NULL key, or failing ``matchable``, match nothing and go around the join.
    """
    if sizes is None:
        sizes = stored_sizes({"left": left, "right": right}, key)
        unmatched = F.col("has_left") & ~F.col("has_right")
        left_rows, right_rows = rows_of("left"), rows_of("right")
    joins = F.col(key).isNotNull()
    if matchable is not None:
        joins = joins & F.coalesce(matchable, F.lit(False))
    joined = split_join(left.where(joins), pad(right, sizes, unmatched, key), key, sizes, left_rows, right_rows)
    return joined.unionByName(left.where(~joins), allowMissingColumns=True)
