"""Many conditional distinct counts over one key, in two aggregates.

``count(distinct case when p then id end)`` for twenty conditions is planned as
an Expand that copies every row twenty times. Packing the conditions into the
bits of one number and OR-ing them per id gives the same counts: an id counts
for a condition when any of its rows meets it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

MAX_FLAGS = 62


class FlagSet:
    """Named row conditions (SQL predicates) packed into a bigint column."""

    def __init__(self, conditions: Mapping[str, str], column: str):
        if len(conditions) > MAX_FLAGS:
            raise ValueError(f"at most {MAX_FLAGS} conditions fit into one mask")
        self.conditions = dict(conditions)
        self.column = column

    def pack(self) -> Column:
        """Row level: bits of the conditions that hold."""
        bits = (f"if({test}, {1 << i}L, 0L)" for i, test in enumerate(self.conditions.values()))
        return F.expr(" + ".join(bits)).alias(self.column)

    def merge(self) -> Column:
        """Key level: bits that hold in any row of the key."""
        return F.bit_or(self.column).alias(self.column)

    def count(self, name: str, alias: str | None = None) -> Column:
        """Group level: number of keys that meet a condition."""
        bit = list(self.conditions).index(name)
        return F.expr(f"coalesce(sum(cast(getbit({self.column}, {bit}) as bigint)), 0L) as {alias or name}")

    def counts(self, *names: str) -> list[Column]:
        return [self.count(name) for name in names or self.conditions]
