"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from loanscope.llm.shared import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link each node's neighbours to the smallest of them: the larger neighbours, or else the smaller ones and itself."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    joined = both.join(least, "a")
    if large:
        out = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(least.select("a", F.col("m").alias("b")))
    return out.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one edge to a node that has none itself."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    return not ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 or up = 1 and down = 1").take(1)


def smallest(edges: DataFrame) -> DataFrame:
    """Edges (a, b) from every node of `edges` (a, b: long) that isn't the smallest of its component to the one that is.

    Each round is written to the shared folder; it ends when the edges are stars around the smallest nodes.
    """
    edges = written(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    while not _stars(edges):
        edges = written(_star(_star(edges, large=True), large=False).distinct())
    return edges


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes of `edges` (a, b: long); the component is its smallest node."""
    edges = smallest(edges)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
