"""Connected components of a graph given as edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from citylake.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node moves to the smallest neighbour of the node."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node itself, move to the smallest of them; edges have a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).where("a > b").distinct()


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour at most and none that has one itself."""
    ends = edges.select(F.col("a").alias("node"), F.col("b").alias("up")).unionByName(edges.select(F.col("b").alias("node"), F.lit(None).cast("long").alias("up")))
    seen = ends.groupBy("node").agg(F.min("up").alias("least"), F.max("up").alias("most"), F.count_if(F.col("up").isNull()).alias("roots"))
    return seen.where("least is not null and (roots > 0 or least < most)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """For edges (a, b) of longs the smallest member of each node's component: columns a, b, only nodes with a > b.

    A node that is not returned is its own component. Loops and repeated edges do no harm. Each round is a table written
    to the shared folder; the number of rounds grows with the logarithm of the longest path.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b")
    while True:
        edges = written(_small_star(_large_star(edges)), "components")
        if _is_forest_of_stars(edges):
            return edges
