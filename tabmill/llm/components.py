"""Connected components of a graph too large for one machine, by alternating large and small stars.

A round joins every node to the smallest node it knows of, first towards larger neighbours, then towards smaller ones. Counts of
rounds grow with the logarithm of the nodes; a round never makes more edges than it got. The smallest neighbours are
found by pre-aggregated minima, and joined to the edges by plain joins, whose large keys Spark splits. Every
round is stored in the shared folder, so lost executors cost one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmill.session import materialize

MOST_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is joined to the node's smallest neighbour, or the node itself."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = materialize(
        both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least")), "large-star"
    )
    larger = both.where("b > a").join(least, "a")
    return larger.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are joined to the smallest of them. Edges lead from the larger to the smaller."""
    least = materialize(edges.groupBy("a").agg(F.min("b").alias("least")), "small-star")
    others = edges.join(least, "a").where("b > least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return others.union(least.select("a", F.col("least").alias("b"))).distinct()


def _fingerprint(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge; the component is its smallest node.

    ``edges`` has two columns of one type, in any direction, repeated or not; edges from a node to itself or without an end are
    left out. No edges give no rows.
    """
    ends = edges.toDF("a", "b").where("a is not null and b is not null and a != b")
    stored = materialize(ends.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _fingerprint(stored)
    if not before[0]:
        return stored.select(F.col("a").alias("node"), F.col("b").alias("component"))
    for _ in range(MOST_ROUNDS):
        stored = materialize(_small_star(_large_star(stored)), "edges")
        after = _fingerprint(stored)
        if after == before:
            roots = stored.select(F.col("b").alias("node")).distinct()
            return stored.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots.select("node", F.col("node").alias("component")))
        before = after
    raise RuntimeError(f"no stable components after {MOST_ROUNDS} rounds")
