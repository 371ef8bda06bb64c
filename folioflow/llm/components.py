"""Connected components of a graph, by alternating large-star and small-star steps.

Each round is a minimum per node (combined before the shuffle) and a join; rounds are
about the logarithm of the longest path. Every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.session import materialize


def _hook(pairs: DataFrame, least: DataFrame) -> DataFrame:
    """(v, least of u) for the pairs (u, v)."""
    return pairs.join(least, "u").select(F.col("v").alias("a"), F.col("least").alias("b")).filter("a <> b")


def _least(pairs: DataFrame, name: str) -> DataFrame:
    """The smallest of each node and its neighbours; written down, so that the join after it may split hot nodes."""
    return materialize(pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("least")), name)


def _stars(edges: DataFrame) -> bool:
    """True if every node points at one other, and none at a node that points on: a root and its component are then told."""
    twice = edges.groupBy("a").agg(F.count("*").alias("n")).filter("n > 1")
    return twice.isEmpty() and edges.join(edges.select(F.col("b").alias("a")), "a", "left_semi").isEmpty()


def connected(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """node, root (the smallest node connected to it), for every node that has an edge. `edges`: a, b, integers."""
    now = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    for _ in range(rounds):
        if _stars(now):
            roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select("b", "a"))
        large = _hook(both.filter("v > u"), _least(both, "large-star"))
        now = materialize(large.distinct(), "large-star-edges")
        down = now.select(F.col("a").alias("u"), F.col("b").alias("v"))  # a > b always
        least = _least(down, "small-star")
        now = materialize(_hook(down, least).union(least.select("u", "least")).distinct(), "small-star-edges")
    raise RuntimeError(f"components are not connected after {rounds} rounds")
