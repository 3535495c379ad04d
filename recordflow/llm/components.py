"""Connected components of a graph given as edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_groups, materialise


def _with_least(pairs: DataFrame) -> DataFrame:
    """Pairs (u, v) with the least of u and all its v as ``m``; a node with very many pairs stays spread out."""
    pairs = materialise(pairs.distinct())
    least = pairs.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("_pairs"))
    least = materialise(least.withColumn("m", F.least("u", "m")))
    return join_groups(pairs, least, ["u"], "_pairs").select("u", "v", "m")


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """Rows (u, v) of an undirected graph without loops; returns (node, root), root the least node of the component.

    Nodes without an edge are not in the result. Each round halves the distance to
    the root at least; rounds are stored, and stop when one changes nothing.
    """
    current = materialise(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    before = None
    while (now := _mark(current)) != before:
        before = now
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Large star: every larger neighbour moves to the least of the neighbourhood.
        large = _with_least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Small star: every smaller neighbour, and the node itself, move to the least.
        small = _with_least(large)
        moved = small.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        own = small.select("u", F.col("m").alias("v"))
        current = materialise(moved.unionByName(own).distinct())
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
