"""Connected components of a graph of links, by alternating star contractions in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from orderloom.llm.common import scratch


def _large_star(edges: DataFrame) -> DataFrame:
    """Ties every larger neighbour of a node to the smallest node around it."""
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Ties every smaller neighbour of a node, and the node, to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes of the links (a, b); root is the component's smallest node.

    Each round is written to the shared folder. The links shrink to one star per component in
    a number of rounds that grows with the logarithm of the longest path. A round that changes
    nothing is the last; the tasks that write a round sum up what tells it from the one before.
    """
    larger, smaller = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    edges, before = _round(edges.where("a <> b").select(larger, smaller).distinct())
    while before["n"]:
        edges, now = _round(_small_star(_large_star(edges).distinct()).distinct())
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _round(edges: DataFrame) -> tuple[DataFrame, dict]:
    seen = Observation()
    total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("hashes")
    held = scratch(edges.observe(seen, F.count(F.lit(1)).alias("n"), total), "links")
    return held, seen.get
