"""Connected components of an undirected graph, by large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galewatch.llm.shared import landed


def star(edges: DataFrame) -> DataFrame:
    """u, v, low: each edge with the least neighbour of u. Joined rather than gathered, so that a hub is split."""
    least = edges.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("low"))
    return edges.join(least, F.col("u") == F.col("_u")).drop("_u")


def large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = F.least("low", "u")
    return star(both).where("v > u").select(F.col("v").alias("u"), low.alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Expects u > v."""
    near = star(edges)
    moved = near.where("v != low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.unionByName(near.select("u", F.col("low").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root: the least node reachable, for nodes on edges. ``edges``: u, v of an ordered type, u != v.

    Each round is written to the shared folder; rounds grow with the logarithm
    of the longest chain, and all that reaches the driver is a count and a sum.
    """
    now = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct()
    now, before = landed(now, "edges"), None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
        now = landed(small_star(large_star(now)), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
