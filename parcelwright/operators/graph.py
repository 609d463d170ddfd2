"""Connected components by alternating stars.

Each round is two hash aggregations and two equi-joins over the edge list; no node's neighbours are ever collected, so a
star with a third of all edges costs no more than the same number of edges elsewhere (the joins split skewed keys, the
aggregations combine before the shuffle). The result labels every node with the smallest id of its component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwright.plans.staging import release, stage

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour instead."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are all linked to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id, component`` of every node that has an edge to another; component is the smallest id in it.

    ``edges`` holds integer ids; loops and null ends are ignored, repeated and reversed edges count once.
    """
    e = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    e = stage(e, "edges")
    state = None
    for _ in range(MAX_ROUNDS):
        before, e = e, stage(_small_star(_large_star(e)), "edges")
        release(before)
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state:
            return e.select(F.col("u").alias("id"), F.col("v").alias("component")).union(e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
        state = now
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
