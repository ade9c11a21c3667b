"""Connected components of an edge table, by large-star and small-star rounds. No node or edge reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import settle


def _least(edges: DataFrame) -> DataFrame:
    """Each edge with the least neighbour of its ``u`` (``u`` itself counts)."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(least, "u")


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, component`` (the least node) for every node of ``edges(a, b)`` (longs). Loops and repeats do no harm.

    A star round moves every node to the least neighbour known; edges only ever shrink towards stars, and the rounds end
    when nothing changes, after a number that grows with the logarithm of the longest chain.
    """
    now = settle(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small = _least(large)
        parts = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        now = settle(parts.where("u <> v").distinct(), "edges")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
