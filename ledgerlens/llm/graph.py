"""Connected components of an edge table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import pin, unpin


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest
    node of its component.

    Alternating stars (large, then small): every round moves each node's
    neighbours to its smallest neighbour, which leaves stars around the roots
    after a number of rounds that grows with the logarithm of the size.  Rounds
    are written to the checkpoint folder; smallest neighbours are aggregated
    before they are joined back, so a hub is one row per task.
    """
    star = pin(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
               .where("u <> v").distinct())
    before = None
    for _ in range(rounds):
        both = star.union(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = pin(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        star = pin(large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                   .union(least.select("u", F.col("m").alias("v"))).distinct())
        now = star.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        unpin(large)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return star.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        star.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
