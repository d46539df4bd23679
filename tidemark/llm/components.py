"""Connected components of a graph held in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_ROUNDS = 60


def connected_components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, root): the smallest node of each node's component, for every node of a link.

    Rounds of a large-star and a small-star step turn each component into a star around its smallest node;
    the number of rounds grows with the logarithm of the longest path. Links of a node are never gathered:
    each step is a grouped minimum and a join, whose hot side adaptive execution splits.
    """
    edges = links.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct().checkpoint()
    before = None
    for _ in range(MOST_ROUNDS):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = small.unionByName(least.withColumnRenamed("m", "v")).distinct().checkpoint()
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = state
    raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
