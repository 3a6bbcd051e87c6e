"""Connected components of a graph given as an edge table, by alternating star contractions.

A large star links every larger neighbour of a node to the smallest one, a small star links the node and its smaller
neighbours to it; both only take minima per node and join them back, so a hub's edges are split among tasks like any
skewed join.  Edges are written to the shared folder after every round; only their count and checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.operators.durable import cut


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node of ``edges(a, b)`` with a partner.

    Nulls link nothing; loops, repeated edges and either direction are fine.
    """
    pairs = cut(edges.where(F.col("a") != F.col("b"))
                .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    for _ in range(rounds):
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        pairs = cut(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        state = tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("components did not settle")
    roots = pairs.select(F.col("b").alias("node")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component")))
