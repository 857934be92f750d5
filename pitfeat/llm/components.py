"""Connected components of links, by contraction to stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitfeat.checkpoints import cut_lineage


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and root (smallest node) of every node that has a link.

    Every round points all neighbours of a node at the smallest of them, first
    the larger ones, then the smaller ones; the number of rounds grows with the
    logarithm of the longest path. Rounds stop when no link changes. The links
    stay distributed and are written once a round; a node with very many links
    is reduced by a partial minimum before any shuffle.
    """
    edges = cut_lineage(links.select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = large.distinct()
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(root, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            joined.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        edges = cut_lineage(small)
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == before:
            break
        before = state
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
