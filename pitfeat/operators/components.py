"""Connected components of links between identifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitfeat.checkpoints import cut_lineage


def connected(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``root`` (the smallest node it is linked with) of every node that has a link.

    A round points the neighbours of a node at the smallest of them, first the larger
    ones, then the smaller ones, and then every node at what its target points at. That
    last jump doubles the reach, so a chain of n nodes is done in about log2(n) rounds,
    and the loop ends when a round changes nothing. Links stay distributed and are
    written once a round; a node with very many links is reduced by a partial minimum
    before any shuffle.
    """
    edges = cut_lineage(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    )
    before = None
    while True:
        edges = cut_lineage(_round(edges))
        state = edges.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
        ).first()
        if state == before:
            break
        before = state
    # every node but the roots now has one link, to its root
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _round(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = large.distinct()
    low = large.groupBy("u").agg(F.min("v").alias("m"))
    down = large.join(low, "u")
    small = down.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        down.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
    target = small.groupBy("u").agg(F.min("v").alias("up")).select(F.col("u").alias("v"), "up")
    jumped = small.join(target, "v", "left").withColumn("up", F.coalesce("up", "v"))
    return jumped.select("u", F.col("up").alias("v")).unionByName(
        jumped.select(F.col("v").alias("u"), F.col("up").alias("v"))).where("u <> v").distinct()
