"""Filling gaps from the nearest rows, found in random-projection trees."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitfeat.checkpoints import cut_lineage

TREES, LEAF = 8, 64
# points that the upper splits are learned from, and the fewest of them that a split may go by
SAMPLE, FEWEST = 262_144, 32


def impute_neighbours(
    df: DataFrame, key: str, columns: list[str], on: list[str], k: int = 2,
    trees: int = TREES, leaf: int = LEAF, seed: int = 7,
) -> DataFrame:
    """Fill nulls with the mean of the ``k`` nearest rows that have the column.

    Rows are near by the columns ``on``, each less its mean and over its deviation; a
    null there counts as the mean. Ties go to the smaller ``key``, which is unique.
    The search is approximate, see `nearest`; no two rows are compared unless a leaf
    of some tree holds both. A row of whose leaves no row has the column gets the
    column's mean.
    """
    stats = df.agg(*[f(c).alias(f"{n}_{i}") for i, c in enumerate(on)
                     for n, f in (("m", F.avg), ("s", F.stddev_pop))],
                   *[F.avg(c).alias(f"f_{i}") for i, c in enumerate(columns)]).first()
    place = [F.coalesce((F.col(c).cast("double") - (stats[f"m_{i}"] or 0.0)) / (stats[f"s_{i}"] or 1.0), F.lit(0.0))
             for i, c in enumerate(on)]
    points = df.select(F.col(key).alias("_key"), F.coalesce(F.array(*place), F.array()).alias("_at"),
                       F.array(*[F.col(c).cast("double") for c in columns]).alias("_values"))
    gap = F.exists("_values", lambda v: v.isNull())
    some = F.exists("_values", lambda v: v.isNotNull())
    found = nearest(points.where(gap), points.where(some), len(on), len(columns), k, trees, leaf, seed)
    means = found.select("_key", *[
        F.try_divide(F.aggregate(F.col("_near")[i], F.lit(0.0), lambda s, d: s + d["value"]), F.size(F.col("_near")[i]))
        .alias(f"_n_{i}") for i in range(len(columns))])
    d = df.join(means, F.col(key) == F.col("_key"), "left")
    filled = [F.coalesce(F.col(c).cast("double"), f"_n_{i}", F.lit(stats[f"f_{i}"])).alias(c)
              for i, c in enumerate(columns)]
    return d.select(*[filled[columns.index(c)] if c in columns else F.col(c) for c in df.columns])


def nearest(
    asking: DataFrame, donors: DataFrame, dims: int, values: int, k: int,
    trees: int = TREES, leaf: int = LEAF, seed: int = 7, sample: int = SAMPLE,
) -> DataFrame:
    """For rows (_key, _at) the ``k`` nearest donors (_key, _at, _values) per value that they have.

    Gives _key and _near: for every value an array of (distance, key, value), nearest
    first. Equal points are searched once: of those that donate only the ``k + 1``
    smallest keys of a value can be among the nearest, one of which may be the row that
    asks, which does not get itself. Trees split space at the median of a random
    direction, until leaves hold about ``leaf`` points that donate. The upper splits are
    those of about ``sample`` points, all that donate if they are fewer, the lower ones
    those of all points, level by level. A leaf left above four times its size is cut by
    a hash into parts, and who asks there asks every part, so nothing is dropped and no
    part grows.
    """
    places = cut_lineage(_places(donors, values, k + 1))
    n = places.count()
    levels = max(0, math.ceil(math.log2(max(1, n) / leaf)))
    ways = np.random.default_rng(seed).normal(size=(max(1, levels), dims, trees))
    part = math.ceil(n / sample)
    # xxhash64 deals the rows of shuffles, so the sample goes by another hash
    known = places if part <= 1 else places.where(F.pmod(F.hash("_at", F.lit(seed)), F.lit(part)) == 0)
    rows = known.select("_at").collect()
    points = np.array([r[0] for r in rows], dtype="float64").reshape(len(rows), dims)
    upper = levels if part <= 1 else min(levels, max(0, int(math.log2(max(1, len(points)) / FEWEST))))
    both = asking.select("_at").distinct().select("_at", F.lit(None).cast(places.schema["_own"].dataType).alias("_own"),
                                                  F.lit(True).alias("_asks"))
    both = both.unionByName(places.select("_at", "_own", F.lit(False).alias("_asks")))
    forest = both.select("*", F.posexplode(_nodes(points, ways[:upper], trees)("_at")).alias("_tree", "_node"))
    forest = cut_lineage(forest)
    for level in range(upper, levels):
        forest = cut_lineage(_split(forest, ways[level]))
    place = ["_tree", "_node"]
    sizes = forest.where("not _asks").groupBy(*place).agg(F.ceil(F.count("*") / F.lit(4 * leaf)).cast("int").alias("_parts"))
    cut = forest.join(sizes, place)
    item = F.struct(F.col("_at").alias("at"), F.col("_own").alias("own"))
    own = cut.where("not _asks").withColumn("_part", F.pmod(F.xxhash64("_at"), F.col("_parts")).cast("int"))
    leaves = own.groupBy(*place, "_part").agg(F.collect_list(item).alias("_leaf"))
    asks = cut.where("_asks").withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    met = asks.select("_at", *place, "_part").join(leaves, [*place, "_part"])
    best = met.select("_at", F.array(*[_best(i, k + 1, dims) for i in range(values)]).alias("_near"))
    # a donor may be found in several trees
    each = best.groupBy("_at").agg(*[
        F.array_distinct(F.flatten(F.collect_list(F.col("_near")[i]))).alias(f"_v{i}") for i in range(values)])
    found = each.select("_at", F.array(*[F.slice(F.array_sort(f"_v{i}"), 1, k + 1) for i in range(values)]).alias("_found"))
    other = F.transform("_found", lambda v: F.slice(F.filter(v, lambda d: d["key"] != F.col("_key")), 1, k))
    return asking.select("_key", "_at").join(found, "_at").select("_key", other.alias("_near"))


def _places(donors: DataFrame, values: int, most: int) -> DataFrame:
    """Points that donate: _at and _own, for every value the ``most`` smallest keys that have it."""
    each = donors.select("_key", "_at", F.posexplode("_values").alias("_i", "_value")).where("_value is not null")
    order = Window.partitionBy("_at", "_i").orderBy("_key")
    each = each.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= most)
    item = F.struct(F.col("_key").alias("key"), F.col("_value").alias("value"))
    own = F.array(*[F.collect_list(F.when(F.col("_i") == i, item)) for i in range(values)])
    return each.groupBy("_at").agg(own.alias("_own"))


def _nodes(points: np.ndarray, ways: np.ndarray, trees: int):
    """A function from points to their nodes, one per tree, in trees split at the medians of ``points``."""
    halves = []
    at = np.zeros((len(points), trees), dtype="int64")
    for level, way in enumerate(ways):
        along, half = _along(points, way), np.full((2 ** level, trees), np.inf)
        for t in range(trees):
            order = np.lexsort((along[:, t], at[:, t]))
            node, first, n = np.unique(at[order, t], return_index=True, return_counts=True)
            half[node, t] = along[order[first + (n - 1) // 2], t]
        at = at * 2 + (along > np.take_along_axis(half, at, 0))
        halves.append(half)

    @F.pandas_udf("array<long>")
    def nodes(place: pd.Series) -> pd.Series:
        here = np.array(place.tolist(), dtype="float64").reshape(len(place), ways.shape[1])
        at = np.zeros((len(here), trees), dtype="int64")
        for way, half in zip(ways, halves):
            at = at * 2 + (_along(here, way) > np.take_along_axis(half, at, 0))
        return pd.Series(list(at))

    return nodes


def _along(points: np.ndarray, way: np.ndarray) -> np.ndarray:
    """Places of points in the direction of each tree; the same whatever the points beside them."""
    return np.einsum("nd,dt->nt", points, way)


def _split(forest: DataFrame, ways: np.ndarray) -> DataFrame:
    """One level: the side of the median of its node's donors on which a row lies."""
    along = F.lit(0.0)
    for i, by_tree in enumerate(ways.tolist()):
        along = along + F.get("_at", F.lit(i)) * F.get(F.array(*[F.lit(x) for x in by_tree]), F.col("_tree"))
    d = forest.withColumn("_along", along)
    half = d.where("not _asks").groupBy("_tree", "_node").agg(F.percentile_approx("_along", 0.5, 1000).alias("_half"))
    d = d.join(half, ["_tree", "_node"], "left")
    side = F.coalesce((F.col("_along") > F.col("_half")).cast("int"), F.lit(0))
    return d.select("_at", "_own", "_asks", "_tree", (F.col("_node") * 2 + side).alias("_node"))


def _best(i: int, k: int, dims: int) -> Column:
    """The k nearest of a leaf's donors that have value i."""
    def far(p: Column) -> Column:
        return F.sqrt(sum(((F.col("_at")[j] - p["at"][j]) * (F.col("_at")[j] - p["at"][j]) for j in range(dims)), F.lit(0.0)))

    some = F.filter("_leaf", lambda p: F.size(p["own"][i]) > 0)
    # only the k nearest points can hold the k nearest donors
    points = F.slice(F.array_sort(F.transform(some, lambda p: F.struct(
        far(p).alias("distance"), p["own"][i][0]["key"].alias("least"), p["own"][i].alias("own")))), 1, k)
    rows = F.flatten(F.transform(points, lambda p: F.transform(p["own"], lambda d: F.struct(
        p["distance"].alias("distance"), d["key"].alias("key"), d["value"].alias("value")))))
    return F.slice(F.array_sort(rows), 1, k)
