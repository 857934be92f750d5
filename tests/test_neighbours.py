"""Approximate neighbours against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitfeat.operators import neighbours as nb

SCHEMA = "id long, a double, b double, c double, x double, y double"


def table(n, seed=1):
    g = np.random.default_rng(seed)
    out = []
    for i in range(n):
        a, b, c = g.normal(), g.random() * 50, float(g.integers(0, 5))
        out.append([i, a, b, c, None if i % 7 == 0 else a + b, None if i % 11 == 0 else float(i)])
    return out


def brute(rows, k):
    at = np.array([r[1:4] for r in rows])
    at = (at - at.mean(0)) / at.std(0)
    near = {}
    for i, r in enumerate(rows):
        for v in (4, 5):
            if r[v] is None:
                d = np.sqrt(((at - at[i]) ** 2).sum(1))
                near[r[0], v - 4] = [rows[j][0] for j in np.lexsort((np.arange(len(rows)), d))
                                     if j != i and rows[j][v] is not None][:k]
    return near


def test_recall_of_the_two_nearest(spark):
    rows = table(3000)
    df = spark.createDataFrame(rows, SCHEMA)
    at = np.array([r[1:4] for r in rows])
    at = (at - at.mean(0)) / at.std(0)
    points = spark.createDataFrame([(r[0], p.tolist(), r[4:]) for r, p in zip(rows, at)],
                                   "_key long, _at array<double>, _values array<double>")
    asking = points.where(F.exists("_values", lambda v: v.isNull()))
    found = {r._key: r._near for r in nb.nearest(asking, points, 3, 2, 2).collect()}
    want = brute(rows, 2)
    hits = sum(len({d.key for d in found[i][v]} & set(near)) for (i, v), near in want.items())
    assert hits / sum(map(len, want.values())) >= 0.9
    filled = {r.id: r for r in nb.impute_neighbours(df, "id", ["x", "y"], ["a", "b", "c"]).collect()}
    assert len(filled) == len(rows)
    for r in rows:
        for v, name in ((4, "x"), (5, "y")):
            if r[v] is not None:
                assert filled[r[0]][name] == r[v]
            else:
                assert filled[r[0]][name] == pytest.approx(np.mean([rows[d.key][v] for d in found[r[0]][v - 4]]))


def test_small_input_is_exact(spark):
    rows = table(60, 2)
    got = {r.id: r for r in nb.impute_neighbours(spark.createDataFrame(rows, SCHEMA), "id", ["x", "y"], ["a", "b", "c"]).collect()}
    for (i, v), near in brute(rows, 2).items():
        assert got[i]["xy"[v]] == pytest.approx(np.mean([rows[j][4 + v] for j in near]))


def test_equal_points_nulls_and_no_rows(spark):
    same = [[i, 1.0, 2.0, None, None if i == 0 else float(i), None] for i in range(500)]
    d = spark.createDataFrame(same, SCHEMA)
    got = {r.id: r for r in nb.impute_neighbours(d, "id", ["x", "y"], ["a", "b", "c"], leaf=8).collect()}
    assert got[0].x == 1.5 and got[0].y is None and got[5].x == 5.0  # ties go to the smallest keys; y has no value at all
    assert nb.impute_neighbours(d.limit(0), "id", ["x"], ["a"]).count() == 0
    assert nb.impute_neighbours(d.limit(1), "id", ["x"], ["a"]).first().x is None


def test_lower_splits_by_all_points(spark):
    """Upper splits from a part of the points, the lower ones level by level."""
    rows = table(3000, 3)
    at = np.array([r[1:4] for r in rows])
    at = (at - at.mean(0)) / at.std(0)
    points = spark.createDataFrame([(r[0], p.tolist(), r[4:]) for r, p in zip(rows, at)],
                                   "_key long, _at array<double>, _values array<double>")
    asking = points.where(F.exists("_values", lambda v: v.isNull()))
    found = {r._key: r._near for r in nb.nearest(asking, points, 3, 2, 2, sample=300).collect()}
    want = brute(rows, 2)
    hits = sum(len({d.key for d in found[i][v]} & set(near)) for (i, v), near in want.items())
    assert hits / sum(map(len, want.values())) >= 0.9


def test_equal_points_are_searched_once(spark):
    """However many rows lie on one point, the search holds it once, with the few keys that can be nearest."""
    d = spark.range(20_000).select(
        F.col("id").alias("_key"), F.array((F.col("id") % 2).cast("double")).alias("_at"),
        F.array(F.when(F.col("id") % 5 != 0, F.col("id").cast("double")), F.lit(None).cast("double")).alias("_values"))
    own = {r._at[0]: [[x.key for x in v] for v in r._own] for r in nb._places(d, 2, 3).collect()}
    assert {at: [sorted(v) for v in o] for at, o in own.items()} == {0.0: [[2, 4, 6], []], 1.0: [[1, 3, 7], []]}
    found = {r._key: [[x.key for x in v] for v in r._near] for r in nb.nearest(d, d, 1, 2, 2, leaf=2).collect()}
    assert len(found) == 20_000 and found[2] == [[4, 6], []] and found[7] == [[1, 3], []] and found[19_998] == [[2, 4], []]
