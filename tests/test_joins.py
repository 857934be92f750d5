import numpy as np
import pytest
from pyspark.sql import functions as F

from pitfeat.operators import joins as j
from pitfeat.operators import reduce as r
from pitfeat.operators.asof import asof_join, banded_nearest
from pitfeat.operators.counters import fold_latest, merge_counters


def side(spark, n, seed, prefix):
    g = np.random.default_rng(seed)
    key = np.where(g.random(n) < 0.5, 0, g.integers(1, 9, n)).astype(object)
    key[g.random(n) < 0.05] = None
    sec = np.where(g.random(n) < 0.2, 4000, g.integers(0, 9000, n)).astype(object)
    sec[g.random(n) < 0.03] = None
    data = [(i, k, None if s is None else int(s)) for i, (k, s) in enumerate(zip(key, sec))]
    d = spark.createDataFrame(data, f"{prefix}id long, k long, {prefix}s long")
    return data, d.withColumn(f"{prefix}t", F.timestamp_seconds(f"{prefix}s"))


@pytest.mark.parametrize("slice_rows", [None, 15, 1])
@pytest.mark.parametrize("tolerance", [None, 120])
def test_asof(spark, slice_rows, tolerance):
    left, dl = side(spark, 200, 1, "l")
    right, dr = side(spark, 300, 2, "r")
    got = asof_join(dl, dr, ["k"], "lt", "rt", tolerance, ["rid"], slice_rows=slice_rows).collect()
    assert len(got) == len(left)
    for row in got:
        fit = [
            (s, i) for i, k, s in right
            if None not in (k, s, row.ls) and k == row.k and s <= row.ls
        ]
        best = max(fit, default=None)
        if best and tolerance is not None and row.ls - best[0] > tolerance:
            best = None
        assert row.rid == (best[1] if best else None)


def test_asof_boundary_and_ties(spark):
    def frame(data, p):
        d = spark.createDataFrame(data, f"{p}id long, k long, {p}us long")
        return d.withColumn(f"{p}t", F.timestamp_micros(f"{p}us"))

    left = frame([(1, 1, 60_000_000), (2, 2, 60_000_001), (3, 3, 5), (4, 4, 9)], "l")
    right = frame([(1, 1, 0), (2, 2, 0), (3, 3, 5), (4, 4, 7), (5, 4, 7)], "r")
    got = asof_join(left, right, ["k"], "lt", "rt", 60, ["rid"]).collect()
    assert {x.lid: x.rid for x in got} == {1: 1, 2: None, 3: 3, 4: 5}
    with pytest.raises(ValueError):
        asof_join(left, left, ["k"], "lt", "lt")


@pytest.mark.parametrize("slice_rows", [None, 15])
@pytest.mark.parametrize("keep_ties", [False, True])
def test_banded_nearest(spark, slice_rows, keep_ties):
    left, dl = side(spark, 150, 3, "l")
    right, dr = side(spark, 200, 4, "r")
    lo, hi = 600, 3000
    got = banded_nearest(
        dl, dr, ["k"], "lt", "rt", lo / 3600, hi / 3600, ["rid"], "", keep_ties, slice_rows
    ).collect()
    want = []
    for i, k, s in left:
        lags = [(s - rs, -ri) for ri, rk, rs in right if None not in (k, s, rs) and rk == k]
        fit = sorted(x for x in lags if lo <= x[0] <= hi)
        if fit:
            ties = [x for x in fit if x[0] == fit[0][0]]
            want += [(i, -x[1], "matched") for x in (ties if keep_ties else ties[:1])]
        elif any(0 <= x[0] < lo for x in lags):
            want.append((i, None, "recent"))
        elif any(x[0] > hi for x in lags):
            want.append((i, None, "stale"))
        else:
            want.append((i, None, "none"))
    assert sorted(((x.lid, x.rid, x.lag_band) for x in got), key=str) == sorted(want, key=str)


def test_band_edges(spark):
    hours = [48, 2160, 47.99, -1]
    left = spark.createDataFrame([(i,) for i in range(4)], "k long").withColumn(
        "lt", F.timestamp_seconds(F.lit(20_000_000))
    )
    right = spark.createDataFrame(
        [(i, 20_000_000 - int(x * 3600)) for i, x in enumerate(hours)], "k long, s long"
    ).select("k", F.timestamp_seconds("s").alias("rt"))
    got = banded_nearest(left, right, ["k"], "lt", "rt").collect()
    assert {x.k: x.rt is not None for x in got} == {0: True, 1: True, 2: False, 3: False}


def test_equi_joins(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k long, a string")
    b = spark.createDataFrame([(1, 10), (3, 30), (None, 99)], "k long, b long")
    assert sorted(x.a for x in j.anti_join(a, b, ["k"]).collect()) == ["y", "z"]
    assert j.full_outer(a, b, ["k"]).count() == 5
    looked = j.apply_lookup(a, b, "k", "v", "k", "b").collect()
    assert {x.a: x.v for x in looked} == {"x": 10, "y": None, "z": None}
    up = j.update_side(a, b, ["k"]).collect()
    assert {x.b: x.main_a for x in up} == {10: "x", 30: None, 99: None}
    both = j.concat_frames(a, b)
    assert both.columns == ["k", "a", "b"] and both.count() == 6
    tagged = j.union_sources({"web": a, "app": a.select("a", "k")})
    assert tagged.groupBy("source").count().count() == 2


def test_latest_and_dedup(spark):
    d = spark.createDataFrame(
        [(1, 5, 1), (1, 5, 2), (1, 3, 9), (2, 1, 1), (None, 7, 1)], "k long, t long, id long"
    ).withColumn("t", F.timestamp_seconds("t"))
    assert sorted((x.k, x.id) for x in r.latest_per_key(d, ["k"], "t", ["id"]).collect()) == [
        (1, 2), (2, 1),
    ]
    assert r.dedup(d, ["k"], ["id"]).count() == 3
    twice = d.unionByName(d)
    assert r.dedup_ignoring(twice, ["id"], ["id"]).count() == 4
    plan = d.sparkSession._jvm.PythonSQLUtils.explainString(
        r.dedup(d, ["k"], ["id"])._jdf.queryExecution(), "simple"
    )
    # one row per key and map task before the shuffle
    assert plan.index("WindowGroupLimit") < plan.index("Exchange")
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange")


def test_counters(spark):
    schema = "k long, t long, n long, m long"
    main = spark.createDataFrame([(1, 1, 10, 7), (2, 1, 20, 8)], schema)
    delta = spark.createDataFrame([(2, 5, 1, 9), (3, 5, None, 9)], schema)
    merged = merge_counters(main, delta, ["k"], ["n"]).collect()
    assert {x.k: (x.n, x.m) for x in merged} == {2: (21, 9), 3: (0, 9)}
    folded = fold_latest(main, delta, ["k"], "t", [], ["n"]).collect()
    assert {x.k: (x.t, x.n, x.m) for x in folded} == {1: (1, 10, 7), 2: (5, 21, 9), 3: (5, 0, 9)}


def test_join_dealt_bounds_the_rows_of_a_task(spark):
    from pitfeat.operators.joins import join_dealt

    many = spark.range(1000).selectExpr("id", "nullif(id % 300, 7) AS k")
    one = spark.range(250).selectExpr("id AS o", "id * 2 AS x")
    want = sorted(many.join(one, many.k == one.o).collect())
    assert sorted(join_dealt(many, one, "k", "o").collect()) == want
    spark.conf.set("spark.pitfeat.task.rows", "100")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        got = join_dealt(many, one, "k", "o")
        assert sorted(got.collect()) == want
        assert got.rdd.getNumPartitions() == 10
    finally:
        for c in ("spark.pitfeat.task.rows", "spark.sql.autoBroadcastJoinThreshold",
                  "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.unset(c)
