"""Window and slice forms of every history operator against brute force in pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pitfeat.operators import history as h



def all_aggs():
    return {
        "n": h.count(),
        "n_bad": h.count(F.col("bad") == 1),
        "sum_x": h.total("x"),
        "m": h.mean("x"),
        "lo": h.lowest("x"),
        "hi": h.highest("x"),
        "med": h.median("x"),
        "d": h.distinct("v"),
    }



def rows(n=400, seed=1, hot=0.5):
    r = np.random.default_rng(seed)
    key = np.where(r.random(n) < hot, 0, r.integers(1, 12, n)).astype(object)
    key[r.random(n) < 0.03] = None
    # few distinct times, one of them very frequent: many ties
    t = np.where(r.random(n) < 0.2, 50, r.integers(0, 120, n)).astype(object)
    t[r.random(n) < 0.03] = None
    x = r.integers(0, 40, n).astype(float).astype(object)
    x[r.random(n) < 0.05] = None
    return [
        (i, k, None if s is None else int(s) * 60, a, int(b), v)
        for i, (k, s, a, b, v) in enumerate(
            zip(key, t, x, r.integers(0, 2, n), r.choice(["p", "q", "r", None], n))
        )
    ]


def frame(spark, data):
    d = spark.createDataFrame(data, "id long, k long, s long, x double, bad int, v string")
    return d.withColumn("t", F.timestamp_seconds("s"))


def stats(x):
    x = [a for a in x if a is not None]
    if not x:
        return (None,) * 5
    return sum(x), sum(x) / len(x), min(x), max(x), float(np.median(x))


def brute_prior(data):
    out = {}
    for i, k, s, *_ in data:
        past = [
            r for r in data
            if k is not None and s is not None and r[1] == k and r[2] is not None and r[2] < s
        ]
        out[i] = (
            len(past),
            sum(r[4] for r in past),
            *stats([r[3] for r in past]),
            len({r[5] for r in past if r[5] is not None}),
        )
    return out


@pytest.mark.parametrize("slice_rows,frame_rows", [(None, None), (30, None), (30, 50), (1, 1)])
def test_prior_agg(spark, slice_rows, frame_rows):
    data = rows()
    got = h.prior_agg(frame(spark, data), ["k"], "t", all_aggs(), slice_rows, frame_rows).collect()
    want = brute_prior(data)
    assert len(got) == len(data)
    for r in got:
        mine = [r[c] for c in ("n", "n_bad", "sum_x", "m", "lo", "hi", "med", "d")]
        assert mine == pytest.approx(list(want[r.id])), (r, want[r.id])


@pytest.mark.parametrize("frame_rows,slice_rows", [(None, None), (25, None), (1, 30)])
def test_trailing_agg(spark, frame_rows, slice_rows):
    data, width = rows(300, 2), 1200
    aggs = {
        "n": h.count(), "sum_x": h.total("x"), "m": h.mean("x"), "med": h.median("x"),
        "d": h.distinct("v"),
    }
    got = h.trailing_agg(frame(spark, data), ["k"], "t", width, aggs, frame_rows, slice_rows)
    got = got.collect()
    assert len(got) == len(data)
    for r in got:
        near = [
            q for q in data
            if None not in (r.k, r.s, q[2]) and q[1] == r.k and r.s - width <= q[2] <= r.s
        ]
        total, mean, _, _, med = stats([q[3] for q in near])
        want = [len(near), total, mean, med, len({q[5] for q in near if q[5]})]
        assert [r.n, r.sum_x, r.m, r.med, r.d] == pytest.approx(want)


@pytest.mark.parametrize("slice_rows", [None, 20])
def test_prior_agg_other(spark, slice_rows):
    left, right = rows(200, 3), rows(300, 4)
    got = h.prior_agg_other(
        frame(spark, left), frame(spark, right), ["k"], "t", "t",
        {"n": h.count(), "s_": h.total("x"), "d": h.distinct("v")}, slice_rows,
    ).collect()
    assert len(got) == len(left)
    for r in got:
        past = [
            q for q in right
            if None not in (r.k, r.s, q[2]) and q[1] == r.k and q[2] < r.s
        ]
        want = [len(past), stats([q[3] for q in past])[0], len({q[5] for q in past if q[5]})]
        assert [r.n, r.s_, r.d] == want


@pytest.mark.parametrize("slice_rows", [None, 10])
def test_last_n(spark, slice_rows):
    data = [r for r in rows(300, 5) if r[2] is not None]
    got = h.last_n(frame(spark, data), ["k"], "t", ["id"], 3, ["x"], "recent", slice_rows)
    got = h.recent_stats(got, "x", "r").collect()
    assert len(got) == len(data)
    for r in got:
        mine = sorted((q for q in data if q[1] == r.k and r.k is not None), key=lambda q: (q[2], q[0]))
        at = [q[0] for q in mine].index(r.id) if mine else 0
        past = [q[3] for q in mine[max(0, at - 3):at] if q[2] < r.s]
        total, mean, _, _, med = stats(past)
        assert [r.r_total, r.r_mean, r.r_median] == pytest.approx([total, mean, med])


def test_last_three_with_ties(spark):
    data = [(i, 1, t, 10.0 * (i + 1), 0, "a") for i, t in enumerate([1, 1, 2, 2, 3])]
    d = frame(spark, data)
    got = h.recent_stats(h.last_n(d, ["k"], "t", ["id"], 3, ["x"]), "x", "r")
    got = h.prior_agg(got, ["k"], "t", {"n": h.count()}).orderBy("id").collect()
    assert [r.n for r in got] == [0, 0, 2, 2, 4]
    assert [r.r_total for r in got] == [None, None, 30.0, 30.0, 90.0]


@pytest.mark.parametrize("slice_rows", [None, 10])
def test_gap_seconds(spark, slice_rows):
    data = [r for r in rows(300, 6) if r[2] is not None]
    got = h.gap_seconds(frame(spark, data), ["k"], "t", ["id"], "gap", slice_rows).collect()
    for r in got:
        mine = sorted((q[2], q[0]) for q in data if q[1] == r.k and r.k is not None)
        at = mine.index((r.s, r.id)) if mine else 0
        assert r.gap == (mine[at][0] - mine[at - 1][0] if at else None)


@pytest.mark.parametrize("operator", ["last_n", "number", "gap"])
def test_one_time_stamp_is_spread(spark, operator, monkeypatch):
    """3,600 of 4,000 rows at one time: no slice holds more than twice its share."""
    from pitfeat.operators import sessions, slices

    data = [(i, 1, 50 if i % 10 else i % 97, 1.0 * i, 0, "a") for i in range(4000)]
    d = frame(spark, data)
    largest, assign = [], slices.Slices.assign

    def seen(self, df, order):
        out = assign(self, df, order)
        largest.append(out.groupBy("k", "_slice").count().agg(F.max("count")).first()[0])
        return out

    monkeypatch.setattr(slices.Slices, "assign", seen)
    got = {
        "last_n": lambda: h.last_n(d, ["k"], "t", ["id"], 3, ["id"], "r", 40),
        "number": lambda: sessions.number_rows(d, ["k"], "t", ["id"], "r", 40),
        "gap": lambda: h.gap_seconds(d, ["k"], "t", ["id"], "r", 40),
    }[operator]().collect()
    assert max(largest) <= 2 * 40 + 40
    order = sorted(data, key=lambda r: (r[2], r[0]))
    place = {r[0]: i for i, r in enumerate(order)}
    for r in got:
        at = place[r.id]
        want = {
            "last_n": lambda: [q[0] for q in order[max(0, at - 3):at] if q[2] < r.s],
            "number": lambda: at + 1,
            "gap": lambda: r.s - order[at - 1][2] if at else None,
        }[operator]()
        assert ([q["id"] for q in r.r] if operator == "last_n" else r.r) == want


def test_until_first_and_flag(spark):
    d = spark.createDataFrame(
        [(1, 10, "O"), (1, 20, "F"), (1, 30, "F"), (2, 10, "O"), (2, 20, "P")],
        "k long, s long, st string",
    ).withColumn("t", F.timestamp_seconds("s"))
    good = F.col("st") == "F"
    kept = h.until_first(d, ["k"], "t", good)
    assert sorted((r.k, r.s) for r in kept.collect()) == [(1, 10), (1, 20), (2, 10), (2, 20)]
    strict = h.until_first(d, ["k"], "t", good, keep_without=False)
    assert sorted((r.k, r.s) for r in strict.collect()) == [(1, 10), (1, 20)]
    flags = h.user_flag(d, ["k"], "t", good).collect()
    assert {(r.k, r.s): r.user_flag for r in flags} == {
        (1, 10): "NU", (1, 20): "NU", (1, 30): "RU", (2, 10): "NU", (2, 20): "NU",
    }


def test_history_ignores_the_future(spark):
    data = [r for r in rows(200, 7) if r[2] is not None]
    whole = h.prior_agg(frame(spark, data), ["k"], "t", all_aggs())
    cut = h.prior_agg(frame(spark, [r for r in data if r[2] <= 3000]), ["k"], "t", all_aggs())
    a = sorted(whole.where("s <= 3000").collect(), key=lambda r: r.id)
    b = sorted(cut.collect(), key=lambda r: r.id)
    assert a == b


def test_empty_input(spark):
    d = frame(spark, [])
    assert h.prior_agg(d, ["k"], "t", all_aggs()).columns == [*d.columns, *all_aggs()]
    assert h.prior_agg(d, ["k"], "t", all_aggs()).count() == 0
    assert pd.DataFrame(h.prior_agg(d, ["k"], "t", all_aggs()).collect()).empty


def test_trailing_rows_of_one_moment_are_one_fact(spark, monkeypatch):
    """Copies of a value at a moment are combined before anything runs over them."""
    from statistics import median

    from pitfeat.operators import median as medians

    written, cut = [], medians.cut_lineage

    def counted(df):
        out = cut(df)
        written.append(out.count())
        return out

    monkeypatch.setattr(medians, "cut_lineage", counted)
    # 4,000 rows, 8 moments ten seconds apart, 5 values; twice the middle value at each
    d = spark.range(4000).selectExpr(
        "'a' AS k", "timestamp_seconds(id % 8 * 10) AS t", "cast(least(id div 8 % 6, 4) AS double) AS x", "id % 3 AS u")
    aggs = {"n": h.count(), "total": h.total("x"), "half": h.median("x"), "users": h.distinct("u")}
    got = h.trailing_agg(d, ["k"], "t", 20, aggs, frame_rows=10).distinct().collect()
    rows = [(r.t, r.x, r.u) for r in d.collect()]
    assert len({(r.t, r.x, r.u) for r in got}) == len(set(rows))
    for r in got:
        near = [v for v in rows if 0 <= (r.t - v[0]).total_seconds() <= 20]
        assert (r.n, r.total, r.users) == (len(near), sum(v[1] for v in near), len({v[2] for v in near}))
        assert r.half == median(v[1] for v in near)
    # 16 moments of coming and going with 5 values; questions are two a moment at most
    assert max(written) <= 80


def test_tasks_hold_a_bounded_number_of_rows(spark):
    """More rows than the tasks of the session should hold make more tasks, not larger ones."""
    d = spark.range(1000).selectExpr("id % 90 AS k", "timestamp_seconds(id div 90) AS t", "id % 7 AS v")
    aggs = {"n": h.distinct("v")}
    want = sorted(h.prior_agg(d, ["k"], "t", aggs).collect())
    spark.conf.set("spark.pitfeat.small.bytes", "1")
    spark.conf.set("spark.pitfeat.task.rows", "100")
    try:
        got = h.prior_agg(d, ["k"], "t", aggs)
        assert sorted(got.collect()) == want
        assert got.rdd.getNumPartitions() == 10  # the session has 4 shuffle partitions
    finally:
        spark.conf.unset("spark.pitfeat.small.bytes")
        spark.conf.unset("spark.pitfeat.task.rows")
