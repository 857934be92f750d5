import numpy as np
import pytest
from pyspark.sql import functions as F

from pitfeat.operators import sessions as s
from pitfeat.operators.slices import place


def events(n=400, seed=3):
    r = np.random.default_rng(seed)
    key = np.where(r.random(n) < 0.5, 0, r.integers(1, 9, n)).astype(object)
    key[r.random(n) < 0.03] = None
    sec = np.where(r.random(n) < 0.15, 500, r.integers(0, 3000, n)).astype(object)
    sec[r.random(n) < 0.03] = None
    return [(i, k, None if t is None else float(t)) for i, (k, t) in enumerate(zip(key, sec))]


def frame(spark, data):
    d = spark.createDataFrame(data, "id long, k long, s double")
    return d.withColumn("t", F.expr("timestamp_micros(cast(s * 1000000 as bigint))"))


@pytest.mark.parametrize("placing", [None, 20, 10_000])
@pytest.mark.parametrize("slice_rows", [None, 20, 1])
def test_sessionize_and_stats(spark, slice_rows, placing):
    data, gap = events(), 10
    d = frame(spark, data)
    if placing:
        if slice_rows == 1:
            pytest.skip("covered by 20")
        d, slice_rows = place(d, ["k"], "t", placing), None
    d = s.sessionize(d, ["k"], "t", gap, slice_rows=slice_rows)
    got = s.session_stats(d, ["k"], "t", tie=["id"], slice_rows=slice_rows).collect()
    assert len(got) == len(data)
    want, members = {}, {}
    for k in {q[1] for q in data if q[1] is not None}:
        mine = sorted((q[2], q[0]) for q in data if q[1] == k and q[2] is not None)
        n, last = 0, None
        for sec, i in mine:
            n += last is not None and int(sec) - int(last) > gap
            last = sec
            want[i] = n
            members.setdefault((k, n), []).append((sec, i))
    for r in got:
        assert r.session_n == want.get(r.id)
        if r.session_n is None:
            assert r.session_id is None and r.number_of_hits is None
            continue
        mine = members[r.k, r.session_n]
        assert r.session_id == f"{r.k}_{r.session_n}"
        assert r.number_of_hits == len(mine)
        assert r.hit_number == mine.index((r.s, r.id)) + 1
        assert r.session_time == mine[-1][0] - mine[0][0]


def test_gap_edges(spark):
    data = [(1, 1, 0.0), (2, 1, 1800.0), (3, 2, 0.0), (4, 2, 1800.9), (5, 3, 0.0), (6, 3, 1801.0)]
    got = {r.id: r.session_n for r in s.sessionize(frame(spark, data), ["k"], "t").collect()}
    assert got == {1: 0, 2: 0, 3: 0, 4: 0, 5: 0, 6: 1}


def test_no_shuffle_after_sessionize(spark, tmp_path):
    path = str(tmp_path / "e")
    frame(spark, events()).write.parquet(path)
    d = s.sessionize(place(spark.read.parquet(path), ["k"], "t"), ["k"], "t", 10)
    d = s.session_stats(d, ["k"], "t", tie=["id"])
    d = s.intent_and_success(d, ["k", "session_n"], "t", F.col("id") > 5, F.col("id") > 7)
    plan = d._jdf.queryExecution().sparkPlan().toString() and d._sc._jvm.PythonSQLUtils.explainString(d._jdf.queryExecution(), "simple")
    assert plan.count("Exchange hashpartitioning") == 1, plan


def test_touching_and_flags(spark):
    data = [(1, 1, 0.0), (2, 1, 5.0), (3, 1, 5000.0), (4, 2, 0.0)]
    d = s.sessionize(frame(spark, data), ["k"], "t")
    session = ["k", "session_n"]
    kept = s.sessions_touching(d, session, "t", F.col("id") == 2)
    assert sorted(r.id for r in kept.collect()) == [1, 2]
    flags = s.session_flags(d, session, "t", {"seen": F.col("id") == 1}).collect()
    assert {r.id: r.seen for r in flags} == {1: 1, 2: 1, 3: 0, 4: 0}
    rules = spark.createDataFrame([(1, 1), (3, 1), (4, 1)], "id long, k long")
    assert sorted(r.id for r in s.keep_events(d, rules, ["id", "k"]).collect()) == [1, 3]
