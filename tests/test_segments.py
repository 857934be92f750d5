"""Sessions over ranges of rows against the operators that hold a key in one task."""

import random

import pytest
from pyspark.sql import functions as F

from catalogue import clicks
from catalogue.check import connect, normal
from pitfeat.operators import sessions as s
from pitfeat.operators.segments import in_ranges, sessions_in_ranges

COLUMNS = ["id", "session_n", "session_id", "session_start", "session_end", "number_of_hits", "session_time", "hit_number"]


@pytest.mark.parametrize("ranges", [1, 3, 40])
@pytest.mark.parametrize("spread", [100, 3_000])
def test_sessions_in_ranges(spark, ranges, spread):
    r = random.Random(ranges)
    rows = [(i, 1 if r.random() < 0.8 else r.randrange(2, 6), float(r.randrange(spread)) + r.choice([0, 0.9]))
            for i in range(600)]
    rows += [(1000 + i, 1, 50.0) for i in range(300)] + [(2000, None, 1.0), (2001, 1, None), (2002, 9, 0.0)]
    d = spark.createDataFrame(rows, "id long, k long, s double")
    d = d.withColumn("t", F.timestamp_micros((F.col("s") * 1_000_000).cast("long")))
    gap = 20
    want = s.session_stats(s.sessionize(d, ["k"], "t", gap), ["k"], "t", tie=["id"]).where("k is not null and t is not null")
    got = sessions_in_ranges(d, ["k"], "t", ["id"], gap, ranges)
    assert sorted(map(tuple, got.select(*COLUMNS).collect())) == sorted(map(tuple, want.select(*COLUMNS).collect()))


def test_one_time_stamp_spans_ranges(spark):
    d = spark.range(4000).select("id", F.lit(1).alias("k"), F.lit("2024-01-01").cast("timestamp").alias("t"))
    sizes = [r["count"] for r in in_ranges(d, ["k"], "t", ["id"], 100).groupBy("_range").count().collect()]
    assert max(sizes) <= 2 * 40


def test_newest_row_with_hot_visitors(spark, monkeypatch):
    """Few actions and exchanges, and the same rows, with every visitor above the slice size."""
    sf = "/root/testdata/sf0.001"
    store = spark._jsparkSession.sharedState().statusStore()
    spark.conf.set("spark.pitfeat.small.bytes", "0")
    spark.conf.set("spark.pitfeat.slice.rows", "40")
    try:
        before = store.executionsCount()
        d = clicks.click_features_latest(spark, sf)
        assert store.executionsCount() - before <= 10
        plan = spark._jvm.PythonSQLUtils.explainString(d._jdf.queryExecution(), "simple")
        assert plan.count("Exchange hashpartitioning") <= 4
        got = normal(d.columns, d.collect())
    finally:
        spark.conf.unset("spark.pitfeat.small.bytes")
        spark.conf.unset("spark.pitfeat.slice.rows")
    found = connect(sf).execute(clicks.QUERIES["click_features_latest"][1])
    assert got == normal([c[0] for c in found.description], found.fetchall())
