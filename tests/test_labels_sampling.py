import numpy as np
import pytest
from pyspark.sql import functions as F

from pitfeat.operators import labels as lab
from pitfeat.operators import sampling


CHAIN = [("a", "d1", 1), ("b", "d1", 0), ("b", "d2", 0), ("c", "d2", 0), ("e", "d9", 0),
         (None, "d9", 1), ("f", None, 0)]


@pytest.mark.parametrize("rounds,want", [
    (1, {"a", "b", "e"}), (2, {"a", "b", "c", "e"}), (None, {"a", "b", "c", "e"}),
])
def test_two_hop(spark, rounds, want):
    d = spark.createDataFrame(CHAIN, "p string, d string, y int")
    got = lab.propagate_two_hop(d, "p", "d", "y", "z", rounds).collect()
    assert len(got) == len(CHAIN)
    assert {r.p for r in got if r.z == 1 and r.p} == want
    # a labelled row without a person keeps its label, and gives it to no other
    assert [r.z for r in got if r.p is None] == [1]


def test_fixpoint_of_a_long_chain(spark, monkeypatch):
    """1,000 devices in a row: the label reaches the end in the logarithm of the length."""
    from pitfeat.operators import components

    written, cut = [], components.cut_lineage
    monkeypatch.setattr(components, "cut_lineage", lambda df: written.append(1) or cut(df))
    chain = [(f"p{i}", f"d{i + k}", int(i == 0)) for i in range(1000) for k in (0, 1)]
    other = [(f"q{i}", f"e{i // 3}", 0) for i in range(30)] + [(None, "e1", 0), ("q1", None, 0)]
    d = spark.createDataFrame(chain + other, "p string, d string, y int")
    got = lab.propagate_two_hop(d, "p", "d", "y", rounds=None)
    assert {r.p for r in got.where("y = 1").collect()} == {p for p, _, _ in chain}
    assert len(written) - 1 <= 12


def test_connected_against_union_find(spark):
    from pitfeat.operators.components import connected

    g = np.random.default_rng(3)
    links = [tuple(map(int, g.integers(0, 300, 2))) for _ in range(220)] + [(400, k) for k in range(401, 460)]
    parent = list(range(500))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    want = {(i, find(i)) for pair in links if pair[0] != pair[1] for i in pair}
    got = connected(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert connected(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_label_by_entity(spark):
    d = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (None, 1), (None, 0)], "k long, y int")
    got = sorted((r.k or 0, r.y) for r in lab.propagate_label(d, ["k"], "y").collect())
    assert got == [(0, 0), (0, 1), (1, 1), (1, 1), (2, 0)]


def population(spark, copies=False):
    g = np.random.default_rng(5)
    rows = [(7, 7.0, 0)] * 1500 if copies else []
    rows += [(int(i), float(x), int(x > 0.9)) for i, x in enumerate(g.random(1500))]
    return spark.createDataFrame(rows, "id long, x double, y int").repartition(5)


@pytest.mark.parametrize("copies", [False, True])
@pytest.mark.parametrize("ratio", [0.5, 3.0, 4.0, 1000.0])
def test_undersample_is_exact_and_repeatable(spark, copies, ratio):
    d = population(spark, copies)
    bad, good = d.where("y = 1").count(), d.where("y = 0").count()
    a = sorted(map(tuple, sampling.undersample(d, "y", ratio, 3).collect()))
    b = sorted(map(tuple, sampling.undersample(d.repartition(2), "y", ratio, 3).collect()))
    assert a == b
    assert sum(r[2] == 1 for r in a) == bad
    assert sum(r[2] == 0 for r in a) == min(good, int(ratio * bad))


def test_sample_by_period(spark):
    d = population(spark)
    period = F.when(F.col("id") < 700, "old").otherwise("new")
    got = sampling.sample_by_period(d, "y", period, {"old": 1.0, "new": 0.5})
    assert got.columns == d.columns
    n = d.where("y = 1").count()
    counts = {r.p: r["count"] for r in got.where("y = 0").groupBy(period.alias("p")).count().collect()}
    assert counts == {"old": n, "new": n // 2}


def test_time_split(spark):
    d = spark.createDataFrame([(1, 0), (5, 0), (9, 0), (5, 1)], "t long, y int")
    bounds = {"train": {0: (0, 5), 1: (0, 9)}, "test": {0: (5, 9), 1: (9, 10)}}
    got = sampling.time_split(d, "t", bounds, "y").collect()
    assert sorted((r.t, r.y, r.split) for r in got) == [
        (1, 0, "train"), (5, 0, "test"), (5, 1, "train"),
    ]


def test_sample_of_many_copies_and_nulls(spark):
    """Copies are written out in parts; null keys and empty input are defined."""
    rows = spark.range(10_000).selectExpr("0 AS label", "CAST(NULL AS STRING) AS k")
    one = spark.createDataFrame([(1, "a")] * 3, "label int, k string")
    d = rows.unionByName(one)
    got = sampling.undersample(d, "label", 2000.0, 1, ["k"]).groupBy("label").count().collect()
    assert {r.label: r["count"] for r in got} == {0: 6000, 1: 3}
    assert sampling.undersample(d.where("false"), "label", 2.0).count() == 0
    assert sampling.undersample(d.where("label = 0"), "label", 2.0).count() == 0


def test_fixpoint_links_persons_only(spark, monkeypatch):
    """Devices are no nodes, and persons keep their type."""
    asked, connected = [], lab.connected
    monkeypatch.setattr(lab, "connected", lambda links, a, b: asked.append(links) or connected(links, a, b))
    rows = [(i, 100 + i // 2 * 2 + k, int(i == 0)) for i in range(40) for k in (0, 1, 2)] + [(99, 7, 0), (None, 7, 1)]
    got = lab.propagate_two_hop(spark.createDataFrame(rows, "p long, d long, y int"), "p", "d", "y", rounds=None)
    assert {r.p for r in got.where("y = 1").collect()} == {*range(40), 99, None}
    assert {t for _, t in asked[0].dtypes} == {"bigint"}
    assert {x for r in asked[0].collect() for x in r} == {*range(40), 99}
