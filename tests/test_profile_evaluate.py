import numpy as np
import pytest

from pitfeat.operators import evaluate as ev
from pitfeat.operators import prep
from pitfeat.operators import profile as p


def frame(spark, n=600):
    g = np.random.default_rng(8)
    x = g.normal(0, 20, n).round(1).astype(object)
    x[g.random(n) < 0.05] = None
    y = g.integers(0, 2, n)
    score = (g.random(n) + 0.3 * y).round(3)
    rows = [(a if a is None else float(a), int(b), float(s)) for a, b, s in zip(x, y, score)]
    return rows, spark.createDataFrame(rows, "x double, y int, score double")


@pytest.mark.parametrize("slice_rows,spread", [(None, False), (None, True), (40, True)])
def test_quantiles(spark, slice_rows, spread):
    rows, d = frame(spark)
    probs = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.93, "e": 1.0}
    got = p.exact_quantiles(d, ["y"], "x", probs, slice_rows, spread).collect()
    for r in got:
        mine = [q[0] for q in rows if q[1] == r.y and q[0] is not None]
        assert [r[n] for n in probs] == pytest.approx(
            list(np.quantile(mine, list(probs.values())))
        )


def test_quantiles_of_whole_frame_and_infinite_values(spark):
    """Both ways give the same, also over all rows and without any."""
    inf = float("inf")
    d = spark.createDataFrame([(v,) for v in [1.0, 2.0, inf, inf, inf, None]], "x double")
    probs = {"a": 0.0, "b": 0.25, "c": 0.4, "d": 0.5, "e": 1.0}
    for frame_ in (d, d.where("x < 3"), d.where("false")):
        short, spread = (p.exact_quantiles(frame_, [], "x", probs, None, s).collect() for s in (False, True))
        assert [tuple(r) for r in short] == [tuple(r) for r in spread]
    assert p.exact_quantiles(d, [], "x", probs, 2, True).first().d == inf


@pytest.mark.parametrize("slice_rows", [None, 25])
def test_pr_curve(spark, slice_rows):
    rows, d = frame(spark)
    got = ev.pr_curve(d, "score", "y", slice_rows).collect()
    assert len(got) == len({q[2] for q in rows})
    bad = sum(q[1] for q in rows)
    for r in got:
        flagged = [q for q in rows if q[2] >= r.threshold]
        tp = sum(q[1] for q in flagged)
        assert (r.tp, r.fp) == (tp, len(flagged) - tp)
        assert (r.precision, r.recall) == pytest.approx((tp / len(flagged), tp / bad))
    curve = ev.pr_curve(d, "score", "y", slice_rows)
    best = ev.threshold_at(curve, recall=0.8).first()[0]
    assert best == max(r.threshold for r in got if r.recall >= 0.8)


def test_confusion_at_threshold(spark):
    d = spark.createDataFrame([(0.6, 1), (0.5, 0), (0.4, 1), (0.1, 0)], "s double, y int")
    assert tuple(ev.confusion(d, "s", "y", 0.5).first()) == (1, 1, 1, 1)
    report = {r["class"]: r for r in ev.classification_report(d, "s", "y", 0.5).collect()}
    assert report[1].precision == 0.5 and report[0].recall == 0.5 and report[0].support == 2
    none = {r["class"]: r for r in ev.classification_report(d, "s", "y", 2.0).collect()}
    assert none[1].precision == 0.0 and none[0].recall == 1.0
    bands = d.select(ev.band("s", [0.4, 0.5], ["G", "Y", "R"]).alias("b")).collect()
    assert [r.b for r in bands] == ["R", "R", "Y", "G"]
    sliced = ev.band_slices(d, "s", "y", [0.4, 0.5], ["G", "Y", "R"]).collect()
    assert sum(r.n for r in sliced) == 4
    sweep = ev.threshold_sweep(d, "s", [0.1, 0.5, 0.9]).collect()
    assert [r.pct_red for r in sweep] == [100.0, 50.0, 0.0]


def test_rates_and_bins(spark):
    d = spark.createDataFrame(
        [("a", 1, 0.0), ("a", 0, 9.9), ("a", 0, 10.0), ("b", 1, 99.0), ("c", 0, None), (None, 1, 1.0)],
        "v string, y int, x double",
    )
    assert [tuple(r) for r in p.lift(d, ["v"], "y").collect()] == [("a", 1, 2, 50.0)]
    assert p.lift_top_k(d, "v", "y", 1).first().lift == pytest.approx(100 / 3)
    bins = {r.bin: (r.n, r.rate) for r in p.binned_rate(d, "x", "y", [0, 10, 100]).collect()}
    assert bins == {0: (3, pytest.approx(200 / 3)), 1: (2, 50.0)}
    nulls = {r["column"]: r.nulls for r in p.null_audit(d).collect()}
    assert nulls == {"v": 1, "y": 0, "x": 1}
    hist = p.histogram(d, "x", "y", 2, 0, 10).collect()
    assert sum(r.n for r in hist) == 4
    shares = {r.y: r.share_below for r in p.share_below(d, "x", "y", 10).collect()}
    assert shares == {1: pytest.approx(2 / 3), 0: pytest.approx(1 / 3)}


def test_impute_and_scale(spark):
    d = spark.createDataFrame(
        [("a", 1.0), ("a", 3.0), ("a", None), ("b", None), ("b", None)], "g string, x double"
    )
    got = prep.impute_group_median(d, ["x"], ["g"]).collect()
    assert sorted(r.x for r in got) == [1.0, 2.0, 2.0, 2.0, 3.0]
    assert sorted(r.x for r in prep.impute_mean(d, ["x"]).collect())[1:4] == [2.0, 2.0, 2.0]
    scaled = [r.x for r in prep.standardise(d.na.drop(), ["x"]).collect()]
    assert sorted(scaled) == pytest.approx([-1.0, 1.0])
    text = spark.createDataFrame([("1.5",), ("x",)], "v string")
    assert [r.v for r in prep.to_numbers(text, ["v"]).collect()] == [1.5, None]


def test_power_fit_recovers_symmetry(spark):
    g = np.random.default_rng(1)
    d = spark.createDataFrame([(float(v),) for v in np.expm1(g.normal(2, 0.5, 800))], "x double")
    lambdas = prep.fit_power(d, ["x"])
    # the logarithm of 1 + x is normal, so lambda is near 0
    assert abs(lambdas["x"]) < 0.2
    out = np.array([r.x for r in prep.power_transform(d, lambdas).collect()])
    assert abs(out.mean()) < 1e-9 and abs(out.std() - 1) < 1e-9
