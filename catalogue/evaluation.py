"""Evaluation queries: score = discount x 10 of a line, label = returned."""

from pyspark.sql import functions as F

from catalogue.profiles import lines
from catalogue.tables import orders, rounded
from pitfeat.operators import evaluate as ev

CUTS = [0.5, 0.75]
SWEEP = [0.75, 0.8, 0.82, 0.83, 0.85, 0.9, 0.95, 0.99]


def scored(spark, sf):
    return lines(spark, sf).withColumn("score", F.col("l_discount") * 10)


def confusion_report(spark, sf):
    d = ev.classification_report(scored(spark, sf), "score", "label", 0.5)
    return d.select("class", *rounded(9, "precision", "recall", "f1"), "support")


def confusion_matrix(spark, sf):
    return ev.confusion(scored(spark, sf), "score", "label", 0.5)


def threshold_sweep(spark, sf):
    return ev.threshold_sweep(scored(spark, sf), "score", SWEEP).select(
        "threshold", "n_red", *rounded(9, "pct_red"))


def curve(spark, sf):
    return ev.pr_curve(scored(spark, sf), "score", "label")


def pr_points(spark, sf):
    return curve(spark, sf).select("threshold", "tp", "fp", *rounded(9, "precision", "recall"))


def threshold_at_recall(spark, sf):
    return ev.threshold_at(curve(spark, sf), recall=0.65)


def threshold_at_precision(spark, sf):
    """Lowest cut-off at which a third of the flagged lines were returned."""
    return ev.threshold_at(curve(spark, sf), precision=0.333)


def decisions(spark, sf):
    d = scored(spark, sf)
    two = ev.band("score", [0.4], [ev.GREEN, ev.RED])
    three = ev.band("score", CUTS, [ev.GREEN, ev.YELLOW, ev.RED])
    return d.groupBy(two.alias("two_band"), three.alias("three_band")).agg(F.count("*").alias("n"))


def band_slices(spark, sf, spread=None):
    d = ev.band_slices(scored(spark, sf), "score", "label", CUTS, [ev.GREEN, ev.YELLOW, ev.RED],
                       spread=spread)
    return d.select("band", "label", "n", *rounded(9, "mean", "min", "max", "q50", "q90"), "correct")


def monitor_join(spark, sf):
    """Mean line score per order as the log, failed orders as labels learnt later."""
    log = scored(spark, sf).groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max("score").alias("score")
    )
    known = orders(spark, sf).where("o_orderstatus <> 'P'").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "O", 1).otherwise(0).alias("label")
    )
    d = ev.monitor(log, known, ["o_orderkey"], "score", "label", 0.85)
    return d.select("class", *rounded(9, "precision", "recall", "f1"), "support")


SCORED = """
      WITH d AS (SELECT l_orderkey, l_discount * 10 AS score,
                        CAST(l_returnflag = 'R' AS INT) AS label FROM lineitem)"""
REPORT = """,
      c AS (
        SELECT count(*) FILTER (yes AND label = 1) AS tp, count(*) FILTER (yes AND label = 0) AS fp,
               count(*) FILTER (NOT yes AND label = 1) AS fn,
               count(*) FILTER (NOT yes AND label = 0) AS tn FROM j)
      SELECT 1 AS class, round(tp / (tp + fp), 9) AS precision, round(tp / (tp + fn), 9) AS recall,
             round(2 * tp / (2 * tp + fp + fn), 9) AS f1, tp + fn AS support FROM c
      UNION ALL
      SELECT 0, round(tn / (tn + fn), 9), round(tn / (tn + fp), 9),
             round(2 * tn / (2 * tn + fp + fn), 9), tn + fp FROM c"""
CURVE = SCORED + """,
      cuts AS (SELECT DISTINCT score AS threshold FROM d),
      curve AS (
        SELECT threshold, CAST(sum(label) AS BIGINT) AS tp,
               CAST(count(*) - sum(label) AS BIGINT) AS fp,
               sum(label) / count(*) AS precision,
               sum(label) / (SELECT sum(label) FROM d) AS recall
        FROM cuts JOIN d ON score >= threshold GROUP BY threshold)"""
BAND = "CASE WHEN score >= 0.75 THEN 'RED' WHEN score >= 0.5 THEN 'YELLOW' ELSE 'GREEN' END"
SLICES_SQL = SCORED + f"""
      SELECT {BAND} AS band, label, count(*) AS n, round(avg(score), 9) AS mean,
             round(min(score), 9) AS min, round(max(score), 9) AS max,
             round(quantile_cont(score, 0.5), 9) AS q50, round(quantile_cont(score, 0.9), 9) AS q90,
             CAST(({BAND} = 'RED') = (label = 1) AS INT) AS correct
      FROM d GROUP BY ALL"""

QUERIES = {
    "confusion_report": (confusion_report, SCORED + ", j AS (SELECT *, score >= 0.5 AS yes FROM d)"
                         + REPORT),
    "confusion_matrix": (confusion_matrix, SCORED + """
      SELECT count(*) FILTER (score >= 0.5 AND label = 1) AS tp,
             count(*) FILTER (score >= 0.5 AND label = 0) AS fp,
             count(*) FILTER (score < 0.5 AND label = 1) AS fn,
             count(*) FILTER (score < 0.5 AND label = 0) AS tn FROM d"""),
    "threshold_sweep": (threshold_sweep, SCORED + f"""
      SELECT CAST(t AS DOUBLE) AS threshold, count(*) FILTER (score >= t) AS n_red,
             round(count(*) FILTER (score >= t) * 100 / count(*), 9) AS pct_red
      FROM d, (SELECT CAST(unnest({SWEEP}) AS DOUBLE) AS t) GROUP BY t"""),
    "pr_points": (pr_points, CURVE + """
      SELECT threshold, tp, fp, round(precision, 9) AS precision, round(recall, 9) AS recall
      FROM curve"""),
    "threshold_at_recall": (threshold_at_recall, CURVE + """
      SELECT max(threshold) AS threshold FROM curve WHERE recall >= 0.65"""),
    "threshold_at_precision": (threshold_at_precision, CURVE + """
      SELECT min(threshold) AS threshold FROM curve WHERE precision >= 0.333"""),
    "decisions": (decisions, SCORED + f"""
      SELECT CASE WHEN score < 0.4 THEN 'GREEN' ELSE 'RED' END AS two_band,
             {BAND} AS three_band, count(*) AS n FROM d GROUP BY ALL"""),
    "band_slices": (band_slices, SLICES_SQL),
    "band_slices_spread": (lambda sp, sf: band_slices(sp, sf, True), SLICES_SQL),
    "monitor_join": (monitor_join, SCORED + """,
      j AS (
        SELECT max(score) >= 0.85 AS yes, CAST(o_orderstatus = 'O' AS INT) AS label
        FROM d JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'P'
        GROUP BY o_orderkey, o_orderstatus)""" + REPORT),
}
