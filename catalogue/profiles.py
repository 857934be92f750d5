"""Exploratory tables on ``lineitem`` and ``orders``; class 1 = returned or failed."""

from pyspark.sql import functions as F

from catalogue.tables import lineitem, orders, rounded
from pitfeat.operators import profile as p
from pitfeat.operators.slices import group_transform


def lines(spark, sf):
    return lineitem(spark, sf).withColumn(
        "label", F.when(F.col("l_returnflag") == "R", 1).otherwise(0)
    )


def failed_orders(spark, sf):
    return orders(spark, sf).withColumn(
        "label", F.when(F.col("o_orderstatus") == "O", 1).otherwise(0)
    )


NUMBERS = ["l_quantity", "l_extendedprice", "l_tax"]


def describe_by_label(spark, sf, spread=None):
    d = p.describe_by(lines(spark, sf), NUMBERS, "label", spread=spread)
    return d.select("label", "column", "n", *rounded(4, "mean", "std"), "min",
                    *rounded(6, "q25", "q50", "q75", "q90"), "max")


def null_audit(spark, sf):
    o = orders(spark, sf)
    gaps = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    return p.null_audit(o.select("o_orderkey", "o_orderpriority", gaps.alias("paid")))


def value_share(spark, sf):
    return p.value_counts(lines(spark, sf), "l_linestatus", ["label"]).select(
        "label", "l_linestatus", "n", *rounded(9, "share"))


def value_share_all(spark, sf):
    return p.value_counts(orders(spark, sf), "o_orderpriority").select(
        "o_orderpriority", "n", *rounded(9, "share"))


def rate_by_value(spark, sf):
    return p.rate_by_value(lines(spark, sf), "l_linenumber", "label").select(
        "l_linenumber", "n", *rounded(9, "rate"))


def lift_ratio(spark, sf):
    return p.lift(lines(spark, sf), ["l_suppkey"], "label").select(
        "l_suppkey", "positives", "negatives", *rounded(9, "lift"))


def lift_top_k(spark, sf):
    return p.lift_top_k(lines(spark, sf), "l_partkey", "label", 30).select(
        "l_partkey", "positives", "negatives", *rounded(9, "lift"))


EDGES = [0.0, 10.0, 20.0, 30.0, 40.0, float("inf")]


def binned_rate(spark, sf):
    return p.binned_rate(lines(spark, sf), "l_quantity", "label", EDGES).select(
        "bin", "n", *rounded(9, "rate"))


def histogram(spark, sf, within="class"):
    return p.histogram(lines(spark, sf), "l_extendedprice", "label", 10, 0, 50_000, within).select(
        "label", "bin", "n", *rounded(9, "share"))


def box_stats(spark, sf, spread=None):
    d = p.box_stats(lines(spark, sf), "l_extendedprice", "label", spread=spread)
    return d.select("label", *rounded(6, "low", "q25", "q50", "q75", "high"))


def month_rate(spark, sf):
    return p.month_rate(failed_orders(spark, sf), "o_orderpriority", "o_orderdate", "label").select(
        "o_orderpriority", "month", "positives", "negatives", *rounded(9, "lift"))


def share_below(spark, sf):
    return p.share_below(lines(spark, sf), "l_extendedprice", "label", 30_000).select(
        "label", *rounded(9, "share_below"))


def entity_slices(spark, sf):
    return p.entity_slices(failed_orders(spark, sf), "o_custkey", ["o_orderpriority", "label"])


def activity_counts(spark, sf):
    return p.activity_counts(
        orders(spark, sf), ["o_custkey"],
        {"succeeded": F.col("o_orderstatus") == "F", "pending": F.col("o_orderstatus") == "P"},
    )


def group_values(spark, sf):
    """First and last time, mean and row count of the customer on each order."""
    d = group_transform(
        orders(spark, sf), ["o_custkey"],
        {"lowest": F.min("o_totalprice"), "highest": F.max("o_totalprice"),
         "mean": F.avg("o_totalprice"), "n": F.count("*")}, "o_orderkey",
    )
    return d.select("o_orderkey", "lowest", "highest", *rounded(6, "mean"), "n")


def group_median_nunique(spark, sf, spread=None):
    """Median amount and number of priorities of the customer on each order."""
    d = p.group_medians(orders(spark, sf), ["o_custkey"], {"half": "o_totalprice"}, spread=spread)
    d = group_transform(d, ["o_custkey"], {}, "o_orderkey", distinct={"kinds": "o_orderpriority"})
    return d.select("o_orderkey", "kinds", *rounded(6, "half"))


LINES = """
      WITH d AS (SELECT *, CAST(l_returnflag = 'R' AS INT) AS label FROM lineitem)"""
DESCRIBE_SQL = LINES + """,
      long AS (
        SELECT label, 'l_quantity' AS "column", l_quantity AS v FROM d UNION ALL
        SELECT label, 'l_extendedprice', l_extendedprice FROM d UNION ALL
        SELECT label, 'l_tax', l_tax FROM d)
      SELECT label, "column", count(*) AS n, round(avg(v), 4) AS mean,
             round(stddev_samp(v), 4) AS std, min(v) AS min,
             round(quantile_cont(v, 0.25), 6) AS q25, round(quantile_cont(v, 0.5), 6) AS q50,
             round(quantile_cont(v, 0.75), 6) AS q75, round(quantile_cont(v, 0.9), 6) AS q90,
             max(v) AS max
      FROM long GROUP BY label, "column" """
HISTOGRAM_SQL = LINES + """,
      b AS (SELECT label, CAST(least(floor(l_extendedprice / 5000), 9) AS INT) AS bin
            FROM d WHERE l_extendedprice BETWEEN 0 AND 50000),
      c AS (SELECT label, bin, count(*) AS n FROM b GROUP BY label, bin)
      SELECT label, bin, n, round(n / sum(n) OVER ({over}), 9) AS share FROM c"""
BOX_SQL = LINES + """,
      v AS (SELECT label, ln(greatest(1, l_extendedprice)) AS v FROM d)
      SELECT label, round(min(v), 6) AS low, round(quantile_cont(v, 0.25), 6) AS q25,
             round(quantile_cont(v, 0.5), 6) AS q50, round(quantile_cont(v, 0.75), 6) AS q75,
             round(max(v), 6) AS high
      FROM v GROUP BY label"""
MEDIAN_SQL = """
      SELECT o_orderkey, kinds, half FROM orders JOIN (
        SELECT o_custkey, count(DISTINCT o_orderpriority) AS kinds,
               round(median(o_totalprice), 6) AS half
        FROM orders GROUP BY o_custkey) USING (o_custkey)"""

QUERIES = {
    "group_median_nunique": (group_median_nunique, MEDIAN_SQL),
    "group_median_nunique_spread": (lambda sp, sf: group_median_nunique(sp, sf, True), MEDIAN_SQL),
    "describe_by_label": (describe_by_label, DESCRIBE_SQL),
    "describe_by_label_spread": (lambda sp, sf: describe_by_label(sp, sf, True), DESCRIBE_SQL),
    "null_audit": (null_audit, """
      SELECT 'o_orderkey' AS "column", count(*) FILTER (o_orderkey IS NULL) AS nulls FROM orders
      UNION ALL SELECT 'o_orderpriority', count(*) FILTER (o_orderpriority IS NULL) FROM orders
      UNION ALL SELECT 'paid', count(*) FILTER (o_orderstatus = 'P') FROM orders"""),
    "value_share": (value_share, LINES + """
      SELECT label, l_linestatus, count(*) AS n,
             round(count(*) / sum(count(*)) OVER (PARTITION BY label), 9) AS share
      FROM d GROUP BY label, l_linestatus"""),
    "value_share_all": (value_share_all, """
      SELECT o_orderpriority, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 9) AS share
      FROM orders GROUP BY o_orderpriority"""),
    "rate_by_value": (rate_by_value, LINES + """
      SELECT l_linenumber, count(*) AS n, round(avg(label) * 100, 9) AS rate
      FROM d GROUP BY l_linenumber"""),
    "lift_ratio": (lift_ratio, LINES + """
      SELECT l_suppkey, CAST(sum(label) AS BIGINT) AS positives, CAST(count(*) - sum(label) AS BIGINT) AS negatives,
             round(sum(label) * 100 / (count(*) - sum(label)), 9) AS lift
      FROM d GROUP BY l_suppkey HAVING sum(label) > 0 AND sum(label) < count(*)"""),
    "lift_top_k": (lift_top_k, LINES + """
      SELECT l_partkey, CAST(sum(label) AS BIGINT) AS positives, CAST(count(*) - sum(label) AS BIGINT) AS negatives,
             round(sum(label) * 100 / count(*), 9) AS lift
      FROM d GROUP BY l_partkey HAVING sum(label) > 0 AND sum(label) < count(*)
      ORDER BY sum(label) * 100 / count(*) DESC, l_partkey LIMIT 30"""),
    "binned_rate": (binned_rate, LINES + """
      SELECT least(CAST(floor(l_quantity / 10) AS INT), 4) AS bin, count(*) AS n,
             round(avg(label) * 100, 9) AS rate
      FROM d GROUP BY 1"""),
    "histogram": (histogram, HISTOGRAM_SQL.format(over="PARTITION BY label")),
    "histogram_of_all": (lambda sp, sf: histogram(sp, sf, "all"), HISTOGRAM_SQL.format(over="")),
    "box_stats": (box_stats, BOX_SQL),
    "box_stats_spread": (lambda sp, sf: box_stats(sp, sf, True), BOX_SQL),
    "month_rate": (month_rate, """
      WITH d AS (SELECT *, CAST(o_orderstatus = 'O' AS INT) AS label FROM orders)
      SELECT o_orderpriority, CAST(month(o_orderdate) AS INT) AS month, CAST(sum(label) AS BIGINT) AS positives,
             CAST(count(*) - sum(label) AS BIGINT) AS negatives,
             round(sum(label) * 100 / (count(*) - sum(label)), 9) AS lift
      FROM d GROUP BY 1, 2 HAVING sum(label) > 0 AND sum(label) < count(*)"""),
    "share_below": (share_below, LINES + """
      SELECT label, round(avg(CAST(l_extendedprice < 30000 AS INT)), 9) AS share_below
      FROM d GROUP BY label"""),
    "entity_slices": (entity_slices, """
      SELECT o_orderpriority, CAST(o_orderstatus = 'O' AS INT) AS label,
             count(DISTINCT o_custkey) AS entities, count(*) AS n
      FROM orders GROUP BY 1, 2"""),
    "activity_counts": (activity_counts, """
      SELECT o_custkey, count(*) AS n, count(*) - 1 AS n_before_last,
             max(CAST(o_orderstatus = 'F' AS INT)) AS succeeded,
             max(CAST(o_orderstatus = 'P' AS INT)) AS pending
      FROM orders GROUP BY o_custkey"""),
    "group_values": (group_values, """
      SELECT o_orderkey, lowest, highest, mean, n FROM orders JOIN (
        SELECT o_custkey, min(o_totalprice) AS lowest, max(o_totalprice) AS highest,
               round(avg(o_totalprice), 6) AS mean, count(*) AS n
        FROM orders GROUP BY o_custkey) USING (o_custkey)"""),
}
