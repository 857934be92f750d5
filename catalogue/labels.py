"""Label spreading and sampling on ``lineitem``: person = order, device = part."""

from pyspark.sql import functions as F

from catalogue.tables import lineitem, orders
from pitfeat.operators import labels as lab
from pitfeat.operators import sampling
from pitfeat.plans.training import balanced

KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def seeded(spark, sf):
    seed = (
        (F.col("l_quantity") == 50) & (F.col("l_discount") == 0.1)
        & (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")
    )
    d = lineitem(spark, sf).withColumn("label", F.when(seed, 1).otherwise(0))
    return d.select(*KEYS, "label")


def label_by_entity(spark, sf):
    return lab.propagate_label(seeded(spark, sf), ["l_partkey"], "label")


def label_two_hop(spark, sf, rounds=1):
    return lab.propagate_two_hop(
        seeded(spark, sf), "l_orderkey", "l_partkey", "label", rounds=rounds
    )


def label_fixpoint(spark, sf):
    """Until nothing changes."""
    return lab.propagate_two_hop(
        seeded(spark, sf), "l_orderkey", "l_partkey", "label", rounds=None
    )


def returned(spark, sf):
    return lineitem(spark, sf).withColumn("label", F.when(F.col("l_returnflag") == "R", 1).otherwise(0))


def undersample_ratio(spark, sf):
    """Sizes of an undersampled set: all labelled lines, 1.5 others for each."""
    d = returned(spark, sf)
    d = sampling.undersample(d, "label", 1.5, 42)
    return d.groupBy("label").agg(F.count("*").alias("n"))


def undersampled_rows(spark, sf):
    d = sampling.undersample(returned(spark, sf), "label", 0.5, 42, KEYS)
    return d.select(*KEYS, "label")


def balanced_rows(spark, sf):
    """Lines that have a tax: all returned ones, and one other for four of them."""
    d = lineitem(spark, sf).withColumns({
        "tax": F.when(F.col("l_linenumber") % 3 != 0, F.col("l_tax")),
        "label": F.when(F.col("l_returnflag") == "R", 1).otherwise(0),
    })
    return balanced(d, "label", ["tax"], 0.25, 3, KEYS).select(*KEYS, "tax", "label")


def period_sample_rows(spark, sf):
    """All labelled lines, and those drawn from each period."""
    period = F.when(F.col("l_shipdate") >= "2000-01-01", "recent").otherwise("older")
    d = sampling.sample_by_period(returned(spark, sf), "label", period,
                                  {"recent": 0.2, "older": 0.5}, 7, KEYS)
    return d.select(*KEYS, "label")


def period_sample(spark, sf):
    """Sizes per period: as many recent others as labelled, and half as many older ones."""
    recent = F.col("l_shipdate") >= "2000-01-01"
    period = F.when(recent, "recent").otherwise("older")
    d = sampling.sample_by_period(returned(spark, sf), "label", period,
                                  {"recent": 0.2, "older": 0.5})
    d = d.withColumn("period", period)
    return d.where("label = 0").groupBy("period").agg(F.count("*").alias("n"))


def time_split(spark, sf):
    """Train and test by class and order date, the other class only when settled."""
    d = orders(spark, sf).withColumn("label", F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0))
    bounds = {
        "train": {0: ("1997-01-01", "2000-01-01"), 1: ("1995-01-01", "2000-01-01")},
        "test": {0: ("2000-01-01", "2001-01-01"), 1: ("2000-01-01", "2001-01-01")},
    }
    d = sampling.time_split(d, "o_orderdate", bounds, "label", {0: F.col("o_orderstatus") == "F"})
    return d.select("o_orderkey", "label", "split")


SEED = """CAST(l_quantity = 50 AND l_discount = 0.1 AND l_returnflag = 'R'
              AND l_linestatus = 'O' AS INT)"""
ROWS = f"""
      WITH d AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, {SEED} AS label
                 FROM lineitem)"""
ONE = """,
      p1 AS (
        SELECT DISTINCT l_orderkey FROM d WHERE label = 1 OR l_partkey IN (
          SELECT l_partkey FROM d WHERE label = 1))"""
TWO = ONE + """,
      p2 AS (
        SELECT DISTINCT l_orderkey FROM d WHERE l_partkey IN (
          SELECT l_partkey FROM d WHERE l_orderkey IN (SELECT l_orderkey FROM p1)))"""
MARKED = """
      SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
             CAST(l_orderkey IN (SELECT l_orderkey FROM {p}) AS INT) AS label FROM d"""

# lines in the order in which a sample takes them
DRAWN = """
      WITH d AS (
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, {period} AS period,
               CAST(l_returnflag = 'R' AS INT) AS label,
               md5(concat_ws('|', {seed}, l_orderkey, l_partkey, l_suppkey, l_linenumber)) AS h
        FROM lineitem),
      ranked AS (
        SELECT *, row_number() OVER (PARTITION BY label, period ORDER BY h) AS i FROM d)"""

QUERIES = {
    "label_by_entity": (label_by_entity, ROWS + """
      SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
             CAST(l_partkey IN (SELECT l_partkey FROM d WHERE label = 1) AS INT) AS label
      FROM d"""),
    "label_two_hop": (label_two_hop, ROWS + ONE + MARKED.format(p="p1")),
    "label_two_rounds": (lambda sp, sf: label_two_hop(sp, sf, 2), ROWS + TWO + MARKED.format(p="p2")),
    "label_fixpoint": (label_fixpoint, f"""
      WITH RECURSIVE d AS (
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, {SEED} AS label FROM lineitem),
      reach AS (
        SELECT DISTINCT l_orderkey FROM d WHERE label = 1
        UNION
        SELECT b.l_orderkey FROM reach r JOIN d a ON a.l_orderkey = r.l_orderkey
          JOIN d b ON b.l_partkey = a.l_partkey)
      SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
             CAST(l_orderkey IN (SELECT l_orderkey FROM reach) AS INT) AS label FROM d"""),
    "undersample_ratio": (undersample_ratio, """
      WITH c AS (
        SELECT count(*) FILTER (l_returnflag = 'R') AS p, count(*) FILTER (l_returnflag <> 'R') AS q
        FROM lineitem)
      SELECT 1 AS label, p AS n FROM c
      UNION ALL SELECT 0, least(q, CAST(floor(p * 1.5) AS BIGINT)) FROM c"""),
    "undersampled_rows": (undersampled_rows, DRAWN.format(seed=42, period="'all'") + """,
      want AS (SELECT CAST(floor(count(*) * 0.5) AS BIGINT) AS w FROM d WHERE label = 1)
      SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, label
      FROM ranked, want WHERE label = 1 OR i <= w"""),
    "balanced_rows": (balanced_rows, """
      WITH d AS (
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_tax AS tax,
               CAST(l_returnflag = 'R' AS INT) AS label,
               md5(concat_ws('|', 3, l_orderkey, l_partkey, l_suppkey, l_linenumber)) AS h
        FROM lineitem WHERE l_linenumber % 3 <> 0),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY h) AS i FROM d),
      want AS (SELECT floor(count(*) * 0.25) AS w FROM d WHERE label = 1)
      SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, tax, label
      FROM ranked, want WHERE label = 1 OR i <= w"""),
    "period_sample_rows": (period_sample_rows, DRAWN.format(
        seed=7, period="CASE WHEN l_shipdate >= TIMESTAMP '2000-01-01' THEN 'recent' ELSE 'older' END"
    ) + """,
      want AS (SELECT count(*) AS w FROM d WHERE label = 1)
      SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, label
      FROM ranked, want
      WHERE label = 1 OR i <= floor(w * CASE period WHEN 'recent' THEN 0.2 ELSE 0.5 END)"""),
    "period_sample": (period_sample, """
      WITH d AS (SELECT *, CASE WHEN l_shipdate >= TIMESTAMP '2000-01-01' THEN 'recent'
                                ELSE 'older' END AS period
                 FROM lineitem),
      p AS (SELECT count(*) AS p FROM d WHERE l_returnflag = 'R')
      SELECT period, least(count(*), CAST(floor(max(p) *
             CASE period WHEN 'recent' THEN 0.2 ELSE 0.5 END) AS BIGINT)) AS n
      FROM d, p WHERE l_returnflag <> 'R' GROUP BY period"""),
    "time_split": (time_split, """
      WITH d AS (SELECT *, CAST(o_orderpriority = '1-URGENT' AS INT) AS label FROM orders)
      SELECT o_orderkey, label,
             CASE WHEN o_orderdate < TIMESTAMP '2000-01-01' THEN 'train' ELSE 'test' END AS split
      FROM d
      WHERE o_orderdate < TIMESTAMP '2001-01-01'
        AND (label = 1 OR (o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderstatus = 'F'))"""),
}
