"""Preparation, name matching and model queries."""

from pyspark.sql import functions as F

from catalogue.profiles import lines
from catalogue.tables import lineitem, orders, rounded, table
from pitfeat.checkpoints import cut_lineage
from pitfeat.functions import columns as c
from pitfeat.operators import model, prep
from pitfeat.operators.neighbours import impute_neighbours
from pitfeat.operators.sampling import undersample

NUMERIC = ["l_quantity", "l_extendedprice", "l_tax"]
CATEGORICAL = ["l_linestatus", "o_orderpriority"]


def power_transform(spark, sf):
    """Fixed lambdas on both sides of 1 and 2, and on negative values."""
    price = F.col("o_totalprice") / 1000
    return orders(spark, sf).select(
        "o_orderkey",
        F.round(c.yeo_johnson(price, 0.25), 6).alias("quarter"),
        F.round(c.yeo_johnson(price, 0.0), 6).alias("log"),
        F.round(c.yeo_johnson(price - 150, 0.5), 6).alias("mixed"),
        F.round(c.yeo_johnson(-price, 2.0), 6).alias("negative"),
    )


def fitted_power(spark, sf):
    """Fitted on the table itself, then centred and scaled."""
    d = orders(spark, sf).select("o_orderkey", "o_totalprice")
    lambdas = prep.fit_power(d, ["o_totalprice"])
    return prep.power_transform(d, lambdas).select("o_orderkey", *rounded(6, "o_totalprice"))


def _likelihood(name, grid):
    """The grid's point of largest likelihood; all amounts are positive."""
    return f"""{name} AS (
        SELECT arg_max(g, -n / 2 * ln(v) + (g - 1) * s) AS g FROM (
          SELECT g, any_value(n) AS n, any_value(s) AS s,
                 var_pop(CASE WHEN abs(g) < 1e-9 THEN ln(1 + x) ELSE (pow(1 + x, g) - 1) / g END) AS v
          FROM d, j, ({grid}) GROUP BY g))"""


def _around(name, step):
    return f"SELECT round(g + i * {step}, 6) AS g FROM {name}, (SELECT unnest(generate_series(-10, 10)) AS i)"


FITTED_SQL = f"""
      WITH d AS (SELECT o_orderkey, o_totalprice AS x FROM orders),
      j AS (SELECT count(*) AS n, sum(ln(1 + x)) AS s FROM d),
      {_likelihood("a", "SELECT round(i * 0.2, 6) AS g FROM (SELECT unnest(generate_series(-15, 15)) AS i)")},
      {_likelihood("b", _around("a", 0.02))},
      {_likelihood("c", "SELECT round(g + i * 0.001, 6) AS g FROM b, (SELECT unnest(generate_series(-20, 20)) AS i)")},
      y AS (SELECT o_orderkey, CASE WHEN abs(g) < 1e-9 THEN ln(1 + x) ELSE (pow(1 + x, g) - 1) / g END AS v FROM d, c)
      SELECT o_orderkey, round((v - (SELECT avg(v) FROM y)) / (SELECT stddev_pop(v) FROM y), 6) AS o_totalprice FROM y"""


def imputed_neighbours(spark, sf):
    """Missing prices from the two nearest orders by number of lines, pieces and discount."""
    n = lineitem(spark, sf).groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count("*").alias("n"), F.sum("l_quantity").alias("pieces"), F.avg("l_discount").alias("discount"))
    o = orders(spark, sf).select("o_orderkey", F.when(
        F.col("o_orderkey") % 7 != 0, F.col("o_totalprice")).alias("price"))
    d = impute_neighbours(o.join(n, "o_orderkey", "left"), "o_orderkey", ["price"], ["n", "pieces", "discount"])
    return d.select("o_orderkey", *rounded(2, "price"))


def one_hot(spark, sf):
    """Places by frequency among settled orders; a status that none of them has is unknown."""
    o = orders(spark, sf).select("o_orderkey", "o_orderstatus", "o_orderpriority")
    d = model.one_hot(o, ["o_orderstatus", "o_orderpriority"], o.where("o_orderstatus <> 'P'"))
    text = lambda c: F.concat_ws("", F.transform(c, lambda x: x.cast("int").cast("string"))).alias(c)
    return d.select("o_orderkey", text("o_orderstatus"), text("o_orderpriority"))


def _hot_sql(column):
    return f"""(
        SELECT value, string_agg(CASE WHEN i = place THEN '1' ELSE '0' END, '' ORDER BY i) AS bits
        FROM (SELECT {column} AS value, row_number() OVER (ORDER BY count(*) DESC, {column}) AS place
              FROM orders WHERE o_orderstatus <> 'P' GROUP BY {column}),
             (SELECT unnest(range(1, 1 + (SELECT count(DISTINCT {column}) FROM orders WHERE o_orderstatus <> 'P'))) AS i)
        GROUP BY value)"""


ONE_HOT_SQL = f"""
      SELECT o_orderkey, coalesce(s.bits, '00') AS o_orderstatus, p.bits AS o_orderpriority
      FROM orders LEFT JOIN {_hot_sql("o_orderstatus")} s ON s.value = o_orderstatus
        LEFT JOIN {_hot_sql("o_orderpriority")} p ON p.value = o_orderpriority"""


def standardised(spark, sf):
    d = prep.standardise(lineitem(spark, sf).select("l_orderkey", "l_quantity", "l_tax"),
                         ["l_quantity", "l_tax"])
    return d.select("l_orderkey", *rounded(6, "l_quantity", "l_tax"))


def with_gaps(spark, sf):
    gap = F.col("l_linenumber") % 3 == 0
    return lineitem(spark, sf).select(
        "l_orderkey", "l_linenumber", "l_returnflag",
        F.when(~gap, F.col("l_quantity")).alias("quantity"),
        F.when(~gap, F.col("l_tax")).alias("tax"),
    )


def imputed(spark, sf):
    d = prep.impute_group_median(with_gaps(spark, sf), ["quantity"], ["l_returnflag"])
    d = prep.impute_mean(d, ["tax"])
    return d.select("l_orderkey", "l_linenumber", *rounded(6, "quantity", "tax"))


def filled(spark, sf):
    d = c.fill(with_gaps(spark, sf), {"quantity": 0.0, "tax": -1.0})
    return d.groupBy("l_returnflag").agg(
        F.round(F.sum("quantity"), 2).alias("quantity"), F.round(F.sum("tax"), 2).alias("tax")
    )


def cast_to_numbers(spark, sf):
    """Text that is no number becomes null; columns take a prefix and lose it again."""
    d = orders(spark, sf).select(
        "o_orderkey", F.col("o_orderpriority").alias("whole"),
        F.substring("o_orderpriority", 1, 1).alias("first"),
    )
    d = c.strip_prefix(c.prefix_columns(d, "x_"), "x_")
    return c.cast_all(d, {"whole": "int", "first": "int"})


def names(spark, sf):
    """Payer and payee of each line, as words with the serial number last."""
    o = orders(spark, sf).select("o_orderkey", "o_custkey")
    n = lineitem(spark, sf).select("l_orderkey", "l_suppkey")
    cu = table(spark, sf, "customer").select("c_custkey", "c_name")
    su = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    d = n.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    d = d.join(cu, F.col("o_custkey") == F.col("c_custkey"))
    d = d.join(su, F.col("l_suppkey") == F.col("s_suppkey"))
    return d.select("l_orderkey", F.regexp_replace("c_name", "#0*", " ").alias("payer"),
                    F.regexp_replace("s_name", "#0*", " ").alias("payee"))


def fuzzy_name_match(spark, sf):
    return c.name_match(names(spark, sf), "payer", "payee", "is_self")


def name_match_levenshtein(spark, sf):
    """The same by edit distance, which SQL has too."""
    return c.name_match(names(spark, sf), "payer", "payee", "is_self", 0.3, measure="levenshtein")


def training_set(spark, sf):
    o = orders(spark, sf).select("o_orderkey", "o_orderpriority")
    d = lines(spark, sf).join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    return d.select("l_orderkey", "l_linenumber", "l_partkey", *NUMERIC, *CATEGORICAL, "label")


TRAINED_ON = [*NUMERIC, *CATEGORICAL]


def fitted_model(d):
    """Trees fit on a balanced sample of the lines."""
    return model.fit(undersample(d, "label", 1.0, 42), NUMERIC, CATEGORICAL, "label", maxIter=3, maxDepth=3)


def gbt_scores(spark, sf):
    """Fit on a balanced sample, score every line, decide at the base rate."""
    d = cut_lineage(training_set(spark, sf))
    out = model.score(d, fitted_model(d), [0.5])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "ml_probability", "payout_decision")


QUERIES = {
    "power_transform": (power_transform, """
      WITH d AS (SELECT o_orderkey, o_totalprice / 1000 AS p FROM orders),
      m AS (SELECT *, p - 150 AS q FROM d)
      SELECT o_orderkey, round((pow(p + 1, 0.25) - 1) / 0.25, 6) AS quarter,
             round(ln(1 + p), 6) AS log,
             round(CASE WHEN q >= 0 THEN (pow(q + 1, 0.5) - 1) / 0.5
                        ELSE -(pow(1 - q, 1.5) - 1) / 1.5 END, 6) AS mixed,
             round(-ln(1 + p), 6) AS negative
      FROM m"""),
    "fitted_power": (fitted_power, FITTED_SQL),
    "imputed_neighbours": (imputed_neighbours, None),
    "one_hot": (one_hot, ONE_HOT_SQL),
    "standardised": (standardised, """
      WITH m AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq,
                        avg(l_tax) AS mt, stddev_pop(l_tax) AS st FROM lineitem)
      SELECT l_orderkey, round((l_quantity - mq) / sq, 6) AS l_quantity,
             round((l_tax - mt) / st, 6) AS l_tax
      FROM lineitem, m"""),
    "imputed": (imputed, """
      WITH g AS (SELECT l_returnflag, median(l_quantity) AS half FROM lineitem
                 WHERE l_linenumber % 3 <> 0 GROUP BY l_returnflag),
      m AS (SELECT avg(l_tax) AS mean FROM lineitem WHERE l_linenumber % 3 <> 0)
      SELECT l_orderkey, l_linenumber,
             round(CASE WHEN l_linenumber % 3 = 0 THEN half ELSE l_quantity END, 6) AS quantity,
             round(CASE WHEN l_linenumber % 3 = 0 THEN mean ELSE l_tax END, 6) AS tax
      FROM lineitem JOIN g USING (l_returnflag), m"""),
    "filled": (filled, """
      SELECT l_returnflag,
             round(sum(CASE WHEN l_linenumber % 3 = 0 THEN 0 ELSE l_quantity END), 2) AS quantity,
             round(sum(CASE WHEN l_linenumber % 3 = 0 THEN -1 ELSE l_tax END), 2) AS tax
      FROM lineitem GROUP BY l_returnflag"""),
    "cast_to_numbers": (cast_to_numbers, """
      SELECT o_orderkey, TRY_CAST(o_orderpriority AS INT) AS whole,
             TRY_CAST(substr(o_orderpriority, 1, 1) AS INT) AS first FROM orders"""),
    "fuzzy_name_match": (fuzzy_name_match, None),
    "name_match_levenshtein": (name_match_levenshtein, r"""
      WITH n AS (
        SELECT l_orderkey, regexp_replace(c_name, '#0*', ' ', 'g') AS payer,
               regexp_replace(s_name, '#0*', ' ', 'g') AS payee
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
          JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey),
      x AS (
        SELECT payer, payee, unnest(string_split_regex(lower(trim(payer)), '\s+')) AS x
        FROM (SELECT DISTINCT payer, payee FROM n)),
      y AS (SELECT *, unnest(string_split_regex(lower(trim(payee)), '\s+')) AS y FROM x),
      v AS (
        SELECT payer, payee,
               bool_or(contains(x, y) OR contains(y, x)
                       OR 1 - levenshtein(x, y) / greatest(length(x), length(y)) >= 0.3) AS is_self
        FROM y GROUP BY payer, payee)
      SELECT l_orderkey, payer, payee, is_self FROM n JOIN v USING (payer, payee)"""),
    "gbt_scores": (gbt_scores, None),
}
