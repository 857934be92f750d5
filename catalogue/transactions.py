"""Transaction history queries on ``orders``: entity = customer, success = status F."""

from pyspark.sql import functions as F

from catalogue.tables import lineitem, orders, rounded, table, us
from pitfeat.operators import history as h
from pitfeat.operators.joins import join_dealt
from pitfeat.operators.reduce import distinct_counts, leads_per_entity, leads_through, time_bounds
from pitfeat.operators.sessions import number_rows
from pitfeat.operators.slices import run_placed
from pitfeat.plans import transactions as plan

BY, T, ID = ["o_custkey"], "o_orderdate", "o_orderkey"


def success():
    return F.col("o_orderstatus") == "F"


def failure():
    return F.col("o_orderstatus") == "O"


def line_facts(spark, sf):
    """Account and city of each line, with the entity and time of its order."""
    o = orders(spark, sf).select(ID, *BY, T)
    n = lineitem(spark, sf).select("l_orderkey", "l_suppkey")
    return join_dealt(n, o, "l_orderkey", ID)


def order_places(spark, sf):
    """Account and city of each order: the smallest of its lines."""
    n = lineitem(spark, sf).select("l_orderkey", "l_suppkey")
    s = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    d = n.join(s, F.col("l_suppkey") == F.col("s_suppkey"))
    return d.groupBy(F.col("l_orderkey").alias(ID)).agg(
        F.min("s_nationkey").alias("city"), F.min("l_suppkey").alias("account")
    )


def txn_prior_counts(spark, sf):
    d = h.prior_agg(
        orders(spark, sf).select(ID, *BY, T, "o_orderstatus"), BY, T,
        {"total_number_of_transactions": h.count(), "number_of_failed_transactions": h.count(failure())},
    )
    return d.select(ID, "total_number_of_transactions", "number_of_failed_transactions")


def txn_prior_mean_median(spark, sf):
    d = h.prior_agg(
        orders(spark, sf), BY, T,
        {
            "total_amount": h.total("o_totalprice"), "mean_amount": h.mean("o_totalprice"),
            "median_amount": h.median("o_totalprice"), "lowest": h.lowest("o_totalprice"),
            "highest": h.highest("o_totalprice"), "kinds": h.distinct("o_orderstatus"),
        },
    )
    return d.select(ID, *rounded(2, "total_amount"), *rounded(6, "mean_amount", "median_amount"),
                    "lowest", "highest", "kinds")


def txn_prior_median_long(spark, sf):
    """Median of all earlier orders of a priority: histories too long for a frame."""
    d = h.prior_agg(
        orders(spark, sf).select(ID, "o_orderpriority", T, "o_totalprice"),
        ["o_orderpriority"], T,
        {"n": h.count(), "median_amount": h.median("o_totalprice")}, frame_rows=1_000,
    )
    return d.select(ID, "n", *rounded(6, "median_amount"))


def txn_prior_means_of_counts(spark, sf):
    means = {"average_number_of_transactions": h.mean("n"), "average_gap": h.mean("gap")}

    def chain(d):
        d = h.prior_agg(d, BY, T, {"n": h.count()})
        d = h.gap_seconds(d, BY, T, [ID], "gap")
        return h.prior_agg(d, BY, T, means)

    d = run_placed(orders(spark, sf), BY, T, chain)
    return d.select(ID, "n", "gap", *rounded(6, "average_number_of_transactions", "average_gap"))


def txn_gap_seconds(spark, sf):
    return h.gap_seconds(orders(spark, sf), BY, T, [ID], "gap").select(ID, "gap")


def txn_last3(spark, sf):
    d = h.last_n(orders(spark, sf), BY, T, [ID], 3, ["o_totalprice"])
    d = h.recent_stats(d, "o_totalprice", "last_3")
    return d.select(ID, *rounded(2, "last_3_total"), *rounded(6, "last_3_mean", "last_3_median"))


#: slices far below the table's size, so that one time stamp fills many of them
ONE_TIME_ROWS = 500


def one_time(spark, sf):
    """Orders of which nine in ten have the same time."""
    same = F.when(F.col("o_orderkey") % 10 != 0, F.lit("1998-01-01").cast("timestamp"))
    return orders(spark, sf).withColumn(T, F.coalesce(same, F.col(T)))


def txn_last3_one_time(spark, sf):
    d = h.last_n(one_time(spark, sf), ["o_orderstatus"], T, [ID], 3, ["o_totalprice"], slice_rows=ONE_TIME_ROWS)
    d = h.recent_stats(d, "o_totalprice", "last_3")
    return d.select(ID, *rounded(2, "last_3_total"), *rounded(6, "last_3_mean", "last_3_median"))


def hit_number_one_time(spark, sf):
    d = number_rows(one_time(spark, sf), ["o_orderstatus"], T, [ID], "hit_number", ONE_TIME_ROWS)
    d = h.gap_seconds(d, ["o_orderstatus"], T, [ID], "gap", ONE_TIME_ROWS)
    return d.select(ID, "hit_number", "gap")


ONE_TIME_SQL = """
      WITH d AS (SELECT * REPLACE (CASE WHEN o_orderkey % 10 <> 0 THEN TIMESTAMP '1998-01-01' ELSE o_orderdate END
                   AS o_orderdate) FROM orders),
      n AS (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey) AS r FROM d)"""


def txn_until_first_success(spark, sf):
    d = h.until_first(orders(spark, sf), BY, T, success())
    return d.select(ID, *us("cutoff_time"))


def txn_until_first_success_strict(spark, sf):
    return h.until_first(orders(spark, sf), BY, T, success(), keep_without=False).select(ID)


def new_repeat_flag(spark, sf):
    return h.user_flag(orders(spark, sf), BY, T, success()).select(ID, "user_flag")


def prior_distinct_accounts(spark, sf):
    d = h.prior_agg_other(
        orders(spark, sf).select(ID, *BY, T), line_facts(spark, sf), BY, T, T,
        {"number_of_banks": h.distinct("l_suppkey")},
    )
    return d.select(ID, "number_of_banks")


def prior_distinct_locations(spark, sf):
    o = orders(spark, sf).select(ID, *BY, T).join(order_places(spark, sf), ID)
    d = h.prior_agg(o, BY, T, {"number_of_different_locations": h.distinct("city")})
    return d.select(ID, "city", "number_of_different_locations")


def pre_event_leads(spark, sf):
    o = orders(spark, sf).select(ID, *BY, T)
    n = lineitem(spark, sf).select("l_orderkey", "l_partkey", "l_shipdate")
    leads = join_dealt(n, o, "l_orderkey", ID).select(*BY, "l_partkey", "l_shipdate")
    d = h.prior_agg_other(
        o, leads, BY, T, "l_shipdate", {"number_of_leads": h.distinct("l_partkey")}
    )
    return d.select(ID, "number_of_leads")


def leads_by_chain(spark, sf):
    """Leads over four tables: parts of lines, by order, customer (every third is unknown) and nation."""
    known = table(spark, sf, "customer").where("c_custkey % 3 <> 0")
    return leads_through(
        lineitem(spark, sf),
        [(orders(spark, sf), "l_orderkey", ID, "inner"), (known, "o_custkey", "c_custkey", "left"),
         (table(spark, sf, "nation"), "c_nationkey", "n_nationkey", "left")],
        "n_name", "l_partkey")


def leads_per_customer(spark, sf):
    n = lineitem(spark, sf).select("l_orderkey", "l_partkey")
    o = orders(spark, sf).select(ID, *BY)
    wanted = orders(spark, sf).where(failure())
    return leads_per_entity(n, o, "l_orderkey", ID, "o_custkey", "l_partkey", wanted)


def customer_bounds(spark, sf):
    d = time_bounds(orders(spark, sf), BY, T, "o_totalprice")
    return d.select(*BY, *us("first_time", "last_time"), "n_rows", *rounded(2, "total_amount"))


def distinct_by_customer(spark, sf):
    return distinct_counts(
        orders(spark, sf), BY,
        {"dates": T, "failed_dates": F.when(failure(), F.col(T)), "priorities": "o_orderpriority"},
    )


FEATURES = ["user_flag", "number_of_failed_transactions", "total_number_of_transactions",
            "seconds_since_last_transaction", "number_of_banks", "number_of_different_locations",
            "time_hour_utc", "time_hour_local", "city", "referral_code"]
FEATURES_ROUNDED = ["average_number_of_transactions", "average_seconds_between_two_transactions",
                    "mean_amount", "median_amount", "last_3_mean", "last_3_median"]


def feature_store(spark, sf):
    """History of every order of a customer up to the first success.

    History counts all orders; orders without a city drop out only at the end.
    """
    o = orders(spark, sf).join(order_places(spark, sf), ID, "left")
    roles = plan.Transactions(
        entity="o_custkey", time=T, id=ID, amount="o_totalprice", success=success(),
        failure=failure(), account="account", location="city",
    )
    d = plan.transaction_features(o, roles).where(F.col("city").isNotNull())
    d = d.withColumn(
        "referral_code", F.when(F.col("o_orderpriority") == "1-URGENT", "yes").otherwise("no")
    )
    return d.select(
        ID, *FEATURES, *us("cutoff_time"), *rounded(2, "total_transaction_amount", "last_3_total"),
        *rounded(6, *FEATURES_ROUNDED),
    )


PLACES_SQL = """
      places AS (
        SELECT l_orderkey AS o_orderkey, min(s_nationkey) AS city, min(l_suppkey) AS account
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_orderkey)"""

GAP_SQL = """
      gaps AS (
        SELECT *, (epoch_us(o_orderdate) - epoch_us(lag(o_orderdate) OVER (
               PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))) // 1000000 AS gap
        FROM orders),
      counted AS (
        SELECT a.o_orderkey, a.o_custkey, a.o_orderdate, a.gap, count(b.o_orderkey) AS n
        FROM gaps a LEFT JOIN orders b
          ON b.o_custkey = a.o_custkey AND b.o_orderdate < a.o_orderdate
        GROUP BY ALL)"""

CUTOFF_SQL = """
      cutoffs AS (
        SELECT o_custkey, coalesce(min(o_orderdate) FILTER (o_orderstatus = 'F'),
                                   max(o_orderdate)) AS cutoff_time
        FROM orders GROUP BY o_custkey)"""

LAST3_SQL = """
      numbered AS (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
        FROM orders),
      last3 AS (
        SELECT a.o_orderkey, round(sum(b.o_totalprice), 2) AS last_3_total,
               round(avg(b.o_totalprice), 6) AS last_3_mean,
               round(median(b.o_totalprice), 6) AS last_3_median
        FROM numbered a LEFT JOIN numbered b ON b.o_custkey = a.o_custkey
          AND b.o_orderdate < a.o_orderdate AND b.rn >= a.rn - 3
        GROUP BY a.o_orderkey)"""

QUERIES = {
    "txn_prior_counts": (txn_prior_counts, """
      SELECT a.o_orderkey, count(b.o_orderkey) AS total_number_of_transactions,
             count(b.o_orderkey) FILTER (b.o_orderstatus = 'O') AS number_of_failed_transactions
      FROM orders a LEFT JOIN orders b
        ON b.o_custkey = a.o_custkey AND b.o_orderdate < a.o_orderdate
      GROUP BY a.o_orderkey"""),
    "txn_prior_mean_median": (txn_prior_mean_median, """
      SELECT a.o_orderkey, round(sum(b.o_totalprice), 2) AS total_amount,
             round(avg(b.o_totalprice), 6) AS mean_amount,
             round(median(b.o_totalprice), 6) AS median_amount,
             min(b.o_totalprice) AS lowest, max(b.o_totalprice) AS highest,
             count(DISTINCT b.o_orderstatus) AS kinds
      FROM orders a LEFT JOIN orders b
        ON b.o_custkey = a.o_custkey AND b.o_orderdate < a.o_orderdate
      GROUP BY a.o_orderkey"""),
    "txn_prior_median_long": (txn_prior_median_long, """
      SELECT a.o_orderkey, count(b.o_orderkey) AS n,
             round(median(b.o_totalprice), 6) AS median_amount
      FROM orders a LEFT JOIN orders b
        ON b.o_orderpriority = a.o_orderpriority AND b.o_orderdate < a.o_orderdate
      GROUP BY a.o_orderkey"""),
    "txn_prior_means_of_counts": (txn_prior_means_of_counts, f"""
      WITH {GAP_SQL}
      SELECT a.o_orderkey, a.n, a.gap, round(avg(b.n), 6) AS average_number_of_transactions,
             round(avg(b.gap), 6) AS average_gap
      FROM counted a LEFT JOIN counted b
        ON b.o_custkey = a.o_custkey AND b.o_orderdate < a.o_orderdate
      GROUP BY a.o_orderkey, a.n, a.gap"""),
    "txn_gap_seconds": (txn_gap_seconds, f"WITH {GAP_SQL} SELECT o_orderkey, gap FROM gaps"),
    "txn_last3": (txn_last3, f"WITH {LAST3_SQL} SELECT * FROM last3"),
    "txn_last3_one_time": (txn_last3_one_time, ONE_TIME_SQL + """
      SELECT a.o_orderkey, round(sum(b.o_totalprice), 2) AS last_3_total,
             round(avg(b.o_totalprice), 6) AS last_3_mean, round(median(b.o_totalprice), 6) AS last_3_median
      FROM n a CROSS JOIN (SELECT unnest([1, 2, 3]) AS k)
        LEFT JOIN n b ON b.o_orderstatus = a.o_orderstatus AND b.r = a.r - k AND b.o_orderdate < a.o_orderdate
      GROUP BY a.o_orderkey"""),
    "hit_number_one_time": (hit_number_one_time, ONE_TIME_SQL + """
      SELECT a.o_orderkey, CAST(a.r AS INT) AS hit_number,
             epoch_us(a.o_orderdate) // 1000000 - epoch_us(b.o_orderdate) // 1000000 AS gap
      FROM n a LEFT JOIN n b ON b.o_orderstatus = a.o_orderstatus AND b.r = a.r - 1"""),
    "txn_until_first_success": (txn_until_first_success, f"""
      WITH {CUTOFF_SQL}
      SELECT o_orderkey, epoch_us(cutoff_time) AS cutoff_time_us
      FROM orders JOIN cutoffs USING (o_custkey) WHERE o_orderdate <= cutoff_time"""),
    "txn_until_first_success_strict": (txn_until_first_success_strict, """
      SELECT o_orderkey FROM orders a WHERE o_orderdate <= (
        SELECT min(o_orderdate) FROM orders b
        WHERE b.o_custkey = a.o_custkey AND b.o_orderstatus = 'F')"""),
    "new_repeat_flag": (new_repeat_flag, """
      SELECT o_orderkey, CASE WHEN f.o_custkey IS NULL THEN 'NU' ELSE 'RU' END AS user_flag
      FROM orders a LEFT JOIN (
        SELECT o_custkey, min(o_orderdate) AS first FROM orders
        WHERE o_orderstatus = 'F' GROUP BY o_custkey) f
        ON f.o_custkey = a.o_custkey AND a.o_orderdate > f.first"""),
    "prior_distinct_accounts": (prior_distinct_accounts, """
      SELECT a.o_orderkey, count(DISTINCT l_suppkey) AS number_of_banks
      FROM orders a LEFT JOIN (orders b JOIN lineitem ON l_orderkey = b.o_orderkey)
        ON b.o_custkey = a.o_custkey AND b.o_orderdate < a.o_orderdate
      GROUP BY a.o_orderkey"""),
    "prior_distinct_locations": (prior_distinct_locations, f"""
      WITH {PLACES_SQL},
      located AS (SELECT * FROM orders JOIN places USING (o_orderkey))
      SELECT a.o_orderkey, a.city, count(DISTINCT b.city) AS number_of_different_locations
      FROM located a LEFT JOIN located b
        ON b.o_custkey = a.o_custkey AND b.o_orderdate < a.o_orderdate
      GROUP BY a.o_orderkey, a.city"""),
    "pre_event_leads": (pre_event_leads, """
      SELECT a.o_orderkey, count(DISTINCT l_partkey) AS number_of_leads
      FROM orders a LEFT JOIN (orders b JOIN lineitem ON l_orderkey = b.o_orderkey)
        ON b.o_custkey = a.o_custkey AND l_shipdate < a.o_orderdate
      GROUP BY a.o_orderkey"""),
    "leads_by_chain": (leads_by_chain, """
      SELECT n_name, count(DISTINCT l_partkey) AS number_of_leads
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey
        LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 3 <> 0) ON c_custkey = o_custkey
        LEFT JOIN nation ON n_nationkey = c_nationkey
      GROUP BY n_name"""),
    "leads_per_customer": (leads_per_customer, """
      SELECT o_custkey, count(DISTINCT l_partkey) AS number_of_leads
      FROM orders JOIN lineitem ON l_orderkey = o_orderkey
      WHERE o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')
      GROUP BY o_custkey"""),
    "customer_bounds": (customer_bounds, """
      SELECT o_custkey, epoch_us(min(o_orderdate)) AS first_time_us,
             epoch_us(max(o_orderdate)) AS last_time_us, count(*) AS n_rows,
             round(sum(o_totalprice), 2) AS total_amount
      FROM orders GROUP BY o_custkey"""),
    "distinct_by_customer": (distinct_by_customer, """
      SELECT o_custkey, count(DISTINCT o_orderdate) AS dates,
             count(DISTINCT CASE WHEN o_orderstatus = 'O' THEN o_orderdate END) AS failed_dates,
             count(DISTINCT o_orderpriority) AS priorities
      FROM orders GROUP BY o_custkey"""),
    "feature_store": (feature_store, f"""
      WITH {PLACES_SQL}, {GAP_SQL}, {CUTOFF_SQL}, {LAST3_SQL},
      located AS (SELECT * FROM orders LEFT JOIN places USING (o_orderkey)),
      past AS (
        SELECT a.o_orderkey,
               count(b.o_orderkey) FILTER (b.o_orderstatus = 'O') AS number_of_failed_transactions,
               count(DISTINCT b.account) AS number_of_banks,
               count(DISTINCT b.city) AS number_of_different_locations,
               round(sum(b.o_totalprice), 2) AS total_transaction_amount,
               round(avg(b.o_totalprice), 6) AS mean_amount,
               round(median(b.o_totalprice), 6) AS median_amount
        FROM located a LEFT JOIN located b
          ON b.o_custkey = a.o_custkey AND b.o_orderdate < a.o_orderdate
        GROUP BY a.o_orderkey),
      means AS (
        SELECT a.o_orderkey, a.n AS total_number_of_transactions,
               a.gap AS seconds_since_last_transaction,
               round(avg(b.n), 6) AS average_number_of_transactions,
               round(avg(b.gap), 6) AS average_seconds_between_two_transactions
        FROM counted a LEFT JOIN counted b
          ON b.o_custkey = a.o_custkey AND b.o_orderdate < a.o_orderdate
        GROUP BY a.o_orderkey, a.n, a.gap),
      firsts AS (
        SELECT o_custkey, min(o_orderdate) AS first FROM orders
        WHERE o_orderstatus = 'F' GROUP BY o_custkey)
      SELECT o_orderkey, city,
             CASE WHEN o_orderdate > first THEN 'RU' ELSE 'NU' END AS user_flag,
             CASE WHEN o_orderpriority = '1-URGENT' THEN 'yes' ELSE 'no' END AS referral_code,
             CAST(hour(o_orderdate) AS INT) AS time_hour_utc,
             CAST(hour(o_orderdate + INTERVAL 330 MINUTE) AS INT) AS time_hour_local,
             epoch_us(cutoff_time) AS cutoff_time_us,
             number_of_failed_transactions, total_number_of_transactions,
             seconds_since_last_transaction, number_of_banks, number_of_different_locations,
             total_transaction_amount, last_3_total, average_number_of_transactions,
             average_seconds_between_two_transactions, mean_amount, median_amount,
             last_3_mean, last_3_median
      FROM orders JOIN places USING (o_orderkey) JOIN past USING (o_orderkey)
        JOIN means USING (o_orderkey) JOIN last3 USING (o_orderkey)
        JOIN cutoffs USING (o_custkey) LEFT JOIN firsts USING (o_custkey)
      WHERE o_orderdate <= cutoff_time"""),
}
