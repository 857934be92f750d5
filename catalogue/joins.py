"""Equi, as-of and banded joins, deduplication, folding counters, parsing."""

from pyspark.sql import functions as F

from catalogue.clicks import MARK, is_type
from catalogue.tables import events, lineitem, orders, rounded, table, us
from pitfeat.functions import columns as c
from pitfeat.operators import joins as j
from pitfeat.operators.asof import asof_join, banded_nearest
from pitfeat.operators.counters import fold_latest, merge_counters
from pitfeat.operators.history import age_tag
from pitfeat.operators.reduce import dedup_last, top_k
from pitfeat.sources.tables import explode_payload, payload_rejects


def star_enrich(spark, sf):
    dims = [
        j.Dim(table(spark, sf, "customer"), ["c_custkey"], ["o_custkey"],
              ["c_mktsegment", "c_nationkey"], "inner"),
        j.Dim(table(spark, sf, "nation"), ["n_nationkey"], ["c_nationkey"],
              ["n_name", "n_regionkey"]),
        j.Dim(table(spark, sf, "region"), ["r_regionkey"], ["n_regionkey"], ["r_name"]),
    ]
    d = j.enrich(orders(spark, sf), dims)
    return d.select("o_orderkey", "c_mktsegment", "n_name", "r_name")


def assembled_features(spark, sf):
    """Row-id chain: a left part and an inner part that drops orders without lines."""
    lines = lineitem(spark, sf).groupBy(F.col("l_orderkey").alias("o_orderkey"))
    late = lineitem(spark, sf).where("l_returnflag = 'R'")
    returned = late.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count("*").alias("n_returned")
    )
    counts = lines.agg(F.count("*").alias("n_lines"))
    base = orders(spark, sf).select("o_orderkey", "o_custkey")
    return j.assemble(base, ["o_orderkey"], [(counts, "inner"), (returned, "left")])


def lookup_names(spark, sf):
    """Two lookups on one table: supplier and part names of each line."""
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"),
                                            F.col("s_name").alias("value"))
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("key"),
                                        F.col("p_name").alias("value"))
    d = lineitem(spark, sf).select("l_orderkey", "l_suppkey", "l_partkey")
    d = j.apply_lookup(d, s, "l_suppkey", "supplier_name")
    return j.apply_lookup(d, p, "l_partkey", "part_name")


def outer_users(spark, sf):
    """Clickers and buyers, full outer."""
    e = events(spark, sf)
    clicks = e.where(is_type("click")).groupBy("user_id").agg(F.count("*").alias("n_clicks"))
    errors = e.where(is_type("error")).groupBy("user_id").agg(
        F.count("*").alias("n_errors")
    )
    return j.full_outer(clicks, errors, ["user_id"])


def customers_without_success(spark, sf):
    good = orders(spark, sf).where("o_orderstatus = 'F'")
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"))
    return j.anti_join(customers, good, ["o_custkey"])


def concat_frames(spark, sf):
    o = orders(spark, sf)
    d = j.concat_frames(
        o.where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice"),
        o.where("o_orderstatus <> 'F'").select("o_orderkey", "o_orderpriority"),
    )
    return d.select("o_orderkey", "o_totalprice", "o_orderpriority")


def purchases(spark, sf):
    return events(spark, sf).where(is_type("purchase")).select("event_id", "user_id", "ts")


def right_side(spark, sf, kind, prefix):
    e = events(spark, sf).where(is_type(kind))
    return e.select("user_id", *[F.col(x).alias(f"{prefix}{x}") for x in ("ts", "event_id", "value")])


def asof_click_before_purchase(spark, sf):
    d = asof_join(purchases(spark, sf), right_side(spark, sf, "click", "click_"), ["user_id"],
                  "ts", "click_ts", 6 * 3600, ["click_event_id"])
    return d.select("event_id", "click_event_id", *us("click_ts"), "click_value")


def asof_any_age(spark, sf):
    d = asof_join(purchases(spark, sf), right_side(spark, sf, "click", "click_"), ["user_id"],
                  "ts", "click_ts", None, ["click_event_id"])
    return d.select("event_id", "click_event_id")


def banded_nearest_event(spark, sf):
    d = banded_nearest(purchases(spark, sf), right_side(spark, sf, "view", "view_"), ["user_id"],
                       "ts", "view_ts", 48, 2160, ["view_event_id"], keep_ties=True)
    return d.select("event_id", "view_event_id", *rounded(6, "duration_hours"), "lag_band",
                    age_tag("duration_hours").alias("user_type"))


def dedup_last_line(spark, sf):
    d = lineitem(spark, sf)
    rest = [x for x in d.columns if x not in ("l_orderkey", "l_linenumber")]
    d = dedup_last(d, ["l_orderkey", "l_linenumber"], rest)
    return d.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                    *us("l_shipdate"))


def counters(e):
    """Newest row of each user with event and click counters."""
    best = e.groupBy("user_id").agg(
        F.max(F.struct("ts", "event_id", "event_type")).alias("_last"),
        F.count("*").alias("n_events"),
        F.count_if(is_type("click")).alias("n_clicks"),
    )
    return best.select("user_id", "_last.ts", "_last.event_type", "n_events", "n_clicks")


def two_slices(spark, sf):
    e = events(spark, sf)
    return counters(e.where(F.col("ts") < MARK)), counters(e.where(F.col("ts") >= MARK))


def merge_counters_query(spark, sf):
    main, delta = two_slices(spark, sf)
    d = merge_counters(main, delta, ["user_id"], ["n_events", "n_clicks"])
    return d.select("user_id", *us("ts"), "event_type", "n_events", "n_clicks")


def fold_main_table(spark, sf):
    """Main table after one increment."""
    e = events(spark, sf)
    main = counters(e.where(F.col("ts") < MARK))
    delta = counters(e.where(F.col("ts") >= MARK))
    d = fold_latest(main, delta, ["user_id"], "ts", [], ["n_events", "n_clicks"])
    return d.select("user_id", *us("ts"), "event_type", "n_events", "n_clicks")


def json_props(spark, sf):
    parsed = F.from_json("props", "struct<k:int>")
    return events(spark, sf).select(
        "event_id", c.json_value("props", "$.k").cast("int").alias("k_text"),
        parsed["k"].alias("k_struct"),
        F.from_json(c.strip_escapes("props"), "struct<k:int>")["k"].alias("k_clean"),
    )


def json_lists(spark, sf):
    """Summed length of JSON lists, one of which an order may lack."""
    n = lineitem(spark, sf).select("l_orderkey", "l_returnflag", "l_linenumber").distinct()
    lists = n.groupBy("l_orderkey").agg(
        F.to_json(F.struct(
            F.collect_list(F.when(F.col("l_returnflag") == "R", F.col("l_linenumber"))).alias("buy"),
            F.collect_list(F.when(F.col("l_returnflag") == "A", F.col("l_linenumber"))).alias("rent"),
        )).alias("seen")
    )
    return lists.select("l_orderkey",
                        c.json_list_total("seen", ["buy", "rent", "pg"]).alias("n_seen"))


def array_dimension(spark, sf):
    """Entry 3 of an index-value array, null when the order has no line 3."""
    n = lineitem(spark, sf).groupBy("l_orderkey", F.col("l_linenumber").alias("index"))
    one = n.agg(F.min("l_suppkey").alias("value"))
    dims = one.groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(F.struct("index", "value"))).alias("dims")
    )
    return dims.select("l_orderkey", c.dimension_value("dims", 3).alias("value"))


PAYLOAD = ("struct<data:struct<waitingOrders:array<struct<"
           "orderId:bigint,gaId:bigint,transactionTime:bigint>>>>")


def json_payload_inline(spark, sf):
    """Each event as a payload of two orders, parsed back into rows."""
    def item(shift):
        return F.struct(
            (F.col("event_id") * 2 + shift).alias("orderId"), F.col("user_id").alias("gaId"),
            F.unix_millis("ts").alias("transactionTime"),
        )

    params = F.struct(F.array(item(0), item(1)).alias("waitingOrders"))
    landed = events(spark, sf).select(F.to_json(F.struct(params.alias("data"))).alias("body"))
    d = explode_payload(
        landed, "body", PAYLOAD, "data.waitingOrders",
        {"orderId": "order_id", "gaId": "ga_id", "transactionTime": "transaction_time"},
        {"transaction_time": "transaction_timestamp"},
    )
    return d.select("order_id", "ga_id", *us("transaction_timestamp"))


def payload_with_rejects(spark, sf):
    """Payloads of which every fifth is cut short: parsed and rejected rows."""
    e = events(spark, sf).select("event_id", F.when(
        F.col("event_id") % 5 == 0, F.expr("substr(props, 1, length(props) - 1)")).otherwise(F.col("props")).alias("props"))
    packed = e.withColumn("payload", F.concat(F.lit('{"rows": ['), "props", F.lit("]}")))
    schema = "rows array<struct<k:int>>"
    good = explode_payload(packed, "payload", schema, "rows", {"k": "value"}, keep=["event_id"])
    bad = payload_rejects(packed, "payload", schema, keep=["event_id"])
    return good.select("event_id", F.lit(True).alias("parsed")).unionByName(
        bad.select("event_id", F.lit(False).alias("parsed")))


def scalar_functions(spark, sf):
    """Bank from an address or a code, nulls from text, logs, casts, time parts."""
    address = F.when(F.col("o_orderkey") % 3 == 0, F.concat_ws("@", "o_orderstatus", "o_orderpriority")
                     ).when(F.col("o_orderkey") % 3 == 1, F.col("o_orderstatus"))
    d = orders(spark, sf).withColumns(
        {"address": address, "medium": F.when(F.col("o_orderstatus") == "P", "null").otherwise("web")}
    )
    return d.select(
        "o_orderkey",
        c.bank_of_address("address").alias("upi_bank"),
        c.bank_of_address("address", coalesce_other=False).alias("upi_bank_or_null"),
        c.bank_of_account("o_orderpriority").alias("account_bank"),
        c.literal_null("medium").alias("medium"),
        F.round(c.log_floor("o_totalprice"), 6).alias("log_price"),
        F.hour(c.local_time("o_orderdate")).alias("local_hour"),
        F.month("o_orderdate").alias("month"),
        F.col("o_orderpriority").try_cast("int").alias("as_number"),
        c.flag(F.col("o_totalprice") > 100_000, "yes", "no").alias("large"),
    )


def top_parts(spark, sf):
    d = lineitem(spark, sf).groupBy("l_partkey").agg(F.count("*").alias("n"))
    return top_k(d, 20, [F.desc("n"), F.col("l_partkey")])


SLICES_SQL = """
      WITH a AS (
        SELECT user_id, max(ts) AS ts, arg_max(event_type, ts) AS event_type, count(*) AS n_events,
               count(*) FILTER (event_type = 'click') AS n_clicks
        FROM events WHERE ts < TIMESTAMP '2024-01-16 00:00:00' GROUP BY user_id),
      b AS (
        SELECT user_id, max(ts) AS ts, arg_max(event_type, ts) AS event_type, count(*) AS n_events,
               count(*) FILTER (event_type = 'click') AS n_clicks
        FROM events WHERE ts >= TIMESTAMP '2024-01-16 00:00:00' GROUP BY user_id),
      merged AS (
        SELECT user_id, b.ts, b.event_type, b.n_events + coalesce(a.n_events, 0) AS n_events,
               b.n_clicks + coalesce(a.n_clicks, 0) AS n_clicks
        FROM b LEFT JOIN a USING (user_id))
      """

QUERIES = {
    "star_enrich": (star_enrich, """
      SELECT o_orderkey, c_mktsegment, n_name, r_name
      FROM orders JOIN customer ON c_custkey = o_custkey
        LEFT JOIN nation ON n_nationkey = c_nationkey
        LEFT JOIN region ON r_regionkey = n_regionkey"""),
    "assembled_features": (assembled_features, """
      SELECT o_orderkey, o_custkey, count(*) AS n_lines,
             nullif(count(*) FILTER (l_returnflag = 'R'), 0) AS n_returned
      FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_custkey"""),
    "lookup_names": (lookup_names, """
      SELECT l_orderkey, l_suppkey, l_partkey, s_name AS supplier_name, p_name AS part_name
      FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey
        LEFT JOIN part ON p_partkey = l_partkey"""),
    "outer_users": (outer_users, """
      SELECT user_id, n_clicks, n_errors
      FROM (SELECT user_id, count(*) AS n_clicks FROM events
            WHERE event_type = 'click' GROUP BY user_id)
      FULL JOIN (SELECT user_id, count(*) AS n_errors FROM events
            WHERE event_type = 'error' GROUP BY user_id) USING (user_id)"""),
    "customers_without_success": (customers_without_success, """
      SELECT c_custkey AS o_custkey FROM customer WHERE c_custkey NOT IN (
        SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')"""),
    "concat_frames": (concat_frames, """
      SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS o_totalprice,
             CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority
      FROM orders"""),
    "asof_click_before_purchase": (asof_click_before_purchase, """
      SELECT l.event_id,
             CASE WHEN r.ts >= l.ts - INTERVAL 6 HOUR THEN r.event_id END AS click_event_id,
             CASE WHEN r.ts >= l.ts - INTERVAL 6 HOUR THEN epoch_us(r.ts) END AS click_ts_us,
             CASE WHEN r.ts >= l.ts - INTERVAL 6 HOUR THEN r.value END AS click_value
      FROM (SELECT * FROM events WHERE event_type = 'purchase') l
      ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') r
        ON r.user_id = l.user_id AND r.ts <= l.ts"""),
    "asof_any_age": (asof_any_age, """
      SELECT l.event_id, r.event_id AS click_event_id
      FROM (SELECT * FROM events WHERE event_type = 'purchase') l
      ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') r
        ON r.user_id = l.user_id AND r.ts <= l.ts"""),
    "banded_nearest_event": (banded_nearest_event, """
      WITH l AS (SELECT *, epoch_us(ts) // 1000000 AS s FROM events WHERE event_type = 'purchase'),
      r AS (SELECT *, epoch_us(ts) // 1000000 AS s FROM events WHERE event_type = 'view'),
      pairs AS (
        SELECT l.event_id, r.event_id AS view_event_id, (l.s - r.s) / 3600 AS lag
        FROM l JOIN r USING (user_id)),
      best AS (
        SELECT event_id, min(lag) FILTER (lag BETWEEN 48 AND 2160) AS lag,
               count(*) FILTER (lag >= 0 AND lag < 48) AS recent,
               count(*) FILTER (lag > 2160) AS stale
        FROM pairs GROUP BY event_id)
      SELECT l.event_id, p.view_event_id, round(b.lag, 6) AS duration_hours,
             CASE WHEN b.lag IS NOT NULL THEN 'matched' WHEN recent > 0 THEN 'recent'
                  WHEN stale > 0 THEN 'stale' ELSE 'none' END AS lag_band,
             CASE WHEN b.lag IS NOT NULL THEN 'old' ELSE 'new' END AS user_type
      FROM l LEFT JOIN best b USING (event_id)
        LEFT JOIN pairs p ON p.event_id = l.event_id AND p.lag = b.lag"""),
    "dedup_last": (dedup_last_line, """
      SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
             epoch_us(l_shipdate) AS l_shipdate_us
      FROM (SELECT *, row_number() OVER (
              PARTITION BY l_orderkey, l_linenumber
              ORDER BY l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
                       l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC,
                       l_shipdate DESC) AS rn FROM lineitem)
      WHERE rn = 1"""),
    "merge_counters": (merge_counters_query, SLICES_SQL + """
      SELECT user_id, epoch_us(ts) AS ts_us, event_type, n_events, n_clicks FROM merged"""),
    "fold_main_table": (fold_main_table, SLICES_SQL + """
      SELECT user_id, epoch_us(ts) AS ts_us, event_type, n_events, n_clicks FROM merged
      UNION ALL
      SELECT user_id, epoch_us(ts), event_type, n_events, n_clicks FROM a
      WHERE user_id NOT IN (SELECT user_id FROM b)"""),
    "json_props": (json_props, """
      SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k_text,
             CAST(json_extract(props, '$.k') AS INT) AS k_struct,
             CAST(json_extract(props, '$.k') AS INT) AS k_clean FROM events"""),
    "json_lists": (json_lists, """
      SELECT l_orderkey, CAST(count(DISTINCT l_linenumber) FILTER (l_returnflag = 'R')
             + count(DISTINCT l_linenumber) FILTER (l_returnflag = 'A') AS INT) AS n_seen
      FROM lineitem GROUP BY l_orderkey"""),
    "array_dimension": (array_dimension, """
      SELECT l_orderkey, min(l_suppkey) FILTER (l_linenumber = 3) AS value
      FROM lineitem GROUP BY l_orderkey"""),
    "json_payload_inline": (json_payload_inline, """
      SELECT event_id * 2 + i AS order_id, user_id AS ga_id,
             epoch_us(ts) // 1000 * 1000 AS transaction_timestamp_us
      FROM events, (VALUES (0), (1)) v(i)"""),
    "payload_with_rejects": (payload_with_rejects, """
      SELECT event_id, event_id % 5 <> 0 AS parsed FROM events"""),
    "scalar_functions": (scalar_functions, """
      SELECT o_orderkey,
             CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority ELSE 'other' END AS upi_bank,
             CASE o_orderkey % 3 WHEN 0 THEN o_orderpriority WHEN 1 THEN 'other' END
               AS upi_bank_or_null,
             substr(o_orderpriority, 1, 4) AS account_bank,
             CASE WHEN o_orderstatus <> 'P' THEN 'web' END AS medium,
             round(ln(greatest(1, o_totalprice)), 6) AS log_price,
             CAST(hour(o_orderdate + INTERVAL 330 MINUTE) AS INT) AS local_hour,
             CAST(month(o_orderdate) AS INT) AS month, TRY_CAST(o_orderpriority AS INT) AS as_number,
             CASE WHEN o_totalprice > 100000 THEN 'yes' ELSE 'no' END AS large
      FROM orders"""),
    "top_parts": (top_parts, """
      SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey
      ORDER BY n DESC, l_partkey LIMIT 20"""),
}
