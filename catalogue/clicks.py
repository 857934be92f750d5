"""Clickstream queries on ``events``: visitor = user, category = event type."""

from dataclasses import replace

from pyspark.sql import functions as F

from catalogue.tables import events, parity, rounded, source, us
from pitfeat.operators import history as h
from pitfeat.operators import sessions as s
from pitfeat.operators.joins import union_sources
from pitfeat.operators.reduce import latest_per_key
from pitfeat.operators.slices import run_placed
from pitfeat.plans import clickstream as plan
from pitfeat.plans import training
from pitfeat.checkpoints import shared_dir
from pitfeat.sources.buckets import BucketedTable
from pitfeat.streaming import incremental, open_sessions
from pitfeat.streaming.sessions import run_to_table, stream_dedup, stream_sessions

BY, T, TIE, GAP = ["user_id"], "ts", ["event_id"], 21_600
SESSION = ["user_id", "session_n"]
MARK = "2024-01-16 00:00:00"


def is_type(*kinds):
    return F.col("event_type").isin(*kinds)


def hourly(spark, sf):
    """Events with times cut to the hour, so that many are equal."""
    return events(spark, sf).withColumn("ts", F.date_trunc("hour", "ts"))


def on_sessions(spark, sf, chain=lambda d: d, read=events):
    """Sessions of the events and a chain of operators on top, by user."""
    def whole(d):
        d = s.sessionize(d, BY, T, GAP)
        return chain(s.session_stats(d, BY, T, tie=TIE))

    return run_placed(read(spark, sf), BY, T, whole)


def cte(gap=GAP):
    """Sessions by lag and running sum, bounds by grouping."""
    return f"""
      WITH gaps AS (
        SELECT *, epoch_us(ts) // 1000000 AS sec,
               lag(epoch_us(ts) // 1000000) OVER (PARTITION BY user_id ORDER BY ts) AS before
        FROM events),
      numbered AS (
        SELECT *, CAST(sum(CASE WHEN sec - before > {gap} THEN 1 ELSE 0 END)
                  OVER (PARTITION BY user_id ORDER BY ts) AS BIGINT) AS session_n
        FROM gaps),
      bounds AS (
        SELECT user_id, session_n, min(ts) AS session_start, max(ts) AS session_end,
               count(*) AS number_of_hits,
               max(epoch_us(ts) // 1000000) - min(epoch_us(ts) // 1000000) AS session_time
        FROM numbered GROUP BY user_id, session_n),
      s AS (
        SELECT n.*, b.session_start, b.session_end, b.number_of_hits, b.session_time,
               CAST(row_number() OVER (PARTITION BY n.user_id, n.session_n
                                       ORDER BY n.ts, n.event_id) AS INT) AS hit_number
        FROM numbered n JOIN bounds b USING (user_id, session_n))
    """


def sessionize_events(spark, sf, gap=1800):
    d = s.sessionize(events(spark, sf), BY, T, gap)
    return d.select("event_id", "session_n", "session_id")


def sessionize_sql(gap):
    return cte(gap) + """
      SELECT event_id, session_n, user_id || '_' || session_n AS session_id FROM s"""


def session_stats(spark, sf):
    return on_sessions(spark, sf).select(
        "event_id", *us("session_start", "session_end"), "session_time",
        "number_of_hits", "hit_number",
    )


def session_intent_success(spark, sf):
    def chain(d):
        d = s.intent_and_success(d, SESSION, T, is_type("click"), is_type("purchase"))
        return s.after_intent_measures(s.first_session(d, BY), T)

    return on_sessions(spark, sf, chain).select(
        "event_id", *us("first_transaction_time", "transaction_success_time"),
        "seconds_since_first_session", "seconds_after_transaction",
        "hits_after_transaction", "seconds_on_payment_gateway",
    )


INTENT_SQL = cte() + """,
      marks AS (
        SELECT user_id, session_n, min(ts) FILTER (event_type = 'click') AS intent,
               min(ts) FILTER (event_type = 'purchase') AS success
        FROM s GROUP BY user_id, session_n),
      firsts AS (SELECT user_id, min(session_start) AS f FROM s GROUP BY user_id)
      SELECT event_id, epoch_us(intent) AS first_transaction_time_us,
             epoch_us(success) AS transaction_success_time_us,
             epoch_us(ts) // 1000000 - epoch_us(f) // 1000000 AS seconds_since_first_session,
             epoch_us(session_end) // 1000000 - epoch_us(intent) // 1000000
               AS seconds_after_transaction,
             number_of_hits - hit_number AS hits_after_transaction,
             epoch_us(success) // 1000000 - epoch_us(intent) // 1000000
               AS seconds_on_payment_gateway
      FROM s JOIN marks USING (user_id, session_n) JOIN firsts USING (user_id)"""


def session_flags(spark, sf):
    flags = {
        "already_logged_in": is_type("signup"),
        "checked_offers": is_type("view"),
        "reached_homepage_first": is_type("error"),
    }
    d = on_sessions(spark, sf, lambda d: s.session_flags(d, SESSION, T, flags))
    return d.select("event_id", *flags)


def first_session(spark, sf):
    d = on_sessions(spark, sf, lambda d: s.first_session(d, BY))
    return d.select("event_id", *us("first_session_start"))


def anchor_sessions(spark, sf):
    d = on_sessions(
        spark, sf, lambda d: s.sessions_touching(d, SESSION, T, is_type("purchase"))
    )
    return d.select("event_id", "user_id", "session_n")


# which (category, action) pairs count, here event type and platform
RULES = [
    ("click", "app"), ("click", "web"), ("purchase", "app"), ("purchase", "web"),
    ("signup", "web"), ("view", "app"),
]
RULES_SQL = ", ".join(f"('{c}', '{a}')" for c, a in RULES)


def rules(spark):
    return spark.createDataFrame(RULES, "event_type string, source string")


def whitelisted_events(spark, sf):
    d = events(spark, sf).withColumn("source", source())
    return s.keep_events(d, rules(spark), ["event_type", "source"]).select(
        "event_id", "event_type", "source"
    )


def prior_sessions(spark, sf, per="event", read=events):
    d = on_sessions(spark, sf, lambda d: plan.session_history(d, BY, T, per), read)
    return d.select(
        "event_id", "number_of_sessions",
        *rounded(6, "mean_number_of_sessions", "median_number_of_sessions",
                 "mean_session_time", "median_session_time"),
    )


def prior_sessions_sql(per):
    rows = {
        # a session weighs as much as it has distinct event times
        "event": "SELECT DISTINCT user_id, session_n, ts, session_start, session_time, n FROM z",
        "session": "SELECT DISTINCT user_id, session_n, session_start, session_time, n FROM z",
    }[per]
    return cte() + f""",
      z AS (
        SELECT a.event_id, a.user_id, a.session_n, a.ts, a.session_start, a.session_time,
               count(DISTINCT b.session_n) AS n
        FROM s a LEFT JOIN s b ON b.user_id = a.user_id AND b.session_start < a.session_start
        GROUP BY ALL),
      w AS ({rows})
      SELECT a.event_id, a.n AS number_of_sessions,
             round(avg(w.n), 6) AS mean_number_of_sessions,
             round(median(w.n), 6) AS median_number_of_sessions,
             round(avg(w.session_time), 6) AS mean_session_time,
             round(median(w.session_time), 6) AS median_session_time
      FROM z a LEFT JOIN w ON w.user_id = a.user_id AND w.session_start < a.session_start
      GROUP BY a.event_id, a.n"""


def prior_nonanchor_counts(spark, sf):
    d = on_sessions(
        spark, sf, lambda d: plan.non_anchor_history(d, BY, T, is_type("purchase"))
    )
    return d.select("event_id", "number_of_non_anchor_actions", "number_of_non_anchor_sessions")


def prior_value_sums_and_kinds(spark, sf):
    aggs = {
        "number_of_sessions": h.distinct("session_n"),
        "number_of_page_views": h.total("value"),
        "number_of_devices_used": h.distinct("event_type"),
        "number_of_app_sessions": h.distinct(F.when(parity() == 1, F.col("session_n"))),
    }
    d = on_sessions(spark, sf, lambda d: h.prior_agg(d, BY, T, aggs))
    share = F.try_divide(F.col("hit_number"), F.col("number_of_hits"))
    return d.select(
        "event_id", "number_of_sessions", *rounded(2, "number_of_page_views"),
        "number_of_devices_used", "number_of_app_sessions",
        F.round(share, 6).alias("hit_share"),
    )


def trailing_7d_activity(spark, sf):
    d = h.trailing_agg(
        events(spark, sf), BY, T, 7 * 86_400,
        {
            "n": h.count(), "n_clicks": h.count(is_type("click")), "total": h.total("value"),
            "mean": h.mean("value"), "half": h.median("value"), "kinds": h.distinct("event_type"),
        },
    )
    return d.select("event_id", "n", "n_clicks", *rounded(2, "total"),
                    *rounded(6, "mean", "half"), "kinds")


TRAILING_SQL = """
      SELECT a.event_id, count(b.event_id) AS n,
             count(b.event_id) FILTER (b.event_type = 'click') AS n_clicks,
             round(sum(b.value), 2) AS total, round(avg(b.value), 6) AS mean,
             round(median(b.value), 6) AS half, count(DISTINCT b.event_type) AS kinds
      FROM events a JOIN events b ON b.user_id = a.user_id
        AND b.ts BETWEEN a.ts - INTERVAL 7 DAY AND a.ts
      GROUP BY a.event_id"""


def trailing_session_history(spark, sf):
    """Sessions of the last 7 days, the current one included, and means over them."""
    start, width = "session_start", 7 * 86_400

    def chain(d):
        d = h.trailing_agg(d, BY, start, width, {"number_of_sessions": h.distinct(start)})
        return h.trailing_agg(
            d, BY, start, width,
            {
                "mean_number_of_sessions": h.mean("number_of_sessions"),
                "median_session_time": h.median("session_time"),
            },
        )

    d = on_sessions(spark, sf, chain)
    return d.select("event_id", "number_of_sessions",
                    *rounded(6, "mean_number_of_sessions", "median_session_time"))


TRAILING_SESSION_SQL = cte() + """,
      z AS (
        SELECT a.event_id, a.user_id, a.session_start, a.session_time,
               count(DISTINCT b.session_n) AS n
        FROM s a LEFT JOIN s b ON b.user_id = a.user_id
          AND b.session_start BETWEEN a.session_start - INTERVAL 7 DAY AND a.session_start
        GROUP BY ALL)
      SELECT a.event_id, a.n AS number_of_sessions,
             round(avg(b.n), 6) AS mean_number_of_sessions,
             round(median(b.session_time), 6) AS median_session_time
      FROM z a JOIN z b ON b.user_id = a.user_id
        AND b.session_start BETWEEN a.session_start - INTERVAL 7 DAY AND a.session_start
      GROUP BY a.event_id, a.n"""


def trailing_nonanchor_counts(spark, sf):
    """Non-anchor events and their sessions of the last 7 days, the event included."""
    other = ~is_type("purchase")
    aggs = {
        "actions": h.count(other),
        "sessions": h.distinct(F.when(other, F.col("session_n"))),
    }
    d = on_sessions(spark, sf, lambda d: h.trailing_agg(d, BY, T, 7 * 86_400, aggs))
    return d.select("event_id", "actions", "sessions")


def trailing_long(spark, sf):
    """The last day of all events of a kind: histories too long for a frame."""
    aggs = {
        "n": h.count(), "total": h.total("value"), "half": h.median("value"),
        "users": h.distinct("user_id"),
    }
    d = h.trailing_agg(
        events(spark, sf), ["event_type"], T, 86_400, aggs, frame_rows=500
    )
    return d.select("event_id", "n", *rounded(2, "total"), *rounded(6, "half"), "users")


def trailing_spikes(spark, sf):
    """Totals over a day where a few events carry a huge value or none: no trace may stay."""
    value = F.when(F.col("event_id") % 977 == 0, 1e17).when(
        F.col("event_id") % 983 == 0, float("inf")).otherwise(F.floor("value"))
    d = events(spark, sf).withColumn("v", value)
    aggs = {"n": h.count(), "total": h.total("v"), "least": h.lowest("v"), "most": h.highest("v")}
    d = h.trailing_agg(d, ["event_type"], T, 86_400, aggs, frame_rows=500)
    big = F.col("total") >= 1e16
    # sums that hold a huge value are rounded differently by each engine
    return d.select("event_id", "n", F.when(~big, F.col("total")).alias("total"), big.alias("big"),
                    "least", (F.col("most") >= 1e16).alias("spike"))


def union_web_app(spark, sf):
    e = events(spark, sf)
    web = e.where(parity() == 0).select("user_id", F.col("event_id").alias("order_id"), T)
    app = e.where(parity() == 1).select(F.col("event_id").alias("order_id"), T, "user_id")
    both = union_sources({"app": app, "web": web})
    return both.groupBy("source", "user_id").agg(
        F.count("*").alias("n"), F.max("order_id").alias("last_order"),
    )


def latest_per_user(spark, sf):
    return latest_per_key(events(spark, sf), BY, T, TIE).select(
        "user_id", "event_id", *us(T), "event_type", "value"
    )


def clicks_of(spark):
    return plan.Clicks(
        visitor="user_id", time=T, tie=TIE, anchor=is_type("purchase"),
        intent=is_type("click"), success=is_type("purchase"),
        flags={"already_logged_in": is_type("signup"), "checked_offers": is_type("view")},
        rules=rules(spark), rule_columns=["event_type", "source"], gap_s=GAP,
    )


CLICK_COLUMNS = [
    "event_id", "user_id", "session_id", "number_of_hits", "hit_number", "session_time",
    "number_of_sessions", "number_of_non_anchor_actions", "number_of_non_anchor_sessions",
    "seconds_since_first_session", "seconds_after_transaction", "hits_after_transaction",
    "seconds_on_payment_gateway", "already_logged_in", "checked_offers",
]
CLICK_ROUNDED = ["mean_number_of_sessions", "median_number_of_sessions",
                 "mean_session_time", "median_session_time"]


def click_features(spark, sf):
    d = events(spark, sf).withColumn("source", source())
    d = plan.click_features(d, clicks_of(spark))
    return d.select(*CLICK_COLUMNS, *rounded(6, *CLICK_ROUNDED))


def click_features_latest(spark, sf):
    d = events(spark, sf).withColumn("source", source())
    d = plan.latest_features(d, clicks_of(spark))
    return d.select(*CLICK_COLUMNS, *rounded(6, *CLICK_ROUNDED))


def click_features_trailing(spark, sf):
    """The same over histories that end with the event: the last seven days of it."""
    d = events(spark, sf).withColumn("source", source())
    d = plan.click_features(d, replace(clicks_of(spark), trailing_s=7 * 86_400))
    return d.select(*CLICK_COLUMNS, *rounded(6, *CLICK_ROUNDED))


def hits(spark, sf):
    """Events as hits of analytics sessions, a session a day."""
    k = F.get_json_object("props", "$.k").cast("int")
    return events(spark, sf).select(
        "event_id", "user_id", T, F.date_format(T, "yyyy-MM-dd").alias("session_id"), k.alias("page_views"),
        (k % 7).alias("screen_views"), F.col("event_type").alias("brand"), (k * 10).alias("time_on_site"),
        (F.col("event_id") % 5).alias("hit_number"), (F.col("event_id") % 4).alias("no_hits"))


def hit_history(spark, sf):
    d = plan.hit_history(hits(spark, sf), BY, T)
    return d.select(
        "event_id", "number_of_sessions", "number_of_page_views", "number_of_screen_views", "number_of_devices_used",
        *rounded(6, "mean_number_of_sessions", "mean_session_time", "median_number_of_sessions",
                 "median_session_time", "hit_occurence_wrt_total_hits"))


HIT_SQL = """
      WITH h AS (
        SELECT event_id, user_id, ts, strftime(ts, '%Y-%m-%d') AS day, CAST(json_extract(props, '$.k') AS INT) AS k,
               event_type, event_id % 5 AS hit_number, event_id % 4 AS no_hits FROM events),
      z AS (
        SELECT a.event_id, a.user_id, a.ts, a.k, a.hit_number, a.no_hits, count(DISTINCT b.day) AS n,
               sum(b.k) AS pages, sum(b.k % 7) AS screens, count(DISTINCT b.event_type) AS brands
        FROM h a LEFT JOIN h b ON b.user_id = a.user_id AND b.ts < a.ts GROUP BY ALL)
      SELECT a.event_id, a.n AS number_of_sessions, CAST(a.pages AS BIGINT) AS number_of_page_views,
             CAST(a.screens AS BIGINT) AS number_of_screen_views, a.brands AS number_of_devices_used,
             round(avg(b.n), 6) AS mean_number_of_sessions, round(avg(b.k * 10), 6) AS mean_session_time,
             round(median(b.n), 6) AS median_number_of_sessions, round(median(b.k * 10), 6) AS median_session_time,
             round(a.hit_number / nullif(a.no_hits, 0), 6) AS hit_occurence_wrt_total_hits
      FROM z a LEFT JOIN z b ON b.user_id = a.user_id AND b.ts < a.ts
      GROUP BY a.event_id, a.n, a.pages, a.screens, a.brands, a.hit_number, a.no_hits"""


def training_rows(spark, sf):
    """Purchases with the last click of six hours before, and labels spread by person and device."""
    e = events(spark, sf)
    person = F.get_json_object("props", "$.k").cast("int") + 100 * (F.col("event_id") % 40)
    bought = e.where(is_type("purchase")).select(
        "event_id", "user_id", T, person.alias("person"), F.when(F.col("event_id") % 97 == 0, 1).otherwise(0).alias("label"))
    clicks = e.select("user_id", F.col(T).alias("click_ts"), F.col("event_id").alias("click_id"), "event_type")
    d = training.training_rows(bought, clicks, is_type("click"), "user_id", T, "click_ts", "person", "label",
                               ["click_id"], 6 * 3600)
    return d.select("event_id", "click_id", "person", "label")


TRAINING_SQL = """
      WITH p AS (
        SELECT event_id, user_id, ts, CAST(json_extract(props, '$.k') AS INT) + 100 * (event_id % 40) AS person,
               CAST(event_id % 97 = 0 AS INT) AS label
        FROM events WHERE event_type = 'purchase'),
      m AS (
        SELECT p.*, CASE WHEN r.ts >= p.ts - INTERVAL 6 HOUR THEN r.event_id END AS click_id
        FROM p ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') r
          ON r.user_id = p.user_id AND r.ts <= p.ts)
      SELECT event_id, click_id, person, CAST(label = 1 OR person IN (
               SELECT person FROM m WHERE label = 1 UNION
               SELECT person FROM m WHERE user_id IN (SELECT user_id FROM m WHERE label = 1)) AS INT) AS label
      FROM m"""


CLICK_CTE = cte() + f""",
      tagged AS (
        SELECT *, CASE WHEN CAST(json_extract(props, '$.k') AS INT) % 2 = 0
                       THEN 'web' ELSE 'app' END AS source FROM s),
      k AS (
        SELECT * FROM tagged
        WHERE (event_type, source) IN ({RULES_SQL})
          AND (user_id, session_n) IN (
            SELECT (user_id, session_n) FROM s WHERE event_type = 'purchase')),
      z AS (
        SELECT a.event_id, a.user_id, a.ts, a.session_start, a.session_time,
               count(DISTINCT b.session_n) AS n
        FROM k a LEFT JOIN k b ON b.user_id = a.user_id AND b.session_start < a.session_start
        GROUP BY ALL),
      zt AS (SELECT DISTINCT user_id, ts, session_start, session_time, n FROM z),
      past AS (
        SELECT a.event_id, a.n AS number_of_sessions,
               round(coalesce(avg(b.n), 0), 6) AS mean_number_of_sessions,
               round(coalesce(median(b.n), 0), 6) AS median_number_of_sessions,
               round(coalesce(avg(b.session_time), 0), 6) AS mean_session_time,
               round(coalesce(median(b.session_time), 0), 6) AS median_session_time
        FROM z a LEFT JOIN zt b ON b.user_id = a.user_id AND b.session_start < a.session_start
        GROUP BY a.event_id, a.n),
      other AS (
        SELECT a.event_id, count(b.event_id) AS number_of_non_anchor_actions,
               count(DISTINCT b.session_n) AS number_of_non_anchor_sessions
        FROM k a LEFT JOIN k b ON b.user_id = a.user_id AND b.ts < a.ts
          AND b.event_type <> 'purchase'
        GROUP BY a.event_id),
      marks AS (
        SELECT user_id, session_n, min(ts) FILTER (event_type = 'click') AS intent,
               min(ts) FILTER (event_type = 'purchase') AS success,
               max(CAST(event_type = 'signup' AS INT)) AS already_logged_in,
               max(CAST(event_type = 'view' AS INT)) AS checked_offers
        FROM k GROUP BY user_id, session_n),
      firsts AS (SELECT user_id, min(session_start) AS f FROM k GROUP BY user_id),
      features AS (
        SELECT event_id, user_id, ts, user_id || '_' || session_n AS session_id,
               number_of_hits, hit_number, session_time, number_of_sessions,
               number_of_non_anchor_actions, number_of_non_anchor_sessions,
               epoch_us(ts) // 1000000 - epoch_us(f) // 1000000 AS seconds_since_first_session,
               epoch_us(session_end) // 1000000 - epoch_us(intent) // 1000000
                 AS seconds_after_transaction,
               number_of_hits - hit_number AS hits_after_transaction,
               epoch_us(success) // 1000000 - epoch_us(intent) // 1000000
                 AS seconds_on_payment_gateway,
               already_logged_in, checked_offers, mean_number_of_sessions,
               median_number_of_sessions, mean_session_time, median_session_time
        FROM k JOIN past USING (event_id) JOIN other USING (event_id)
          JOIN marks USING (user_id, session_n) JOIN firsts USING (user_id))
    """


# the same with histories from seven days before the event's session, or the event, up to it
TRAILING_CLICK_CTE = CLICK_CTE.replace(
    "b.session_start < a.session_start",
    "b.session_start BETWEEN a.session_start - INTERVAL 7 DAY AND a.session_start").replace(
    "b.ts < a.ts", "b.ts BETWEEN a.ts - INTERVAL 7 DAY AND a.ts")


def incremental_sessions(spark, sf):
    """Sessions after one increment, open sessions read again from their start."""
    e = events(spark, sf)
    mark = incremental.stored_mark(e.where(F.col(T) < MARK), T)
    main = incremental.session_table(e.where(F.col(T) <= F.lit(mark)), BY, T, GAP)
    d = incremental.refresh_sessions(e, main, BY, T, GAP, mark)
    return d.select("user_id", *us("session_start", "session_end"), "number_of_hits")


LATE = "event_id % 10 = 3"


def arrived(spark, sf):
    """Events with a time of arrival: some arrive ten days after they happened."""
    late = F.when(F.expr(LATE), F.col(T) + F.expr("INTERVAL 10 DAYS"))
    return events(spark, sf).withColumn("arrived", F.coalesce(late, F.col(T)))


def late_increment(spark, sf):
    """Events, the session table of the first run, and the rows that arrived after its mark."""
    e = arrived(spark, sf)
    mark = incremental.stored_mark(e.where(F.col("arrived") < MARK), "arrived")
    main = incremental.session_table(e.where(F.col("arrived") <= F.lit(mark)), BY, T, GAP)
    return e, main, incremental.rows_after(e, "arrived", mark)


def incremental_with_late_rows(spark, sf):
    """Sessions after an increment with rows of any age, those of closed sessions included."""
    _, main, delta = late_increment(spark, sf)
    d = incremental.refresh_with_late_rows(main, delta, BY, T, GAP)
    return d.select("user_id", *us("session_start", "session_end"), "number_of_hits")


def late_rows_recomputed(spark, sf):
    """Session features after that increment: computed again for reopened sessions only."""
    e, main, delta = late_increment(spark, sf)
    first = e.join(delta.select("event_id"), "event_id", "left_anti")
    features = ["event_id", "session_start", "session_end", "number_of_hits", "hit_number"]

    def stats(d):
        d = run_placed(d, BY, T, lambda x: s.session_stats(s.sessionize(x, BY, T, GAP), BY, T, tie=TIE))
        return d.select("user_id", T, *features)

    merged = incremental.merge_sessions(main, incremental.session_table(delta, BY, T, GAP), BY, GAP)
    again = incremental.rows_of_sessions(e, merged.where("reopened"), BY, T)
    fresh = stats(again)
    kept = stats(first).join(again.select("event_id"), "event_id", "left_anti")
    return kept.unionByName(fresh).select(
        "event_id", *us("session_start", "session_end"), "number_of_hits", "hit_number")


def rows_after_mark(spark, sf):
    """High-water mark of the first slice and the rows beyond it."""
    e = events(spark, sf)
    mark = incremental.stored_mark(e.where(F.col(T) < MARK), T)
    return incremental.rows_after(e, T, mark).groupBy("event_type").agg(
        F.count("*").alias("n"), F.min("event_id").alias("first_event")
    )


def landed_stream(spark, sf):
    """The events file as a stream; its times arrive without a zone."""
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    d = incremental.read_stream(spark, sf, schema, "events.parquet")
    return d.withColumn(T, F.col(T).cast("timestamp"))


def run_folder(spark, name):
    import uuid

    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def closed_stream_sessions(spark, sf):
    """Sessions that a stream over the events has closed, watermark one hour."""
    root = run_folder(spark, "stream-sessions")
    d = stream_sessions(landed_stream(spark, sf), BY, T, GAP, "1 hour")
    run_to_table(d, f"{root}/out", f"{root}/checkpoint")
    out = spark.read.schema(d.schema).parquet(f"{root}/out")
    return out.select("user_id", *us("session_start", "session_end"), "number_of_hits")


CLOSED_SQL = cte() + """
      SELECT user_id, epoch_us(session_start) AS session_start_us,
             epoch_us(session_end) AS session_end_us, number_of_hits
      FROM bounds
      WHERE epoch_us(session_end) // 1000000 + 21601
            <= (SELECT max(epoch_us(ts)) // 1000000 - 3600 FROM events)"""


def stream_distinct_events(spark, sf):
    """Every event delivered twice, deduplicated on the stream."""
    root = run_folder(spark, "stream-dedup")
    d = landed_stream(spark, sf).select("event_id", "user_id", T)
    twice = d.withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1)))).drop("_copy")
    out = stream_dedup(twice, ["event_id"], T, "1 hour")
    run_to_table(out, f"{root}/out", f"{root}/checkpoint")
    return spark.read.schema(out.schema).parquet(f"{root}/out").select("event_id", "user_id")


def stream_folded_counters(spark, sf):
    """Per-user counters folded from the stream into a table, batch by batch."""
    return folded(spark, sf, 1)


def fold_two_streams(spark, sf):
    """Two streams with checkpoints of their own folded into one table: all counts double."""
    return folded(spark, sf, 2)


def fold_buckets(spark, sf):
    """Counters folded in three batches into hash buckets, the last of them twice."""
    table = BucketedTable(spark, f"{run_folder(spark, 'buckets')}/main", BY, buckets=16)
    cuts = ["2000-01-01", "2024-01-10", "2024-01-20", "2100-01-01"]
    parts = [events(spark, sf).where(F.col(T).between(*pair) & (F.col(T) < pair[1])) for pair in zip(cuts, cuts[1:])]
    for batch, part in enumerate([*parts, parts[-1]]):
        table.fold(part, fold_counters, "events", min(batch, len(parts) - 1))
    return table.read()


def fold_counters(stored, delta):
    new = delta.groupBy("user_id").agg(F.count("*").alias("n"), F.count_if(is_type("click")).alias("n_clicks"))
    both = new if stored is None else stored.unionByName(new)
    return both.groupBy("user_id").agg(F.sum("n").alias("n"), F.sum("n_clicks").alias("n_clicks"))


def all_stream_sessions(spark, sf):
    """Sessions so far, open ones included, from files that land in three steps: the last has late rows."""
    root = run_folder(spark, "stream-all-sessions")
    e = events(spark, sf)
    late = F.expr(LATE)
    parts = [e.where(~late & (F.col(T) < MARK)), e.where(~late & (F.col(T) >= MARK)), e.where(late)]
    other = open_sessions.stateful_session(spark)
    for part in parts:
        part.write.mode("append").parquet(f"{root}/in")
        landed = incremental.read_stream(other, f"{root}/in", e.schema)
        log = open_sessions.session_log(landed, BY, T, GAP, "60 days")
        run_to_table(log, f"{root}/log", f"{root}/checkpoint")
    found = open_sessions.sessions_so_far(spark.read.schema(log.schema).parquet(f"{root}/log"), BY)
    return found.select("user_id", *us("session_start", "session_end"), "number_of_hits")


def folded(spark, sf, times):
    root = run_folder(spark, "stream-fold")
    main = BucketedTable(spark, f"{root}/main", BY, buckets=16)

    for i in range(times):
        query = incremental.fold_stream(landed_stream(spark, sf), main, fold_counters, f"{root}/checkpoint-{i}")
        query.awaitTermination()
    return main.read()


HOURLY = """
      WITH hourly AS (SELECT * REPLACE (date_trunc('hour', ts) AS ts) FROM events)"""


QUERIES = {
    "sessionize_events": (sessionize_events, sessionize_sql(1800)),
    "sessionize_events_6h": (lambda sp, sf: sessionize_events(sp, sf, GAP), sessionize_sql(GAP)),
    "session_stats": (session_stats, cte() + """
      SELECT event_id, epoch_us(session_start) AS session_start_us,
             epoch_us(session_end) AS session_end_us, session_time, number_of_hits, hit_number
      FROM s"""),
    "session_intent_success": (session_intent_success, INTENT_SQL),
    "session_flags": (session_flags, cte() + """
      SELECT a.event_id,
             max(CAST(b.event_type = 'signup' AS INT)) AS already_logged_in,
             max(CAST(b.event_type = 'view' AS INT)) AS checked_offers,
             max(CAST(b.event_type = 'error' AS INT)) AS reached_homepage_first
      FROM s a JOIN s b USING (user_id, session_n) GROUP BY a.event_id"""),
    "first_session": (first_session, """
      SELECT event_id, epoch_us(f) AS first_session_start_us FROM events
      JOIN (SELECT user_id, min(ts) AS f FROM events GROUP BY user_id) USING (user_id)"""),
    "anchor_sessions": (anchor_sessions, cte() + """
      SELECT event_id, user_id, session_n FROM s WHERE (user_id, session_n) IN (
        SELECT (user_id, session_n) FROM s WHERE event_type = 'purchase')"""),
    "whitelisted_events": (whitelisted_events, f"""
      SELECT * FROM (
        SELECT event_id, event_type,
               CASE WHEN CAST(json_extract(props, '$.k') AS INT) % 2 = 0
                    THEN 'web' ELSE 'app' END AS source FROM events)
      WHERE (event_type, source) IN ({RULES_SQL})"""),
    "prior_sessions": (prior_sessions, prior_sessions_sql("event")),
    "prior_sessions_hourly": (
        lambda sp, sf: prior_sessions(sp, sf, read=hourly), HOURLY + prior_sessions_sql("event").replace("WITH", ",", 1).replace(
            "FROM events", "FROM hourly"),
    ),
    "prior_sessions_per_session": (
        lambda sp, sf: prior_sessions(sp, sf, "session"), prior_sessions_sql("session"),
    ),
    "prior_nonanchor_counts": (prior_nonanchor_counts, cte() + """
      SELECT a.event_id, count(b.event_id) AS number_of_non_anchor_actions,
             count(DISTINCT b.session_n) AS number_of_non_anchor_sessions
      FROM s a LEFT JOIN s b ON b.user_id = a.user_id AND b.ts < a.ts
        AND b.event_type <> 'purchase'
      GROUP BY a.event_id"""),
    "prior_value_sums_and_kinds": (prior_value_sums_and_kinds, cte() + """
      SELECT a.event_id, count(DISTINCT b.session_n) AS number_of_sessions,
             round(sum(b.value), 2) AS number_of_page_views,
             count(DISTINCT b.event_type) AS number_of_devices_used,
             count(DISTINCT b.session_n)
               FILTER (CAST(json_extract(b.props, '$.k') AS INT) % 2 = 1)
               AS number_of_app_sessions,
             round(a.hit_number / a.number_of_hits, 6) AS hit_share
      FROM s a LEFT JOIN s b ON b.user_id = a.user_id AND b.ts < a.ts
      GROUP BY a.event_id, a.hit_number, a.number_of_hits"""),
    "trailing_7d_activity": (trailing_7d_activity, TRAILING_SQL),
    "trailing_session_history": (trailing_session_history, TRAILING_SESSION_SQL),
    "trailing_nonanchor_counts": (trailing_nonanchor_counts, cte() + """
      SELECT a.event_id, count(b.event_id) AS actions, count(DISTINCT b.session_n) AS sessions
      FROM s a LEFT JOIN s b ON b.user_id = a.user_id AND b.event_type <> 'purchase'
        AND b.ts BETWEEN a.ts - INTERVAL 7 DAY AND a.ts
      GROUP BY a.event_id"""),
    "trailing_spikes": (trailing_spikes, """
      WITH e AS (SELECT *, CASE WHEN event_id % 977 = 0 THEN 1e17 WHEN event_id % 983 = 0
                   THEN CAST('inf' AS DOUBLE) ELSE CAST(floor(value) AS DOUBLE) END AS v FROM events)
      SELECT a.event_id, count(b.event_id) AS n,
             CASE WHEN max(b.v) < 1e16 THEN sum(b.v) END AS total, max(b.v) >= 1e16 AS big,
             min(b.v) AS least, max(b.v) >= 1e16 AS spike
      FROM e a LEFT JOIN e b ON b.event_type = a.event_type
        AND b.ts BETWEEN a.ts - INTERVAL 1 DAY AND a.ts
      GROUP BY a.event_id"""),
    "trailing_long": (trailing_long, """
      SELECT a.event_id, count(b.event_id) AS n, round(sum(b.value), 2) AS total,
             round(median(b.value), 6) AS half, count(DISTINCT b.user_id) AS users
      FROM events a JOIN events b ON b.event_type = a.event_type
        AND b.ts BETWEEN a.ts - INTERVAL 1 DAY AND a.ts
      GROUP BY a.event_id"""),
    "union_web_app": (union_web_app, """
      SELECT CASE WHEN CAST(json_extract(props, '$.k') AS INT) % 2 = 0
                  THEN 'web' ELSE 'app' END AS source,
             user_id, count(*) AS n, max(event_id) AS last_order
      FROM events GROUP BY 1, 2"""),
    "latest_per_user": (latest_per_user, """
      SELECT user_id, event_id, epoch_us(ts) AS ts_us, event_type, value FROM events e
      WHERE ts = (SELECT max(ts) FROM events x WHERE x.user_id = e.user_id)"""),
    "click_features": (click_features, CLICK_CTE + "SELECT * EXCLUDE (ts) FROM features"),
    "click_features_trailing": (click_features_trailing, TRAILING_CLICK_CTE + "SELECT * EXCLUDE (ts) FROM features"),
    "hit_history": (hit_history, HIT_SQL),
    "training_rows": (training_rows, TRAINING_SQL),
    "click_features_latest": (click_features_latest, CLICK_CTE + """
      SELECT * EXCLUDE (ts) FROM features f
      WHERE ts = (SELECT max(ts) FROM features g WHERE g.user_id = f.user_id)"""),
    "incremental_sessions": (incremental_sessions, cte() + """
      SELECT user_id, epoch_us(session_start) AS session_start_us,
             epoch_us(session_end) AS session_end_us, number_of_hits FROM bounds"""),
    "incremental_with_late_rows": (incremental_with_late_rows, cte() + """
      SELECT user_id, epoch_us(session_start) AS session_start_us,
             epoch_us(session_end) AS session_end_us, number_of_hits FROM bounds"""),
    "late_rows_recomputed": (late_rows_recomputed, cte() + """
      SELECT event_id, epoch_us(session_start) AS session_start_us,
             epoch_us(session_end) AS session_end_us, number_of_hits, hit_number FROM s"""),
    "stream_all_sessions": (all_stream_sessions, cte() + """
      SELECT user_id, epoch_us(session_start) AS session_start_us,
             epoch_us(session_end) AS session_end_us, number_of_hits FROM bounds"""),
    "fold_buckets": (fold_buckets, """
      SELECT user_id, count(*) AS n, count(*) FILTER (event_type = 'click') AS n_clicks
      FROM events GROUP BY user_id"""),
    "rows_after_mark": (rows_after_mark, """
      SELECT event_type, count(*) AS n, min(event_id) AS first_event FROM events
      WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-16 00:00:00')
      GROUP BY event_type"""),
    "stream_sessions": (closed_stream_sessions, CLOSED_SQL),
    "stream_distinct_events": (stream_distinct_events, "SELECT event_id, user_id FROM events"),
    "fold_two_streams": (fold_two_streams, """
      SELECT user_id, 2 * count(*) AS n, 2 * count(*) FILTER (event_type = 'click') AS n_clicks
      FROM events GROUP BY user_id"""),
    "stream_folded_counters": (stream_folded_counters, """
      SELECT user_id, count(*) AS n, count(*) FILTER (event_type = 'click') AS n_clicks
      FROM events GROUP BY user_id"""),
}
