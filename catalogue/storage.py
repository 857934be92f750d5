"""Queries that write tables, logs and streams, and read them back."""

from pyspark.sql import functions as F

from catalogue.clicks import run_folder
from catalogue.evaluation import REPORT, SCORED, scored
from catalogue.models import TRAINED_ON, fitted_model, training_set
from catalogue.tables import events, lineitem, orders, rounded, table, us
from pitfeat.checkpoints import cut_lineage
from pitfeat.operators import evaluate as ev
from pitfeat.operators import joins as j
from pitfeat.operators.model import score
from pitfeat.plans import scoring
from pitfeat.sources import payloads, sinks, tables
from pitfeat.sources.buckets import BucketedTable
from pitfeat.streaming import incremental, monitoring

# ---- payload elements

FIELDS = {"line": ("line", "int"), "quantity": ("qty", "int")}


def payload_elements(spark, sf):
    """Orders as payloads: some lines have text for a number, some are bare numbers, some payloads are cut."""
    line = (
        F.when(F.col("l_quantity") == 50, F.format_string('{"line":%d,"qty":"many"}', "l_linenumber"))
        .when(F.col("l_linenumber") == 7, F.lit("7"))
        .otherwise(F.format_string('{"line":%d,"qty":%d,"flag":"%s"}', "l_linenumber",
                                   F.col("l_quantity").cast("int"), "l_returnflag"))
    )
    lines = lineitem(spark, sf).groupBy("l_orderkey").agg(F.array_join(F.collect_list(line), ",").alias("all"))
    cut = F.when(F.col("l_orderkey") % 11 == 0, "").otherwise("]}")
    landed = lines.select("l_orderkey", F.concat(F.lit('{"data":['), "all", cut).alias("body"))
    d = payloads.payload_elements(landed, "body", "data", FIELDS, ["l_orderkey"])
    return d.select("l_orderkey", "line", "quantity", "unknown", "reject")


PAYLOAD_SQL = """
      WITH l AS (
        SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INT) AS q, l_returnflag,
               CASE WHEN l_quantity = 50 THEN 'wrong type' WHEN l_linenumber = 7 THEN 'no object' END AS reject
        FROM lineitem WHERE l_orderkey % 11 <> 0)
      SELECT l_orderkey, CASE WHEN reject IS NULL THEN l_linenumber END AS line,
             CASE WHEN reject IS NULL THEN q END AS quantity,
             CASE WHEN reject IS NULL THEN '{"flag":"' || l_returnflag || '"}' END AS unknown, reject
      FROM l
      UNION ALL
      SELECT DISTINCT l_orderkey, CAST(NULL AS INT), CAST(NULL AS INT), NULL, 'broken payload'
      FROM lineitem WHERE l_orderkey % 11 = 0"""


# ---- tables in buckets

def assembled_bucketed(spark, sf, buckets=8):
    """Feature tables stored by row id and joined without moving a row."""
    root = run_folder(spark, "bucketed")
    lines = lineitem(spark, sf).withColumnRenamed("l_orderkey", "o_orderkey")
    parts = {
        "base": orders(spark, sf).select("o_orderkey", "o_custkey"),
        "counts": lines.groupBy("o_orderkey").agg(F.count("*").alias("n_lines")),
        "returned": lines.where("l_returnflag = 'R'").groupBy("o_orderkey").agg(F.count("*").alias("n_returned")),
        "spend": lines.groupBy("o_orderkey").agg(F.round(F.sum("l_quantity"), 2).alias("quantity")),
    }
    stored, tag = {}, root.rsplit("-", 1)[1]
    for name, part in parts.items():
        title = f"staging_{name}_{tag}"
        sinks.save_table(part, title, ["o_orderkey"], buckets, f"{root}/{name}")
        stored[name] = spark.table(title)
    # what was read stays bound to its files
    sinks.drop_staging(spark, [f"staging_{name}_{tag}" for name in parts], "staging_")
    return j.assemble_bucketed(stored["base"], ["o_orderkey"], [
        (stored["counts"], "left"), (stored["returned"], "left"), (stored["spend"], "left")])


BUCKETED_SQL = """
      SELECT o_orderkey, o_custkey, nullif(count(l_orderkey), 0) AS n_lines,
             nullif(count(*) FILTER (l_returnflag = 'R'), 0) AS n_returned,
             round(sum(l_quantity), 2) AS quantity
      FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_custkey"""


# ---- streams of scores and labels

STEPS = ["1000-01-01", "1997-01-01", "1999-06-01", "9000-01-01"]
LAG = "INTERVAL 30 DAYS"


def landed_in_steps(spark, root, frames):
    """Write the rows of each step of time to the folder of their stream, then hand over."""
    for lo, hi in zip(STEPS, STEPS[1:]):
        for name, (df, t) in frames.items():
            df.where((F.col(t) >= lo) & (F.col(t) < hi)).write.mode("append").parquet(f"{root}/{name}")
        yield


def monitor_stream(spark, sf):
    """The report of `monitor_join` from two streams: scores by order date, labels a month later."""
    root = run_folder(spark, "monitor-stream")
    best = scored(spark, sf).groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("score").alias("score"))
    o = orders(spark, sf)
    log = best.join(o, "o_orderkey").select("o_orderkey", "score", F.col("o_orderdate").alias("logged"))
    labels = o.where("o_orderstatus <> 'P'").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "O", 1).otherwise(0).alias("label"),
        (F.col("o_orderdate") + F.expr(LAG)).alias("known"))
    for _ in landed_in_steps(spark, root, {"log": (log, "logged"), "labels": (labels, "known")}):
        streams = [incremental.read_stream(spark, f"{root}/{n}", d.schema) for n, d in (("log", log), ("labels", labels))]
        both = monitoring.labelled_log(*streams, ["o_orderkey"], "logged", "known", "label",
                                       40 * 86_400, "5 days", "5 days")
        query = (both.writeStream.format("parquet").option("path", f"{root}/out")
                 .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start())
        query.awaitTermination()
    out = spark.read.schema(both.schema).parquet(f"{root}/out").where("label is not null")
    d = ev.classification_report(out, "score", "label", 0.85)
    return d.select("class", *rounded(9, "precision", "recall", "f1"), "support")


MONITOR_SQL = SCORED + """,
      j AS (
        SELECT max(score) >= 0.85 AS yes, CAST(o_orderstatus = 'O' AS INT) AS label
        FROM d JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'P'
        GROUP BY o_orderkey, o_orderstatus)""" + REPORT


def scored_stream(spark, sf):
    """Orders of three steps, each scored with what the feature table held by then, and logged once."""
    root = run_folder(spark, "scored-stream")
    o = orders(spark, sf).select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    features = BucketedTable(spark, f"{root}/features", ["o_custkey"], buckets=8)
    model = fitted_model(cut_lineage(training_set(spark, sf)))

    def fold(stored, delta):
        new = delta.groupBy("o_custkey").agg(F.count("*").alias("n_orders"), F.max("o_orderdate").alias("newest"))
        both = new if stored is None else stored.unionByName(new)
        return both.groupBy("o_custkey").agg(F.sum("n_orders").alias("n_orders"), F.max("newest").alias("newest"))

    def score_batch(rows, known):
        d = rows.withColumns({"n_orders": F.lit(0).cast("long"), "newest": F.lit(None).cast("timestamp")})
        if known is not None:
            d = j.assemble(rows, ["o_custkey"], [(known, "left")]).fillna(0, ["n_orders"])
        d = d.withColumns({"l_quantity": F.col("n_orders").cast("double"), "l_extendedprice": F.col("o_totalprice"),
                           "l_tax": F.lit(0.0), "l_linestatus": F.lit("F"), "o_orderpriority": F.lit("1-URGENT")})
        return score(d, model, [0.5]).drop(*TRAINED_ON)

    for _ in landed_in_steps(spark, root, {"waiting": (o, "o_orderdate")}):
        landed = incremental.read_stream(spark, f"{root}/waiting", o.schema)
        monitoring.score_stream(landed, features, score_batch, f"{root}/log", f"{root}/checkpoint").awaitTermination()
        # the next step sees a new version, which this step's orders made
        last = monitoring.read_log(spark, f"{root}/log")
        newest = last.agg(F.max("batch")).first()[0]
        features.fold(last.where(F.col("batch") == newest).select(*o.columns), fold, "orders", newest)
    d = monitoring.read_log(spark, f"{root}/log")
    decided = (F.col("payout_decision") == F.when(F.col("ml_probability") >= 0.5, "RED").otherwise("GREEN"))
    return d.select("o_orderkey", "o_custkey", "n_orders", *us("newest"), decided.alias("decided"))


SCORED_STREAM_SQL = f"""
      WITH s AS (SELECT *, CASE WHEN o_orderdate < DATE '{STEPS[1]}' THEN 0
                   WHEN o_orderdate < DATE '{STEPS[2]}' THEN 1 ELSE 2 END AS step FROM orders)
      SELECT a.o_orderkey, a.o_custkey, count(b.o_orderkey) AS n_orders,
             epoch_us(max(b.o_orderdate)) AS newest_us, true AS decided
      FROM s a LEFT JOIN s b ON b.o_custkey = a.o_custkey AND b.step < a.step
      GROUP BY a.o_orderkey, a.o_custkey"""


def scoring_rows(spark, sf):
    """Open orders with counters of the customer, stored and fresh, and the number of leads."""
    o = orders(spark, sf)
    count = lambda d: d.groupBy("o_custkey").agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("n_failed"))
    main, live = count(o.where("o_orderdate < '1999-01-01'")), count(o.where("o_orderdate >= '1999-01-01'"))
    leads = lineitem(spark, sf).join(o, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_custkey").agg(
        F.count_distinct("l_partkey").alias("leads"))
    waiting = o.where("o_orderstatus = 'P'").select("o_orderkey", "o_custkey", F.when(
        F.col("o_orderkey") % 2 == 0, "null").otherwise(F.col("o_orderpriority")).alias("priority"))
    d = scoring.scoring_rows(waiting, live, main, "o_custkey", ["n", "n_failed"], (leads, "o_custkey"),
                             ["priority"], {"n": 0, "n_failed": 0, "leads": 0, "priority": "none"})
    return d.select("o_orderkey", "o_custkey", "priority", "n", "n_failed", "leads")


SCORING_SQL = """
      WITH live AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate >= DATE '1999-01-01'),
      c AS (SELECT o_custkey, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS n_failed
            FROM orders WHERE o_custkey IN (SELECT o_custkey FROM live) GROUP BY o_custkey),
      leads AS (SELECT o_custkey, count(DISTINCT l_partkey) AS leads
                FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_custkey)
      SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 2 = 0 THEN 'none' ELSE o_orderpriority END AS priority,
             coalesce(n, 0) AS n, coalesce(n_failed, 0) AS n_failed, coalesce(leads, 0) AS leads
      FROM orders LEFT JOIN c USING (o_custkey) LEFT JOIN leads USING (o_custkey)
      WHERE o_orderstatus = 'P'"""


# ---- files

def csv_lines(spark, sf):
    """Customers written as text with a header and read by a declared schema."""
    path = f"{run_folder(spark, 'csv')}/customers"
    c = table(spark, sf, "customer")
    sinks.write_csv(c, path)
    return tables.read_csv(spark, path, c.schema).select("c_custkey", "c_name", "c_nationkey", *rounded(2, "c_acctbal"))


def appended_merging(spark, sf):
    """Nations appended to regions in one folder: columns that a part lacks are null."""
    path = f"{run_folder(spark, 'merged')}/all"
    sinks.append_merging(table(spark, sf, "region").select("r_regionkey", "r_name"), path)
    sinks.append_merging(table(spark, sf, "nation").select("n_nationkey", "n_name", F.col("n_regionkey").alias("r_regionkey")), path)
    return sinks.read_merged(spark, path).select("r_regionkey", "r_name", "n_nationkey", "n_name")


def logged_runs(spark, sf):
    """Two runs of a log, the first repeated: every run is there once, with its time."""
    path = f"{run_folder(spark, 'log')}/runs"
    e = events(spark, sf)
    for run, kind in (("1", "click"), ("2", "view"), ("1", "click")):
        part = e.where(F.col("event_type") == kind).select("event_id", "event_type")
        sinks.append_log(part, path, run, f"2024-02-0{run} 00:00:00")
    d = spark.read.parquet(path)
    return d.select("event_id", "event_type", F.col("run").cast("int").alias("run"), *us("log_timestamp"))


def snapshot_rows(spark, sf):
    """Events up to the largest id of those seen before a day, each source by its own."""
    e = events(spark, sf)
    seen = e.where("ts < '2024-01-20' AND event_type = 'click'")
    clicks = tables.up_to_largest(e.where("event_type = 'click'"), "event_id", seen)
    views = tables.up_to_largest(e.where("event_type = 'view'"), "event_id", e.limit(0))
    return clicks.unionByName(views).select("event_id", "event_type")


def population(spark, sf):
    """Settled or dear orders of some priorities, without the columns that a later step lacks."""
    d = orders(spark, sf).drop("o_orderpriority_old", "o_orderdate")
    d = d.where(((F.col("o_orderstatus") == "F") | (F.col("o_totalprice") > 300_000)) & ~F.col("o_orderpriority").isin(
        "4-NOT SPECIFIED", "5-LOW")).na.drop(subset=["o_custkey"])
    return d.drop("o_orderpriority")


def recent_events(spark, sf):
    """The last ten days before a given day, and no rows from a table that is missing."""
    e = tables.since_days(events(spark, sf), "ts", "2024-01-25", 10)
    none = tables.table_or_empty(spark, "no_such_table_here", e.schema)
    return e.unionByName(none).select("event_id", *us("ts"))


def repartitioned_versions(spark, sf):
    """A table of two versions in four files each; staging tables are dropped after use."""
    root = run_folder(spark, "versions")
    main = sinks.VersionedTable(spark, f"{root}/main")
    o = orders(spark, sf)
    main.write(o.where("o_orderstatus = 'F'"), files=4)
    main.write(o.where("o_orderstatus <> 'F'").unionByName(main.read()), files=4)
    return main.read().groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.max("o_orderkey").alias("top"))


QUERIES = {
    "payload_elements": (payload_elements, PAYLOAD_SQL),
    "assembled_bucketed": (assembled_bucketed, BUCKETED_SQL),
    "monitor_stream": (monitor_stream, MONITOR_SQL),
    "scored_stream": (scored_stream, SCORED_STREAM_SQL),
    "scoring_rows": (scoring_rows, SCORING_SQL),
    "csv_lines": (csv_lines, "SELECT c_custkey, c_name, c_nationkey, round(c_acctbal, 2) AS c_acctbal FROM customer"),
    "appended_merging": (appended_merging, """
      SELECT r_regionkey, r_name, CAST(NULL AS INT) AS n_nationkey, CAST(NULL AS VARCHAR) AS n_name FROM region
      UNION ALL SELECT n_regionkey, NULL, n_nationkey, n_name FROM nation"""),
    "logged_runs": (logged_runs, """
      SELECT event_id, event_type, CASE event_type WHEN 'click' THEN 1 ELSE 2 END AS run,
             epoch_us(CASE event_type WHEN 'click' THEN TIMESTAMP '2024-02-01' ELSE TIMESTAMP '2024-02-02' END)
               AS log_timestamp_us
      FROM events WHERE event_type IN ('click', 'view')"""),
    "snapshot_rows": (snapshot_rows, """
      SELECT event_id, event_type FROM events WHERE event_type = 'click' AND event_id <= (
        SELECT max(event_id) FROM events WHERE ts < TIMESTAMP '2024-01-20' AND event_type = 'click')"""),
    "population": (population, """
      SELECT * EXCLUDE (o_orderpriority, o_orderdate) FROM orders
      WHERE (o_orderstatus = 'F' OR o_totalprice > 300000)
        AND o_orderpriority NOT IN ('4-NOT SPECIFIED', '5-LOW') AND o_custkey IS NOT NULL"""),
    "recent_events": (recent_events, """
      SELECT event_id, epoch_us(ts) AS ts_us FROM events WHERE ts >= TIMESTAMP '2024-01-15'"""),
    "repartitioned_versions": (repartitioned_versions, """
      SELECT o_orderstatus, count(*) AS n, max(o_orderkey) AS top FROM orders GROUP BY o_orderstatus"""),
}
