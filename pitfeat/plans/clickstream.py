"""Session features of a clickstream, from raw clicks to one row per visitor."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitfeat.checkpoints import cut_lineage
from pitfeat.limits import is_small, limit, not_null, rows_per_key
from pitfeat.operators import history as h
from pitfeat.operators import sessions as s
from pitfeat.operators.profile import exact_quantiles
from pitfeat.operators.segments import sessions_in_ranges
from pitfeat.operators.slices import run_placed


@dataclass(frozen=True)
class Clicks:
    """Roles and rules of a clickstream."""

    visitor: str
    time: str
    tie: list[str]
    anchor: Column
    intent: Column
    success: Column
    flags: dict[str, Column] = field(default_factory=dict)
    rules: DataFrame | None = None
    rule_columns: list[str] = field(default_factory=list)
    gap_s: int = s.SESSION_GAP_S
    #: length of a history that ends with the row itself; None for all strictly before it
    trailing_s: int | None = None


def click_sessions(df: DataFrame, c: Clicks) -> DataFrame:
    """Sessions with bounds and hits, then the sessions and events worth keeping.

    Bounds and hit counts come before the event filter, histories after it.
    """
    d = s.sessionize(df, [c.visitor], c.time, c.gap_s)
    d = s.session_stats(d, [c.visitor], c.time, tie=c.tie)
    d = s.sessions_touching(d, [c.visitor, "session_n"], c.time, c.anchor)
    return d if c.rules is None else s.keep_events(d, c.rules, c.rule_columns)


def session_history(df: DataFrame, by: list[str], t: str, per: str = "event") -> DataFrame:
    """Earlier sessions of the visitor, and mean and median of their measures.

    A session starts at one moment per visitor, so distinct earlier sessions are
    distinct earlier starts. Means and medians weigh a session by its number of
    distinct event times (``per='event'``) or once (``per='session'``).
    """
    start = "session_start"
    d = h.prior_agg(df, by, start, {"number_of_sessions": h.distinct(start)})

    def measures(n, time):
        return {
            "mean_number_of_sessions": h.mean(n),
            "median_number_of_sessions": h.median(n),
            "mean_session_time": h.mean(time),
            "median_session_time": h.median(time),
        }

    if per == "event":
        # of the rows of one session at one time, only one counts; they are alike
        alike = Window.partitionBy(*by, start, t).orderBy(start)
        d = d.withColumn("_once", F.row_number().over(alike) == 1)
        once = [F.when(F.col("_once"), F.col(c)) for c in ("number_of_sessions", "session_time")]
        return h.prior_agg(d, by, start, measures(*once)).drop("_once")
    measures = measures("number_of_sessions", "session_time")
    once = d.select(*by, start, "number_of_sessions", "session_time").distinct()
    past = h.prior_agg(once, by, start, measures).select(*by, start, *measures)
    return d.join(past, [*by, start], "left")


def trailing_session_history(df: DataFrame, by: list[str], t: str, seconds: int) -> DataFrame:
    """Sessions that began within ``seconds`` before this one's start, itself included.

    Means and medians weigh a session by its number of distinct event times.
    """
    start = "session_start"
    d = h.trailing_agg(df, by, start, seconds, {"number_of_sessions": h.distinct(start)})
    alike = Window.partitionBy(*by, start, t).orderBy(start)
    d = d.withColumn("_once", F.row_number().over(alike) == 1)
    n, time = (F.when(F.col("_once"), F.col(c)) for c in ("number_of_sessions", "session_time"))
    return h.trailing_agg(d, by, start, seconds, {
        "mean_number_of_sessions": h.mean(n),
        "median_number_of_sessions": h.median(n),
        "mean_session_time": h.mean(time),
        "median_session_time": h.median(time),
    }).drop("_once")


def trailing_non_anchor(df: DataFrame, by: list[str], t: str, anchor: Column, seconds: int) -> DataFrame:
    """Events outside the anchor categories in [time - seconds, time], and their sessions."""
    return h.trailing_agg(df, by, t, seconds, {
        "number_of_non_anchor_actions": h.count(~anchor),
        "number_of_non_anchor_sessions": h.distinct(F.when(~anchor, F.col("session_n"))),
    })


def non_anchor_history(df: DataFrame, by: list[str], t: str, anchor: Column) -> DataFrame:
    """Earlier events outside the anchor categories, and their sessions."""
    return h.prior_agg(
        df, by, t,
        {
            "number_of_non_anchor_actions": h.count(~anchor),
            "number_of_non_anchor_sessions": h.distinct(F.when(~anchor, F.col("session_n"))),
        },
    )


def click_features(df: DataFrame, c: Clicks) -> DataFrame:
    """All session features of every kept event, over all history before it or a trailing part."""
    return run_placed(df, [c.visitor], c.time, lambda d: _features(d, c))


def _features(df: DataFrame, c: Clicks) -> DataFrame:
    by, session = [c.visitor], [c.visitor, "session_n"]
    d = click_sessions(df, c)
    if c.trailing_s is None:
        d = session_history(d, by, c.time)
    else:
        d = trailing_session_history(d, by, c.time, c.trailing_s)
    zero = ["mean_number_of_sessions", "median_number_of_sessions",
            "mean_session_time", "median_session_time"]
    d = d.na.fill(0, zero)
    d = s.session_facts(d, session, c.time, c.intent, c.success, c.flags)
    d = s.first_session(d, by)
    if c.trailing_s is None:
        d = non_anchor_history(d, by, c.time, c.anchor)
    else:
        d = trailing_non_anchor(d, by, c.time, c.anchor, c.trailing_s)
    return s.after_intent_measures(d, c.time)


def latest_features(df: DataFrame, c: Clicks, slice_rows: int | None = None) -> DataFrame:
    """The newest feature row of each visitor, equal to that of `click_features` over all history.

    No running history is kept for rows that are thrown away. Kept rows are grouped
    by session and moment, moments by session, sessions by visitor; all that a
    visitor's newest row says about earlier rows is a total less the newest part.
    Each step combines before its shuffle. Medians over earlier sessions count
    values, weighed by the moments of a session, so nothing is gathered per visitor.
    """
    if c.trailing_s is not None:
        raise ValueError("the newest row by totals needs the whole history")
    by, session = [c.visitor], [c.visitor, "session_n"]
    ranges = _ranges(df, by, slice_rows)
    if ranges is None:
        kept = run_placed(df, by, c.time, lambda d: click_sessions(d, c))
        # rows without a visitor or time have no newest row
        kept = kept.where(not_null([c.visitor, c.time]))
    else:
        d = sessions_in_ranges(df, by, c.time, c.tie, c.gap_s, ranges)
        touched = d.where(c.anchor).select(*session).distinct()
        kept = d.join(touched, session, "left_semi")
        kept = kept if c.rules is None else s.keep_events(kept, c.rules, c.rule_columns)
    flags = {n: F.max(F.when(x, 1).otherwise(0)) for n, x in c.flags.items()}
    moments = kept.groupBy(*session, c.time).agg(
        F.max_by(F.struct(*kept.columns), F.struct(*c.tie)).alias("_row"),
        F.count_if(~c.anchor).alias("_other"),
        F.max(F.when(c.intent, 1)).alias("_intent"),
        F.max(F.when(c.success, 1)).alias("_success"),
        *[x.alias(n) for n, x in flags.items()],
    )
    last = F.max_by(F.struct("_row", "_other"), c.time)
    sessions = moments.groupBy(*session).agg(
        last.alias("_last"),
        F.count("*").alias("_moments"),
        F.sum("_other").alias("_others"),
        F.min(F.when(F.col("_intent") == 1, F.col(c.time))).alias("first_transaction_time"),
        F.min(F.when(F.col("_success") == 1, F.col(c.time))).alias("transaction_success_time"),
        *[F.max(n).alias(n) for n in c.flags],
    )
    sessions = sessions.select(
        "*", F.col("_last._row.session_start").alias("_start"), F.col("_last._row.session_time").alias("_length"))
    # two steps read the sessions: one row each, far fewer than events
    sessions = cut_lineage(s.number_rows(sessions, by, "_start", [], "_n", slice_rows))
    past = sessions.withColumn("_k", F.col("_n") - 1)
    fields = ["_last", "_moments", "_others", "_k", "_length", "first_transaction_time",
              "transaction_success_time", *c.flags]
    weigh = lambda x: F.sum(F.col("_moments") * F.col(x))
    visitors = past.groupBy(*by).agg(
        F.max_by(F.struct(*fields), "_n").alias("_new"),
        F.min("_start").alias("first_session_start"),
        F.sum("_moments").alias("_m"), weigh("_k").alias("_mk"), weigh("_length").alias("_ml"),
        F.sum("_others").alias("_o"), F.count_if(F.col("_others") > 0).alias("_os"),
    )
    new = lambda x: F.col(f"_new.{x}")
    # others at the newest moment itself, and a session that has none before it, do not count
    now = new("_last._other")
    only_now = ((new("_others") > 0) & (new("_others") == now)).cast("long")
    earlier = F.col("_m") - new("_moments")
    d = visitors.select(
        "_new._last._row.*", "first_session_start", new("_k").cast("long").alias("number_of_sessions"),
        *[F.coalesce(F.try_divide(F.col(a) - new("_moments") * new(b), earlier), F.lit(0.0)).alias(n)
          for n, a, b in (("mean_number_of_sessions", "_mk", "_k"), ("mean_session_time", "_ml", "_length"))],
        *[new(x).alias(x) for x in ("first_transaction_time", "transaction_success_time", *c.flags)],
        (F.col("_o") - now).alias("number_of_non_anchor_actions"),
        (F.col("_os") - only_now).alias("number_of_non_anchor_sessions"),
    )
    top = visitors.select(*by, (new("_k") + 1).alias("_top"))
    older = past.join(top, by).where("_n < _top").select(
        *by, "_moments", F.col("_k").cast("double").alias("median_number_of_sessions"),
        F.col("_length").cast("double").alias("median_session_time"))
    names = ["median_number_of_sessions", "median_session_time"]
    long = older.unpivot([*by, "_moments"], names, "_name", "_value")
    half = exact_quantiles(long, [*by, "_name"], "_value", {"_half": 0.5}, slice_rows, weight="_moments")
    half = half.groupBy(*by).agg(*[F.max(F.when(F.col("_name") == n, F.col("_half"))).alias(n) for n in names])
    d = d.join(half, by, "left").fillna(0.0, names)
    return s.after_intent_measures(d, c.time)


def _ranges(df: DataFrame, by: list[str], slice_rows: int | None) -> int | None:
    """How many ranges the rows need if some visitor has more than a task should hold; else None."""
    spark = df.sparkSession
    if slice_rows is None and is_small(df):
        return None
    rows = slice_rows or limit(spark, "slice.rows")
    total, top = rows_per_key(df, by).agg(F.sum("_n"), F.max("_n")).first()
    if not top or top <= rows:
        return None
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // rows))


def hit_history(df: DataFrame, by: list[str], t: str) -> DataFrame:
    """Earlier sessions, views and devices of a visitor, from analytics hits.

    Means and medians of the session count and of the time on site run over the
    earlier hits. A hit in a session without hits has no share.
    """
    def chain(d):
        d = h.prior_agg(
            d, by, t,
            {
                "number_of_sessions": h.distinct("session_id"),
                "number_of_page_views": h.total("page_views"),
                "number_of_screen_views": h.total("screen_views"),
                "number_of_devices_used": h.distinct("brand"),
            },
        )
        return h.prior_agg(
            d, by, t,
            {
                "mean_number_of_sessions": h.mean("number_of_sessions"),
                "mean_session_time": h.mean("time_on_site"),
                "median_number_of_sessions": h.median("number_of_sessions"),
                "median_session_time": h.median("time_on_site"),
            },
        )

    share = F.try_divide(F.col("hit_number"), F.col("no_hits"))
    return run_placed(df, by, t, chain).withColumn("hit_occurence_wrt_total_hits", share)
