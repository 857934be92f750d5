"""Sessions of an event stream: ids, bounds, hits, and facts shared by a session."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitfeat.limits import broadcast_checked, largest_key, not_null
from pitfeat.operators.slices import (
    Slices,
    group_transform,
    max_of,
    place_of,
    placed,
    plan_slices,
    running,
    settled,
    slices_for,
    steps_of,
    tied,
    timed,
)

SESSION_GAP_S = 1800


def sessionize(
    df: DataFrame,
    by: list[str],
    t: str,
    gap_s: int = SESSION_GAP_S,
    number: str = "session_n",
    session_id: str | None = "session_id",
    slice_rows: int | None = None,
) -> DataFrame:
    """Number the sessions of each key from 0; a pause above ``gap_s`` starts one.

    Pauses are differences of whole seconds, so 1800.9 s does not exceed 1800.
    Equal times belong to the same session. Rows with a null key or time get no
    session.
    """
    ok = not_null([*by, t])
    d, keys, helpers = placed(settled(df, by), by, t)
    d, o, extra = timed(d, by, t)
    slices = slices_for(d, by, o, slice_rows)
    second = F.unix_seconds(t)
    if slices is None:
        w = Window.partitionBy(*keys).orderBy(o)
        pause = second - F.lag(second).over(w)
        d = d.withColumn("_new", F.coalesce((pause > gap_s).cast("long"), F.lit(0)))
        d = d.withColumn(number, F.when(ok, F.sum("_new").over(w)))
    else:
        d = running(d, by, o, {"_prev": max_of(F.col(o))}, slices)
        pause = second - F.floor(F.col("_prev") / 1_000_000)
        d = d.withColumn("_new", F.coalesce(pause > gap_s, F.lit(False)))
        d = running(
            d, by, o, {number: steps_of(F.col("_new"), o)}, slices, inclusive=True
        ).withColumn(number, F.when(ok, F.col(number)))
    d = d.select(*df.columns, number)
    if session_id:
        d = d.withColumn(
            session_id, F.when(ok, F.concat_ws("_", *by, F.col(number).cast("string")))
        )
    return d


def session_stats(
    df: DataFrame,
    by: list[str],
    t: str,
    number: str = "session_n",
    tie: list[str] | None = None,
    slice_rows: int | None = None,
) -> DataFrame:
    """Add session start, end, length in seconds, hit count and hit number."""
    session = [*by, number]
    hot = None if slice_rows is None else largest_key(df, session) > slice_rows
    d = session_transform(
        df,
        session,
        t,
        {
            "session_start": F.min(t),
            "session_end": F.max(t),
            "number_of_hits": F.count("*"),
        },
        hot,
    )
    d = d.withColumn(
        "session_time", F.unix_seconds("session_end") - F.unix_seconds("session_start")
    )
    return number_rows(d, session, t, tie or [], "hit_number", slice_rows)


def session_transform(
    df: DataFrame, session: list[str], t: str, aggs: dict[str, Column], hot: bool | None = None
) -> DataFrame:
    """Put per-session aggregates on each row.

    After `place` on the session's key columns the rows already lie where the
    window needs them, so no shuffle is added.
    """
    return group_transform(df, session, aggs, t, hot)


def number_rows(
    df: DataFrame,
    by: list[str],
    t: str,
    tie: list[str],
    name: str,
    slice_rows: int | None = None,
) -> DataFrame:
    """Row number per key in time order, ties settled by ``tie``."""
    ok = not_null(by)
    d, keys, helpers = placed(settled(df, by), by, t)
    d, o, extra = timed(d, by, t)
    known = place_of(df, by)
    if known and slice_rows is None:
        # cut points of the leading key columns cut every group of the full key
        slices = known[1].slices
    else:
        slices = plan_slices(d, by, o, slice_rows)
    if slices is None:
        w = Window.partitionBy(*keys).orderBy(o, *tie)
        return d.withColumn(name, F.when(ok, F.row_number().over(w))).drop(
            *helpers, *extra
        )
    # cut points that serve the leading key columns may not know this key's ties
    d, at, slices = tied(d, slices.by, o, tie, slices, slice_rows)
    d = slices.assign(d, at)
    here = Window.partitionBy(*keys, "_slice").orderBy(o, *tie)
    sizes = d.where("_hot").groupBy(*by, "_slice").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*by).orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # only a group that began in an earlier slice needs a carry: few rows remain
    carry = sizes.select(*by, "_slice", F.sum("_n").over(before).alias("_before"))
    carry = carry.where("_before is not null")
    d = d.withColumn("_here", F.row_number().over(here))
    d = d.join(F.broadcast(carry), [*by, "_slice"], "left")
    rank = F.col("_here") + F.coalesce("_before", F.lit(0))
    d = d.withColumn(name, F.when(ok, rank.cast("int")))
    return d.select(*df.columns, name)


def session_facts(
    df: DataFrame, session: list[str], t: str, intent: Column, success: Column,
    flags: dict[str, Column],
) -> DataFrame:
    """Add first intent time, first success time and 0/1 flags of the session at once."""
    return session_transform(
        df,
        session,
        t,
        {
            "first_transaction_time": F.min(F.when(intent, F.col(t))),
            "transaction_success_time": F.min(F.when(success, F.col(t))),
            **{n: F.max(F.when(c, 1).otherwise(0)) for n, c in flags.items()},
        },
    )


def intent_and_success(
    df: DataFrame, session: list[str], t: str, intent: Column, success: Column
) -> DataFrame:
    """Add the session's first intent time and first success time."""
    return session_facts(df, session, t, intent, success, {})


def session_flags(
    df: DataFrame, session: list[str], t: str, flags: dict[str, Column]
) -> DataFrame:
    """Add a 0/1 column per flag: did any row of the session satisfy it?"""
    return session_transform(
        df, session, t, {n: F.max(F.when(c, 1).otherwise(0)) for n, c in flags.items()}
    )


def first_session(df: DataFrame, by: list[str], start: str = "session_start") -> DataFrame:
    """Add the start of the key's first session."""
    return group_transform(df, by, {"first_session_start": F.min(start)}, start)


def after_intent_measures(df: DataFrame, t: str) -> DataFrame:
    """Seconds since the first session, seconds and hits after intent, gateway seconds."""

    def seconds(a: str, b: str) -> Column:
        return F.unix_seconds(a) - F.unix_seconds(b)

    return df.withColumns(
        {
            "seconds_since_first_session": seconds(t, "first_session_start"),
            "seconds_after_transaction": seconds("session_end", "first_transaction_time"),
            "hits_after_transaction": F.col("number_of_hits") - F.col("hit_number"),
            "seconds_on_payment_gateway": seconds(
                "transaction_success_time", "first_transaction_time"
            ),
        }
    )


def keep_events(df: DataFrame, rules: DataFrame, on: list[str]) -> DataFrame:
    """Keep rows whose (category, action) pair is in the rules table.

    Categories are few and very uneven, so shuffling events by them would end in
    a handful of tasks: the rules, a short list, travel instead.
    """
    return semi_join(df, rules, on)


def sessions_touching(
    df: DataFrame, session: list[str], t: str, predicate: Column
) -> DataFrame:
    """Keep all rows of sessions in which some row satisfies the predicate."""
    d = session_transform(df, session, t, {"_touch": F.max(F.when(predicate, 1))})
    return d.where(F.col("_touch") == 1).drop("_touch")


def semi_join(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is in ``keys``; a short key list is broadcast after counting it."""
    wanted = keys.select(*on).distinct()
    return df.join(broadcast_checked(wanted), on, "left_semi").select(*df.columns)
