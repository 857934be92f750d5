"""Keeping session and feature tables current in increments."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitfeat.checkpoints import cut_lineage
from pitfeat.operators.asof import asof_join
from pitfeat.operators.reduce import high_water_mark
from pitfeat.operators.sessions import sessionize
from pitfeat.operators.slices import max_of, running, slices_for, steps_of
from pitfeat.sources.buckets import BucketedTable
from pitfeat.sources.sinks import VersionedTable


def stored_mark(df: DataFrame | None, t: str) -> datetime | None:
    """Largest stored time; None when there is no table or no row yet."""
    return None if df is None else high_water_mark(df, t).first()[0]


def rows_after(df: DataFrame, t: str, mark: datetime | None) -> DataFrame:
    """Rows newer than the mark; everything when there is no mark."""
    return df if mark is None else df.where(F.col(t) > F.lit(mark))


def session_table(df: DataFrame, by: list[str], t: str, gap_s: int) -> DataFrame:
    """One row per session: start, end, hits."""
    d = sessionize(df, by, t, gap_s, session_id=None).where(F.col("session_n").isNotNull())
    return d.groupBy(*by, "session_n").agg(
        F.min(t).alias("session_start"),
        F.max(t).alias("session_end"),
        F.count("*").alias("number_of_hits"),
    ).drop("session_n")


def refresh_sessions(
    events: DataFrame,
    sessions: DataFrame,
    by: list[str],
    t: str,
    gap_s: int,
    mark: datetime | None,
) -> DataFrame:
    """Session table after new events, equal to one run over all events if none came late.

    New rows are those above the mark, so a row that arrives later than the mark
    is seen only if its session is still open; `refresh_with_late_rows` takes all.
    A session still open at the mark may go on in the new rows. All its rows are
    read again from its start, so it is neither split nor counted twice. Reading
    goes back no further than the earliest such start.
    """
    if mark is None:
        return session_table(events, by, t, gap_s)
    idle = F.unix_seconds(F.lit(mark)) - F.unix_seconds("session_end")
    still_open = sessions.where(idle <= gap_s)
    oldest = still_open.agg(F.min("session_start")).first()[0]
    fresh = rows_after(events, t, mark)
    if oldest is not None:
        starts = still_open.select(*by, F.col("session_start").alias("_from"))
        again = events.where((F.col(t) <= F.lit(mark)) & (F.col(t) >= F.lit(oldest)))
        again = again.join(starts, by).where(F.col(t) >= F.col("_from")).drop("_from")
        fresh = fresh.unionByName(again)
    kept = sessions.where(~(idle <= gap_s))
    return kept.unionByName(session_table(fresh, by, t, gap_s).select(*kept.columns))


def merge_sessions(
    sessions: DataFrame, fresh: DataFrame, by: list[str], gap_s: int, slice_rows: int | None = None
) -> DataFrame:
    """Sessions of the keys of ``fresh``, which is a session table of new rows of any age.

    Within a session no pause exceeds the gap, so sessions are closed intervals,
    and new rows can only join them: intervals at most the gap apart become one.
    ``reopened`` marks sessions with new rows; all others are as they were.
    """
    keys = fresh.select(*by).distinct()
    old = sessions.join(keys, by, "left_semi").withColumn("reopened", F.lit(False))
    both = old.unionByName(fresh.withColumn("reopened", F.lit(True)))
    d = both.withColumns({"_o": F.unix_micros("session_start"), "_last": F.unix_seconds("session_end")})
    slices = slices_for(d, by, "_o", slice_rows)
    if slices is not None:
        d = cut_lineage(d)
    d = running(d, by, "_o", {"_reach": max_of(F.col("_last"))}, slices)
    pause = F.unix_seconds("session_start") - F.col("_reach")
    d = d.withColumn("_apart", F.coalesce(pause > gap_s, F.lit(False)))
    d = running(d, by, "_o", {"_n": steps_of(F.col("_apart"), "_o")}, slices, inclusive=True)
    return d.groupBy(*by, "_n").agg(
        F.min("session_start").alias("session_start"),
        F.max("session_end").alias("session_end"),
        F.sum("number_of_hits").alias("number_of_hits"),
        F.max("reopened").alias("reopened"),
    ).drop("_n")


def refresh_with_late_rows(
    sessions: DataFrame, delta: DataFrame, by: list[str], t: str, gap_s: int, slice_rows: int | None = None
) -> DataFrame:
    """Session table after the rows that arrived since the last run, equal to one run over all rows.

    ``delta`` holds rows by time of arrival, however old they are: a row may open a
    session before all others, lengthen a closed one, or join two. No old row is
    read. Sessions of keys without new rows are taken over.
    """
    fresh = session_table(delta, by, t, gap_s)
    kept = sessions.join(fresh.select(*by).distinct(), by, "left_anti")
    merged = merge_sessions(sessions, fresh, by, gap_s, slice_rows).drop("reopened")
    return kept.unionByName(merged.select(*kept.columns))


def rows_of_sessions(
    events: DataFrame, sessions: DataFrame, by: list[str], t: str, slice_rows: int | None = None
) -> DataFrame:
    """The rows of some sessions, such as reopened ones whose features are to be computed again.

    Sessions of a key do not overlap, so only the last one that began before a row
    can hold it: one time line of rows and starts, no pairs.
    """
    starts = sessions.select(*by, "session_start", F.col("session_end").alias("_until"))
    wanted = starts.select(*by).distinct()
    mine = events.join(wanted, by, "left_semi")
    found = asof_join(
        mine, starts, by, t, "session_start", tie=["_until"], prefix="_of", slice_rows=slice_rows)
    return found.where(F.col(t) <= F.col("_of_until")).select(*events.columns)


def run_increment(
    table: VersionedTable,
    delta: DataFrame,
    fold: Callable[[DataFrame | None, DataFrame], DataFrame],
    batch: int,
    query: str = "",
) -> bool:
    """Fold one batch into the table exactly once; False if it was folded before.

    Each version carries the last batch of every query that was folded into it,
    so a repeated batch does nothing, one that failed half-way is written again,
    and a query with a checkpoint of its own starts from its own first batch.
    """
    folded = table.marks()
    if folded.get(query, -1) >= batch:
        return False
    table.write(fold(table.read(), delta), marks=folded | {query: batch})
    return True


def fold_stream(
    stream: DataFrame,
    table: VersionedTable | BucketedTable,
    fold: Callable[[DataFrame | None, DataFrame], DataFrame],
    checkpoint: str,
):
    """Start a query that folds each micro-batch of new rows into the table.

    The query is known by the id that Spark keeps in its checkpoint. A bucketed
    table has only the buckets rewritten that the batch touches.
    """

    def each(batch_df: DataFrame, batch_id: int) -> None:
        query = table.spark.read.text(f"{checkpoint}/metadata").first()[0]
        if isinstance(table, BucketedTable):
            table.fold(batch_df, fold, query, batch_id)
        else:
            run_increment(table, batch_df, fold, batch_id, query)

    return (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_stream(spark: SparkSession, folder: str, schema, pattern: str | None = None) -> DataFrame:
    """Stream of the Parquet files that land in a folder."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(folder)
