"""Rows of many keys in ranges of (key, time, tie), whatever the size of a key.

A range is one partition of Spark's own range exchange, so it holds about as many
rows as any other: a key with more of them spans several ranges, and so does a time
stamp, as the tie columns cut it too. The number of its range is written with each
row, together with what a window inside the range tells. What came before a range is
a carry, from a table with a row for each range of a key, of which only keys with
several ranges matter: at most two rows a range, whatever the input. One exchange by
range and one write serve all that a plan asks about the order of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitfeat.checkpoints import cut_lineage
from pitfeat.limits import not_null

MICROS = 1_000_000


def in_ranges(df: DataFrame, by: list[str], t: str, tie: list[str], ranges: int) -> DataFrame:
    """Rows with a key and a time, with ``_o`` (microseconds) and the number ``_range`` of their range.

    The number is only good for one run of the plan, so the frame is to be written
    before anything else is asked of it.
    """
    d = df.where(not_null([*by, t])).withColumn("_o", F.unix_micros(t))
    return d.repartitionByRange(ranges, *by, "_o", *tie).withColumn("_range", F.spark_partition_id())


def sessions_in_ranges(
    df: DataFrame, by: list[str], t: str, tie: list[str], gap_s: int, ranges: int,
) -> DataFrame:
    """Rows with a key and a time, with the columns of `sessionize` and `session_stats`.

    The same results: sessions from 0 by pauses of whole seconds, bounds, hits, and the
    number of each hit by (time, tie).
    """
    second = F.floor(F.col("_o") / MICROS)
    here = Window.partitionBy(*by, "_range").orderBy("_o", *tie)
    so_far = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = in_ranges(df, by, t, tie, ranges)
    # the first row of a range knows no row before it: the carry decides whether it starts a session
    d = d.withColumns({"_row": F.row_number().over(here), "_new": second - F.lag(second).over(here) > gap_s})
    d = d.withColumns({
        "_news": F.sum(F.coalesce(F.col("_new").cast("long"), F.lit(0))).over(so_far),
        "_began": F.max(F.when(F.col("_new"), F.col("_row"))).over(so_far),
    })
    d = cut_lineage(d.drop("_new"))
    carry = _carry(d, by, gap_s)
    d = d.join(F.broadcast(carry), [*by, "_range"], "left")
    row = F.coalesce("_rows_before", F.lit(0)) + F.col("_row")
    began = F.coalesce(F.coalesce("_rows_before", F.lit(0)) + F.col("_began"), F.col("_open"), F.lit(1))
    d = d.withColumns({
        "session_n": F.coalesce("_first_n", F.lit(0)) + F.col("_news"),
        "hit_number": (row - began + 1).cast("int"),
    }).select(*df.columns, "session_n", "hit_number")
    session = [*by, "session_n"]
    bounds = d.groupBy(*session).agg(
        F.min(t).alias("session_start"), F.max(t).alias("session_end"), F.count("*").alias("number_of_hits"))
    d = d.join(bounds, session)
    return d.select(
        *df.columns, "session_n", F.concat_ws("_", *by, F.col("session_n").cast("string")).alias("session_id"),
        "session_start", "session_end", "number_of_hits",
        (F.unix_seconds("session_end") - F.unix_seconds("session_start")).alias("session_time"), "hit_number")


def _carry(d: DataFrame, by: list[str], gap_s: int) -> DataFrame:
    """For ranges of keys with several: rows before, session of the first row, and where that began."""
    parts = d.groupBy(*by, "_range").agg(
        F.min("_o").alias("_lo"), F.max("_o").alias("_hi"), F.count("*").alias("_n"),
        F.max("_news").alias("_more"), F.max("_began").alias("_last"))
    line = Window.partitionBy(*by).orderBy("_range")
    earlier = line.rowsBetween(Window.unboundedPreceding, -1)
    pause = F.floor(F.col("_lo") / MICROS) - F.floor(F.lag("_hi").over(line) / MICROS)
    parts = parts.withColumns({
        "_several": F.count("*").over(Window.partitionBy(*by)) > 1,
        "_begins": pause > gap_s,  # null for the first range of a key
        "_rows_before": F.coalesce(F.sum("_n").over(earlier), F.lit(0)),
    }).where("_several")
    begins = F.coalesce("_begins", F.lit(False)).cast("long")
    # the row, counted in the key, at which the session of a range's last row began, if in this range
    start = F.when(F.coalesce("_begins", F.lit(True)), F.col("_rows_before") + 1)
    parts = parts.withColumn("_start", start)
    last = F.coalesce(F.col("_rows_before") + F.col("_last"), F.col("_start"))
    return parts.withColumn("_at_end", last).select(
        *by, "_range", "_rows_before",
        (F.coalesce(F.sum(F.col("_more") + begins).over(earlier), F.lit(0)) + begins).alias("_first_n"),
        F.coalesce("_start", F.last("_at_end", ignorenulls=True).over(earlier)).alias("_open"))
