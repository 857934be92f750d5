"""Sessions and deduplication on an unbounded stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_sessions(
    events: DataFrame, by: list[str], t: str, gap_s: int, watermark: str
) -> DataFrame:
    """Session windows per key, emitted when the watermark passes their end.

    The batch operator compares whole seconds and splits only above the gap. Spark
    joins windows that overlap or merely touch, so times are cut to the second and
    the window is one microsecond short of ``gap_s + 1`` seconds: a pause of ``gap_s``
    joins, one of ``gap_s + 1`` splits. Rows later than the watermark are dropped.
    """
    second = F.date_trunc("second", F.col(t)).alias("_second")
    d = events.select("*", second).withWatermark("_second", watermark)
    window = F.session_window("_second", f"{gap_s} seconds 999999 microseconds")
    return (
        d.groupBy(*by, window)
        .agg(
            F.min(t).alias("session_start"),
            F.max(t).alias("session_end"),
            F.count("*").alias("number_of_hits"),
        )
        .drop("session_window")
    )


def stream_dedup(events: DataFrame, keys: list[str], t: str, watermark: str) -> DataFrame:
    """Drop repeats of a key that arrive within the watermark of each other."""
    return events.withWatermark(t, watermark).dropDuplicatesWithinWatermark(keys)


def run_to_table(stream: DataFrame, path: str, checkpoint: str):
    """Process what is there, append it to Parquet files, and stop."""
    query = (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
