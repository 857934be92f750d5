"""Scores on a stream: logged as they are given, judged when labels arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitfeat.sources.buckets import BucketedTable
from pitfeat.sources.sinks import VersionedTable


def labelled_log(
    log: DataFrame, labels: DataFrame, on: list[str], t_log: str, t_label: str, label: str,
    wait_s: int, log_watermark: str, label_watermark: str,
) -> DataFrame:
    """Logged rows with the label that arrives within ``wait_s`` of them, on two streams.

    A row is given out with its label as soon as both are there. A row without a label
    comes out, with nulls, once both watermarks tell that none can come any more: until
    then it is kept, and the state is bounded by the wait and the watermarks. A label
    of the same time as its row, or exactly ``wait_s`` later, counts. Rows later than
    their stream's watermark are dropped.
    """
    left = log.withWatermark(t_log, log_watermark)
    right = labels.select(
        *[F.col(c).alias(f"_{c}") for c in on], F.col(t_label).alias("_label_time"), F.col(label)
    ).withWatermark("_label_time", label_watermark)
    match = (F.col("_label_time") >= F.col(t_log)) & (
        F.col("_label_time") <= F.col(t_log) + F.expr(f"INTERVAL {int(wait_s)} SECONDS"))
    for c in on:
        match = match & (F.col(c) == F.col(f"_{c}"))
    return left.join(right, match, "leftOuter").drop(*[f"_{c}" for c in on])


def score_stream(
    waiting: DataFrame,
    features: VersionedTable | BucketedTable,
    score: Callable[[DataFrame, DataFrame | None], DataFrame],
    log: str,
    checkpoint: str,
):
    """Start a query that scores what arrives with the features known by then.

    ``score(rows, features)`` gets each micro-batch and the newest version of the
    feature table, which other jobs keep current: a plain join with a static frame
    would keep on reading the version of the start. A batch owns a folder of the log,
    named by query and batch, and overwrites only that, so a batch that is repeated
    after a failure is in the log once. `read_log` reads it.
    """

    def each(rows: DataFrame, batch: int) -> None:
        query = features.spark.read.text(f"{checkpoint}/metadata").first()[0]
        name = query.split('"')[3]
        scored = score(rows, features.read())
        scored.write.mode("overwrite").parquet(f"{log.rstrip('/')}/query={name}/batch={batch}")

    return (
        waiting.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_log(spark: SparkSession, log: str) -> DataFrame:
    """All logged rows with the query and batch that scored them."""
    return spark.read.option("basePath", log).parquet(f"{log.rstrip('/')}/query=*/batch=*")
