"""Sizes at which an operator changes strategy.

Every limit is read from the session conf, so a cluster can tune it and a test
can lower it to force the large-data path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULTS = {
    # rows of one key that one task may hold before the key is cut into slices
    "spark.pitfeat.slice.rows": 4_000_000,
    # rows that one task sorts where the number of rows is known
    "spark.pitfeat.task.rows": 1_000_000,
    # most slices one plan may use; also bounds the hot-key table that is broadcast
    "spark.pitfeat.slice.max": 16_384,
    # inputs estimated below this are never measured: they fit one task whole
    "spark.pitfeat.small.bytes": 128 * 1024 * 1024,
    # rows per key up to which a frame that costs rows x rows may be used
    "spark.pitfeat.frame.rows": 4_096,
    # input up to which a group's distinct values may be held in one buffer
    "spark.pitfeat.percentile.bytes": 4 * 1024 * 1024,
    # largest side that is broadcast by request, in rows and in bytes of their values
    "spark.pitfeat.broadcast.rows": 1_000_000,
    "spark.pitfeat.broadcast.bytes": 64 * 1024 * 1024,
}


def limit(spark: SparkSession, name: str) -> int:
    key = f"spark.pitfeat.{name}"
    return int(spark.conf.get(key, str(DEFAULTS[key])))


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan; it errs upwards for joins."""
    plan = df._jdf.queryExecution().optimizedPlan()
    return int(plan.stats().sizeInBytes())


def is_small(df: DataFrame) -> bool:
    return estimated_bytes(df) <= limit(df.sparkSession, "small.bytes")


def rows_per_key(df: DataFrame, by: list[str]) -> DataFrame:
    """Row count per key, combined map-side before the shuffle; null keys left out."""
    return df.where(not_null(by)).groupBy(*by).agg(F.count("*").alias("_n"))


def largest_key(df: DataFrame, by: list[str]) -> int:
    """Rows of the most frequent key (one small job)."""
    return rows_per_key(df, by).agg(F.max("_n")).first()[0] or 0


def dealt(df: DataFrame, by: list[str], rows: int | None) -> DataFrame:
    """Rows placed by key; of a known number, in as many tasks as keep each of them small.

    Left to itself, adaptive execution joins partitions up to a size as compressed, which
    says little about the memory that sorting them takes, and never makes more of them than
    the session's number of shuffle partitions.
    """
    tasks = -(-rows // limit(df.sparkSession, "task.rows")) if rows else 0
    return df.repartition(tasks, *by) if tasks > 1 else df.repartition(*by)


def broadcast_checked(df: DataFrame) -> DataFrame:
    """Ask for a broadcast only after measuring that the rows are few and short.

    Measuring stops one row beyond the limit. A larger side is left to Catalyst,
    which shuffles it.
    """
    spark = df.sparkSession
    most = limit(spark, "broadcast.rows")
    size = F.coalesce(F.sum(_bytes(df)), F.lit(0))
    rows, held = df.limit(most + 1).agg(F.count("*"), size).first()
    return F.broadcast(df) if rows <= most and held <= limit(spark, "broadcast.bytes") else df


def _bytes(df: DataFrame) -> Column:
    """About the size of a row: texts by their length, nested values by that of their text."""
    total = F.lit(0)
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(f.name), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(f.name))), F.lit(0))
        else:
            total = total + 8
    return total


def not_null(cols: list[str]) -> Column:
    ok = F.lit(True)
    for c in cols:
        ok = ok & F.col(c).isNotNull()
    return ok


def any_null(cols: list[str]) -> Column:
    bad = F.lit(False)
    for c in cols:
        bad = bad | F.col(c).isNull()
    return bad
