"""Fewer rows: latest per key, deduplication, distinct rows, high-water mark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitfeat.limits import not_null
from pitfeat.operators.slices import place_of, placed


def latest_per_key(df: DataFrame, by: list[str], t: str, tie: list[str]) -> DataFrame:
    """The row with the largest time per key; ties go to the largest ``tie``.

    Rows with a null key or time are nobody's latest and are left out.
    """
    known = df.where(not_null([*by, t]))
    return dedup(known, placed(known, by, t)[1] if place_of(known, by) else by,
                 [F.desc(c) for c in (t, *tie)])


def dedup(df: DataFrame, by: list[str], order: list[Column | str]) -> DataFrame:
    """The first row per key in the given order.

    The filter on the row number lets Spark keep one row per key in each map
    task before the shuffle, so copies of one key do not travel.
    """
    place = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(place)).where("_rn = 1").drop("_rn")


def dedup_ignoring(df: DataFrame, ignore: list[str], order: list[Column | str]) -> DataFrame:
    """Deduplicate on all columns but these."""
    return dedup(df, [c for c in df.columns if c not in ignore], order)


def dedup_last(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Keep the last row per key in the given order."""
    return dedup(df, by, [F.desc(c) for c in order])


def high_water_mark(df: DataFrame, t: str) -> DataFrame:
    """One row with the largest time, null for an empty table."""
    return df.agg(F.max(t).alias("max_timestamp"))


def time_bounds(df: DataFrame, by: list[str], t: str, amount: str) -> DataFrame:
    """Per key: first and last time, row count, summed amount, rows with an amount."""
    return df.groupBy(*by).agg(
        F.min(t).alias("first_time"),
        F.max(t).alias("last_time"),
        F.count("*").alias("n_rows"),
        F.sum(amount).alias("total_amount"),
    )


def distinct_counts(
    df: DataFrame, by: list[str], columns: dict[str, str | Column], approximate: bool = False
) -> DataFrame:
    """Distinct values per key; a conditional count passes ``when(condition, column)``."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.groupBy(*by).agg(
        *[count(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in columns.items()]
    )


def leads_per_entity(
    leads: DataFrame, details: DataFrame, lead_key: str, detail_key: str,
    entity: str, lead_id: str, only: DataFrame | None = None,
) -> DataFrame:
    """Distinct leads per entity, optionally for the entities of another table."""
    if only is not None:
        details = details.join(only.select(entity).distinct(), entity, "left_semi")
    d = leads.join(details, F.col(lead_key) == F.col(detail_key))
    return d.groupBy(entity).agg(F.count_distinct(lead_id).alias("number_of_leads"))


def leads_through(
    leads: DataFrame, steps: list[tuple[DataFrame, str, str, str]], entity: str, lead_id: str
) -> DataFrame:
    """Distinct leads per entity over a chain of tables: (table, key so far, its key, how).

    After a left step leads that found nobody count for the entity null.
    """
    d = leads
    for table, ours, theirs, how in steps:
        d = d.join(table, F.col(ours) == F.col(theirs), how)
    return d.groupBy(entity).agg(F.count_distinct(lead_id).alias("number_of_leads"))


def top_k(df: DataFrame, k: int, order: list[Column]) -> DataFrame:
    """The k first rows of an order; Spark keeps k rows per task on the way."""
    return df.orderBy(*order).limit(k)
