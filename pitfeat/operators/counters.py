"""Folding fresh features into stored ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitfeat.operators.joins import update_side
from pitfeat.operators.reduce import latest_per_key


def merge_counters(
    main: DataFrame, delta: DataFrame, by: list[str], additive: list[str]
) -> DataFrame:
    """Delta rows with the stored counters of their key added; a missing side counts as 0.

    Both inputs have at most one row per key. All other columns come from the
    delta.
    """
    old = main.select(*by, *additive)
    d = update_side(old, delta, by, "_main_")
    sums = {
        c: F.coalesce(F.col(f"_main_{c}"), F.lit(0)) + F.coalesce(F.col(c), F.lit(0))
        for c in additive
    }
    return d.withColumns(sums).select(*delta.columns)


def fold_latest(
    main: DataFrame, delta: DataFrame, by: list[str], t: str, tie: list[str],
    additive: list[str],
) -> DataFrame:
    """The main table after the delta: merged rows for its keys, old rows for the rest."""
    merged = merge_counters(main, delta, by, additive)
    # the merged row is never older than the stored one it came from
    both = main.withColumn("_new", F.lit(0)).unionByName(
        merged.select(*main.columns).withColumn("_new", F.lit(1))
    )
    return latest_per_key(both, by, t, ["_new", *tie]).drop("_new")
