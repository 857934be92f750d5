"""Training tables: features joined as of the click, labels spread, classes balanced."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from pitfeat.operators.asof import asof_join
from pitfeat.operators.labels import propagate_two_hop
from pitfeat.operators.sampling import undersample


def training_rows(
    features: DataFrame,
    clicks: DataFrame,
    intent: Column,
    visitor: str,
    t_features: str,
    t_clicks: str,
    person: str,
    label: str,
    tie: list[str],
    tolerance_s: float = 60,
    prefix: str = "",
) -> DataFrame:
    """Each transaction with the last intent click before it, and the spread label."""
    joined = asof_join(
        features, clicks.where(intent), [visitor], t_features, t_clicks,
        tolerance_s, tie, prefix,
    )
    return propagate_two_hop(joined, person, visitor, label)


def balanced(
    df: DataFrame, label: str, required: list[str], ratio: float = 4, seed: int = 42,
    key: list[str] | None = None,
) -> DataFrame:
    """Rows with the required columns, the other class cut to ``ratio`` per labelled row."""
    return undersample(df.na.drop(subset=required), label, ratio, seed, key)
