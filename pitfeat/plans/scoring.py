"""Scoring waiting transactions with stored and fresh features."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from pitfeat.functions.columns import cast_all, fill, literal_null
from pitfeat.operators.counters import merge_counters
from pitfeat.operators.joins import assemble
from pitfeat.operators.model import score


def scoring_rows(
    waiting: DataFrame,
    live: DataFrame,
    main: DataFrame,
    visitor: str,
    additive: list[str],
    leads: tuple[DataFrame, str] | None = None,
    null_text: list[str] | None = None,
    defaults: dict[str, object] | None = None,
) -> DataFrame:
    """Waiting transactions with merged visitor features and lead counts.

    ``main`` is cut to the visitors that wait before it is merged.
    """
    wanted = live.select(visitor).distinct()
    stored = main.join(wanted, visitor, "left_semi")
    features = merge_counters(stored, live, [visitor], additive)
    d = assemble(waiting, [visitor], [(features, "left")])
    if leads:
        d = assemble(d, [leads[1]], [(leads[0], "left")])
    for c in null_text or []:
        d = d.withColumn(c, literal_null(c))
    return fill(d, defaults) if defaults else d


def score_rows(
    rows: DataFrame, model: PipelineModel, cut: float, types: dict[str, str] | None = None
) -> DataFrame:
    """Probability and two-band decision, with log types applied."""
    d = score(rows, model, [cut])
    return cast_all(d, types) if types else d
