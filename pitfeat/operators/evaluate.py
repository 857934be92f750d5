"""Decisions from scores, and what they are worth against the labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitfeat.operators.profile import exact_quantiles
from pitfeat.operators.slices import plan_slices, running, sum_of

GREEN, YELLOW, RED = "GREEN", "YELLOW", "RED"


def band(score: str, cuts: list[float], names: list[str]) -> Column:
    """Name of the band a score falls in; a score equal to a cut is in the upper band."""
    if len(names) != len(cuts) + 1:
        raise ValueError("one name more than cuts")
    out = F.when(F.col(score).isNotNull(), F.lit(names[0]))
    for cut, name in zip(cuts, names[1:]):
        out = F.when(F.col(score) >= cut, F.lit(name)).otherwise(out)
    return out


def confusion(df: DataFrame, score: str, label: str, threshold: float) -> DataFrame:
    """One row with tp, fp, fn and tn; at the threshold counts as positive."""
    yes = F.col(score) >= threshold
    bad = F.col(label) == 1
    return df.agg(
        F.count_if(yes & bad).alias("tp"),
        F.count_if(yes & ~bad).alias("fp"),
        F.count_if(~yes & bad).alias("fn"),
        F.count_if(~yes & ~bad).alias("tn"),
    )


def classification_report(
    df: DataFrame, score: str, label: str, threshold: float
) -> DataFrame:
    """Precision, recall, F1 and support of both classes (0 where undefined)."""
    c = confusion(df, score, label, threshold)

    def row(cls: int, hit: str, claimed_by: str, missed_by: str):
        return F.struct(
            F.lit(cls).alias("class"),
            F.col(hit).alias("hit"),
            F.col(claimed_by).alias("wrong"),
            F.col(missed_by).alias("missed"),
        )

    c = c.select(
        F.inline(F.array(row(1, "tp", "fp", "fn"), row(0, "tn", "fn", "fp")))
    )

    def ratio(a, b):
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    hit, wrong, missed = F.col("hit"), F.col("wrong"), F.col("missed")
    return c.select(
        "class",
        ratio(hit, hit + wrong).alias("precision"),
        ratio(hit, hit + missed).alias("recall"),
        ratio(hit * 2, hit * 2 + wrong + missed).alias("f1"),
        (hit + missed).alias("support"),
    )


def threshold_sweep(df: DataFrame, score: str, thresholds: list[float]) -> DataFrame:
    """Percentage of rows at or above each cut-off, all in one pass."""
    counts = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(F.col(score) >= c).alias(f"_{i}") for i, c in enumerate(thresholds)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(float(c)).alias("threshold"),
                F.col(f"_{i}").alias("n_red"),
                F.try_divide(F.col(f"_{i}") * 100, F.col("_rows")).alias("pct_red"),
            )
            for i, c in enumerate(thresholds)
        ]
    )
    return counts.select(F.inline(rows))


def pr_curve(df: DataFrame, score: str, label: str, slice_rows: int | None = None) -> DataFrame:
    """Precision and recall at every distinct score.

    Rows are counted per score first; the cumulative counts run over those, in
    slices when there are too many distinct scores for one task.
    """
    bad = F.col(label) == 1
    cells = (
        df.where(F.col(score).isNotNull())
        .groupBy(F.col(score).cast("double").alias("threshold"))
        .agg(F.count_if(bad).alias("_pos"), F.count("*").alias("_n"))
        .withColumns({"_all": F.lit(0), "_down": -F.col("threshold")})
    )
    slices = plan_slices(cells, ["_all"], "_down", slice_rows)
    line = running(
        cells, ["_all"], "_down",
        {"tp": sum_of(F.col("_pos")), "flagged": sum_of(F.col("_n"))},
        slices, inclusive=True, unique=True,
    )
    total = cells.agg(F.sum("_pos").alias("_total"))
    return line.crossJoin(F.broadcast(total)).select(
        "threshold",
        "tp",
        (F.col("flagged") - F.col("tp")).alias("fp"),
        F.try_divide(F.col("tp"), F.col("flagged")).alias("precision"),
        F.try_divide(F.col("tp"), F.col("_total")).alias("recall"),
    )


def threshold_at(
    curve: DataFrame, recall: float | None = None, precision: float | None = None
) -> DataFrame:
    """Highest threshold with at least this recall, or lowest with this precision."""
    if recall is not None:
        pick = F.max(F.when(F.col("recall") >= recall, F.col("threshold")))
    else:
        pick = F.min(F.when(F.col("precision") >= precision, F.col("threshold")))
    return curve.agg(pick.alias("threshold"))


def band_slices(
    df: DataFrame, score: str, label: str, cuts: list[float], names: list[str],
    probs: dict[str, float] | None = None, **how,
) -> DataFrame:
    """Per band and class: rows and summary of the scores.

    Label 1 in the top band and label 0 below it are the right decisions.
    """
    d = df.withColumn("band", band(score, cuts, names))
    by = ["band", label]
    right = (F.col("band") == names[-1]) == (F.col(label) == 1)
    stats = d.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.avg(score).alias("mean"),
        F.min(score).alias("min"),
        F.max(score).alias("max"),
    )
    q = exact_quantiles(d, by, score, probs or {"q50": 0.5, "q90": 0.9}, **how)
    return stats.join(q, by, "left").withColumn("correct", right.cast("int"))


def monitor(
    log: DataFrame, labels: DataFrame, on: list[str], score: str, label: str, threshold: float
) -> DataFrame:
    """Report on logged scores whose labels have since become known."""
    known = log.select(*on, score).join(labels.select(*on, label), on)
    return classification_report(known, score, label, threshold)
