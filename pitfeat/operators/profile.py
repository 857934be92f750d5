"""One-pass tables behind exploratory reports: shares, rates, lifts, quantiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitfeat.limits import estimated_bytes, limit, not_null
from pitfeat.operators.slices import plan_slices, running, sum_of


_MOMENTS = {"n": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}


def exact_quantiles(
    df: DataFrame, by: list[str], x: str, probs: dict[str, float],
    slice_rows: int | None = None, spread: bool | None = None, weight: str | None = None,
    moments: bool = False,
) -> DataFrame:
    """Interpolated quantiles per group, exact, without gathering a group's values.

    ``weight`` names a whole number of times that a row counts; ``moments`` adds n,
    mean, std, min and max from the same counts, without another reading, and a row
    for groups without values. Values are counted first, then a running count along the sorted values finds
    the two around each position. Input of a few MB uses the built-in percentile,
    which gives the same numbers but holds all distinct values of a group.
    """
    d = df if moments else df.where(F.col(x).isNotNull())
    d = d.withColumn("_x", F.col(x).cast("double"))
    if spread is None:
        spread = estimated_bytes(df) > limit(df.sparkSession, "percentile.bytes")
    if not spread:
        return d.groupBy(*by).agg(
            *[F.percentile("_x", F.lit(p), F.col(weight) if weight else F.lit(1)).alias(n)
              for n, p in probs.items()],
            *([a("_x").alias(n) for n, a in _MOMENTS.items()] if moments else []),
        )
    whole = not by
    if whole:  # one group, cut like any other hot key
        d, by = d.withColumn("_all", F.lit(0)), ["_all"]
    times = F.sum(weight) if weight else F.count("*")
    cells = d.groupBy(*by, "_x").agg(times.alias("_n"))
    slices = plan_slices(cells, by, "_x", slice_rows)
    line = running(cells, by, "_x", {"_to": sum_of(F.col("_n"))}, slices, inclusive=True, unique=True)
    some = F.when(F.col("_x").isNotNull(), F.col("_n"))
    size = F.coalesce(F.sum(some), F.lit(0))
    sizes = cells.groupBy(*by).agg(
        size.alias("_size"), F.try_divide(F.sum(F.col("_x") * F.col("_n")), F.sum(some)).alias("_mean"))
    line = line.drop("_all").crossJoin(F.broadcast(sizes.drop("_all"))) if whole else line.join(sizes, by)
    out = []
    for n, p in probs.items():
        at = (F.col("_size") - 1) * F.lit(p)
        low, high = F.floor(at), F.ceil(at)

        def value(rank):
            here = (F.col("_to") > rank) & (F.col("_to") - F.col("_n") <= rank)
            return F.max(F.when(here, F.col("_x")))

        # as the built-in percentile weighs them, so that infinite values stay what they are
        between = F.max(high - at) * value(low) + F.max(at - low) * value(high)
        out.append(F.when(value(low) == value(high), value(low)).otherwise(between).alias(n))
    if moments:
        around, n = F.sum(F.pow(F.col("_x") - F.col("_mean"), 2) * F.col("_n")), F.max("_size")
        std = F.when(n > 1, F.sqrt(around / (n - 1)))
        out += [n.alias("n"), F.max("_mean").alias("mean"), std.alias("std"),
                F.min("_x").alias("min"), F.max("_x").alias("max")]
    return line.groupBy(*([] if whole else by)).agg(*out)


def group_medians(
    df: DataFrame, by: list[str], medians: dict[str, str], **how
) -> DataFrame:
    """Put exact medians of the group on every row; no group is gathered in one buffer.

    A group without values and rows with a null key get nulls.
    """
    d, known = df, df.where(not_null(by))
    for n, x in medians.items():
        d = d.join(exact_quantiles(known, by, x, {n: 0.5}, **how), by, "left")
    return d.select(*df.columns, *medians)


def describe_by(
    df: DataFrame, columns: list[str], label: str, probs: dict[str, float] | None = None,
    slice_rows: int | None = None, spread: bool | None = None,
) -> DataFrame:
    """count, mean, std, min, quantiles and max of each column per class."""
    probs = probs or {"q25": 0.25, "q50": 0.5, "q75": 0.75, "q90": 0.9}
    long = unpivot(df, [label], columns)
    by = [label, "column"]
    found = exact_quantiles(long, by, "value", probs, slice_rows, spread, moments=True)
    return found.select(*by, "n", "mean", "std", "min", *probs, "max")


def unpivot(df: DataFrame, keep: list[str], columns: list[str]) -> DataFrame:
    return df.select(
        *keep, *[F.col(c).cast("double").alias(c) for c in columns]
    ).unpivot(keep, columns, "column", "value")


def box_stats(df: DataFrame, x: str, label: str, log: bool = True, **how) -> DataFrame:
    """Five-number summary per class, of ln(max(1, x)) by default."""
    v = F.log(F.greatest(F.lit(1.0), F.col(x).cast("double"))) if log else F.col(x)
    d = df.where(F.col(x).isNotNull()).withColumn("_v", v)
    five = {"low": 0.0, "q25": 0.25, "q50": 0.5, "q75": 0.75, "high": 1.0}
    return exact_quantiles(d, [label], "_v", five, **how)


def value_counts(df: DataFrame, x: str, by: list[str] | None = None) -> DataFrame:
    """Rows and share of each value, within ``by`` when given."""
    by = by or []
    counts = df.where(F.col(x).isNotNull()).groupBy(*by, x).agg(F.count("*").alias("n"))
    if by:
        sizes = counts.groupBy(*by).agg(F.sum("n").alias("_size"))
        counts = counts.join(sizes, by)
    else:
        counts = counts.crossJoin(counts.agg(F.sum("n").alias("_size")))
    return counts.withColumn("share", F.col("n") / F.col("_size")).drop("_size")


def rate_by_value(df: DataFrame, x: str, label: str) -> DataFrame:
    """Percentage of the positive class for each value."""
    return df.groupBy(x).agg(
        F.count("*").alias("n"), (F.avg(F.col(label).cast("double")) * 100).alias("rate")
    )


def lift(df: DataFrame, x: list[str], label: str, denominator: str = "negatives") -> DataFrame:
    """Positives per value as a percentage of its negatives or of all its rows.

    Values that lack one of the classes are left out, as are nulls.
    """
    if denominator not in ("negatives", "total"):
        raise ValueError(denominator)
    d = df.where(F.col(x[-1]).isNotNull()).groupBy(*x).agg(
        F.count_if(F.col(label) == 1).alias("positives"),
        F.count_if(F.col(label) == 0).alias("negatives"),
    )
    d = d.where("positives > 0 and negatives > 0")
    below = F.col("negatives")
    if denominator == "total":
        below = below + F.col("positives")
    return d.withColumn("lift", F.col("positives") * 100 / below)


def lift_top_k(
    df: DataFrame, x: str, label: str, k: int = 30, denominator: str = "total"
) -> DataFrame:
    """The k values with the highest lift, ties in value order."""
    return lift(df, [x], label, denominator).orderBy(F.desc("lift"), x).limit(k)


def bin_of(x: str, edges: list[float]) -> Column:
    """Index of the left-closed bin; null outside the edges."""
    v, out = F.col(x), F.lit(None)
    for i, (lo, hi) in enumerate(zip(edges, edges[1:])):
        out = F.when((v >= lo) & (v < hi), F.lit(i)).otherwise(out)
    return out.cast("int")


def binned_rate(df: DataFrame, x: str, label: str, edges: list[float]) -> DataFrame:
    """Percentage of positives per left-closed bin."""
    d = df.withColumn("bin", bin_of(x, edges)).where(F.col("bin").isNotNull())
    return d.groupBy("bin").agg(
        F.count("*").alias("n"), (F.avg(F.col(label).cast("double")) * 100).alias("rate")
    )


def histogram(
    df: DataFrame, x: str, label: str, bins: int, lo: float, hi: float, within: str = "class"
) -> DataFrame:
    """Equal-width histogram of values in [lo, hi] per class.

    ``share`` is relative to the class or, with ``within='all'``, to all rows in range.
    The last bin includes ``hi``.
    """
    width = (hi - lo) / bins
    v = F.col(x).cast("double")
    d = df.where(v.between(lo, hi)).withColumn(
        "bin", F.least(F.floor((v - lo) / width), F.lit(bins - 1)).cast("int")
    )
    counts = d.groupBy(label, "bin").agg(F.count("*").alias("n"))
    if within == "class":
        counts = counts.join(counts.groupBy(label).agg(F.sum("n").alias("_size")), label)
    else:
        counts = counts.crossJoin(counts.agg(F.sum("n").alias("_size")))
    return counts.withColumn("share", F.col("n") / F.col("_size")).drop("_size")


def month_rate(df: DataFrame, category: str, t: str, label: str) -> DataFrame:
    """Per category and month of the year: rows, positives and their ratio to negatives."""
    d = lift(df.withColumn("month", F.month(t)), [category, "month"], label)
    return d


def share_below(df: DataFrame, x: str, label: str, bound: float) -> DataFrame:
    """Share of each class below a bound; unknown values are not below it."""
    below = F.coalesce((F.col(x) < bound).cast("double"), F.lit(0.0))
    return df.groupBy(label).agg(F.avg(below).alias("share_below"))


def null_audit(df: DataFrame) -> DataFrame:
    """Null count of every column, in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column", "nulls")


def entity_slices(
    df: DataFrame, entity: str, by: list[str]
) -> DataFrame:
    """Distinct entities and rows per slice."""
    return df.groupBy(*by).agg(
        F.count_distinct(entity).alias("entities"), F.count("*").alias("n")
    )


def activity_counts(df: DataFrame, by: list[str], outcomes: dict[str, Column]) -> DataFrame:
    """Per entity: rows, earlier rows, and whether each outcome ever happened."""
    return df.groupBy(*by).agg(
        F.count("*").alias("n"),
        (F.count("*") - 1).alias("n_before_last"),
        *[F.max(F.when(c, 1).otherwise(0)).alias(n) for n, c in outcomes.items()],
    )
