"""Training sets: time splits and samples of exact size."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitfeat.checkpoints import cut_lineage

#: leading hex digits of a row's hash that make its cell: a million cells
DIGITS = 5
#: most strata whose borders are broadcast, one short row each
MOST_STRATA = 10_000
#: copies of a row are written out in parts of this size
COPIES = 4_096


def time_split(
    df: DataFrame, t: str, bounds: dict[str, dict[int, tuple[str, str]]],
    label: str, extra: dict[int, Column] | None = None,
) -> DataFrame:
    """Tag rows with the split they belong to; rows in no split are dropped.

    ``bounds[split][class]`` is a half-open [from, to) period; ``extra[class]`` is a
    further condition for that class, e.g. only settled rows.
    """
    split = F.lit(None).cast("string")
    for name, classes in bounds.items():
        for cls, (lo, hi) in classes.items():
            inside = (F.col(label) == cls) & (F.col(t) >= lo) & (F.col(t) < hi)
            if extra and cls in extra:
                inside = inside & extra[cls]
            split = F.when(inside, F.lit(name)).otherwise(split)
    return df.withColumn("split", split).where(F.col("split").isNotNull())


def exact_sample(
    df: DataFrame, want: Callable[[DataFrame], DataFrame], by: list[str], seed: int, strata: int,
    key: list[str] | None = None, always: Column | None = None,
) -> DataFrame:
    """Keep exactly ``_want`` rows per stratum, the same ones on every run.

    Rows are ordered by the md5 of the seed and the ``key`` columns, joined by '|',
    or without a key by a 64-bit hash of seed and all columns; ties by all columns. A
    histogram of the hash in a million cells tells where each stratum ends: lower
    cells are kept whole, and only the cell on the border is ranked. Copies of a row
    share a hash and so a cell: the border cell is counted by distinct row and the
    kept copies are written out again. Rows for which ``always`` holds are kept and
    not counted. ``want`` makes the ``_want`` of each stratum, ``strata`` rows, from
    the histogram, which has ``_free`` for those rows and their number in ``_n``.
    """
    columns = df.columns
    if key:
        h = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key]))
    else:
        h = F.lpad(F.lower(F.hex(F.xxhash64(F.lit(seed), *columns))), 16, "0")
    free = F.lit(False) if always is None else F.coalesce(always, F.lit(False))
    d = df.withColumns({"_free": free, "_h": h, "_cell": F.substring(h, 1, DIGITS)})
    whole_table = not by
    if whole_table:
        d, by = d.withColumn("_all", F.lit(0)), ["_all"]
    # one reading tells the sizes of strata and where they end
    cells = cut_lineage(d.groupBy(*by, "_free", F.when(~F.col("_free"), F.col("_cell")).alias("_cell")).agg(
        F.count("*").alias("_n")))
    want = want(cells)
    want = want.withColumn("_all", F.lit(0)) if whole_table else want
    few = strata <= MOST_STRATA
    upto = Window.partitionBy(*by).orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)
    cells = cells.where("not _free").withColumn("_to", F.sum("_n").over(upto)).join(
        F.broadcast(want) if few else want, by)
    # the first cell that does not fit whole; without one the stratum is kept whole
    need = (F.col("_want") - F.col("_to") + F.col("_n")).alias("_need")
    borders = cells.where("_to > _want").groupBy(*by).agg(
        F.min(F.struct(F.col("_cell").alias("_border"), need)).alias("_at")
    )
    ends = want.join(borders, by, "left").select(*by, F.lit(True).alias("_asked"), "_at.*")
    d = d.join(F.broadcast(ends) if few else ends, by, "left")
    whole = d.where("_free or (_asked and (_border is null or _cell < _border))").select(*columns)
    edge = d.where("not _free and _cell = _border and _need > 0")
    edge = edge.groupBy(*dict.fromkeys([*columns, *by]), "_h", "_need").agg(F.count("*").alias("_n"))
    rank = Window.partitionBy(*by).orderBy("_h", *columns)
    so_far = F.sum("_n").over(rank.rowsBetween(Window.unboundedPreceding, -1))
    edge = edge.withColumn(
        "_copies", F.least(F.col("_n"), F.col("_need") - F.coalesce(so_far, F.lit(0)))
    ).where("_copies > 0")
    return whole.unionByName(_repeated(edge, "_copies").select(*columns))


def _repeated(df: DataFrame, n: str) -> DataFrame:
    """Each row as often as ``n`` says, by way of arrays of bounded size."""
    part = F.explode(F.expr(f"sequence(0, ({n} - 1) div {COPIES})")).alias("_part")
    d = df.select("*", part)
    here = F.expr(f"sequence(1, least({COPIES}, {n} - _part * {COPIES}))")
    return d.select("*", F.explode(here).alias("_copy"))


def undersample(
    df: DataFrame, label: str, ratio: float, seed: int = 42, key: list[str] | None = None
) -> DataFrame:
    """All labelled rows and exactly ratio times as many of the others."""
    def want(cells):
        return cells.agg((_labelled() * ratio).cast("long").alias("_want"))

    return exact_sample(df, want, [], seed, 1, key, F.col(label) == 1)


def _labelled() -> Column:
    """Rows that are kept anyway, from a histogram."""
    return F.coalesce(F.sum(F.when(F.col("_free"), F.col("_n"))), F.lit(0))


def undersample_fast(df: DataFrame, label: str, fractions: dict[int, float], seed: int = 42):
    """Bernoulli sample per class: no shuffle, size only in expectation."""
    return df.sampleBy(label, fractions, seed)


def sample_by_period(
    df: DataFrame, label: str, period: Column, ratios: dict[str, float], seed: int = 1,
    key: list[str] | None = None,
) -> DataFrame:
    """All labelled rows, plus ratio x their number of other rows from each period."""
    columns = df.columns
    d = df.withColumn("_period", period)
    sizes = F.create_map(*[F.lit(x) for kv in ratios.items() for x in kv])

    def want(cells):
        n = cells.agg(_labelled().alias("_n"))
        return n.select(F.explode(sizes).alias("_period", "_ratio"), "_n").select(
            "_period", F.floor(F.col("_n") * F.col("_ratio")).cast("long").alias("_want"))

    kept = exact_sample(
        d, want, ["_period"], seed, len(ratios), key or columns, F.col(label) == 1
    )
    return kept.select(*columns)
