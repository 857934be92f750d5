"""Ordered running aggregates that stay parallel inside one hot key.

A window partitioned by a key puts all rows of that key into one task. Here a
key with more rows than one task should hold is cut into slices of its order
column. Each slice runs its own window; what came before the slice is a carry
taken from a table with one row per slice, which is small by construction.

Cut points come from a sample, so a burst in time gets as many slices as it
needs. A value that is itself a cut point gets a slice of its own: all rows in
it are peers, so their result follows from the carry alone and they can be
spread over tasks freely. This covers a single time stamp that holds a large
part of all rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitfeat.checkpoints import cut_lineage
from pitfeat.limits import any_null, is_small, largest_key, limit, not_null, rows_per_key

SAMPLES_PER_SLICE = 32


@dataclass(frozen=True)
class Fold:
    """An aggregate that can be split: inside a slice, per slice, over slices."""

    local: Column
    part: Column
    merge: Callable[[Column], Column]
    join: Callable[[Column, Column], Column]
    empty: Column
    counts_steps: bool = False


def count_of(x: Column) -> Fold:
    return Fold(
        F.count(x), F.count(x), F.sum,
        lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)), F.lit(0),
    )


def sum_of(x: Column) -> Fold:
    return Fold(
        F.sum(x), F.sum(x), F.sum, lambda a, b: F.coalesce(a + b, a, b), F.lit(None)
    )


def min_of(x: Column) -> Fold:
    return Fold(F.min(x), F.min(x), F.min, F.least, F.lit(None))


def max_of(x: Column) -> Fold:
    return Fold(F.max(x), F.max(x), F.max, F.greatest, F.lit(None))


def steps_of(flag: Column, order: str) -> Fold:
    """Number of distinct order values that carry the flag."""
    return Fold(
        F.sum((flag & F.col("_first_peer")).cast("long")),
        F.count_distinct(F.when(flag, F.col(order))),
        F.sum,
        lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)),
        F.lit(0),
        counts_steps=True,
    )


class Place:
    """What was measured when a frame was placed by key; valid for all that derives from it.

    Windows, filters and joins to one row never add rows to a key, so operators
    further down need not measure again.
    """

    def __init__(self, df: DataFrame, by: list[str], t: str, micros: str, slices: Slices | None):
        self.by, self.t, self.micros, self.slices = by, t, micros, slices
        self._df, self._largest, self.operators = df, None, 0

    def largest(self) -> int:
        if self._largest is None:
            self._largest = largest_key(self._df, self.by)
        return self._largest


_places: dict[str, Place] = {}
_numbers = itertools.count()


def place(df: DataFrame, by: list[str], t: str, slice_rows: int | None = None) -> DataFrame:
    """Measure the keys once and put rows by key, so that a chain of operators shuffles once.

    Adds two helper columns that `unplace` drops: one scatters null keys, the
    other holds the time as a number, so that operators share one sort order.
    With hot keys the rows stay where they are; each operator then places its
    own slices.
    """
    timed_df = df.withColumn("_o", F.unix_micros(t))
    return _place(df, by, t, plan_slices(timed_df, by, "_o", slice_rows))


def _place(df: DataFrame, by: list[str], t: str, slices: Slices | None) -> DataFrame:
    n = next(_numbers)
    helper, micros = f"_spread_{n}", f"_micros_{n}"
    _places[helper] = Place(df, by, t, micros, slices)
    d = df.withColumns(
        {micros: F.unix_micros(t), helper: F.when(any_null(by), F.xxhash64(t))}
    )
    return d.repartition(*by, helper) if slices is None else d


def run_placed(
    df: DataFrame,
    by: list[str],
    t: str,
    chain: Callable[[DataFrame], DataFrame],
    slice_rows: int | None = None,
) -> DataFrame:
    """Run a chain of operators on the same key.

    Keys that fit a task share one shuffle and need nothing else. Only the rows
    of hot keys take the way through slices, where each operator reads its input
    twice and so settles it first.
    """
    slices = plan_slices(df.withColumn("_o", F.unix_micros(t)), by, "_o", slice_rows)
    if slices is None:
        return _chained(_place(df, by, t, None), chain)
    keys = F.broadcast(slices.table.select(*by))
    cold, hot = (
        df.join(keys, by, how).select(*df.columns) for how in ("left_anti", "left_semi")
    )
    return _chained(_place(cold, by, t, None), chain).unionByName(_chained(_place(hot, by, t, slices), chain))


def _chained(df: DataFrame, chain: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The chain on a placed frame; what was measured is forgotten, as nothing else derives from it."""
    out = unplace(chain(df))
    for c in df.columns:
        _places.pop(c, None)
    return out


def settled(df: DataFrame, by: list[str]) -> DataFrame:
    """Input of an operator that reads it twice because keys are hot.

    In a chain every such reading would repeat all operators before it, twice
    as many at each step. A written table stops that; the first operator of a
    chain reads its source again instead.
    """
    known = place_of(df, by)
    if known is None or known[1].slices is None:
        return df
    known[1].operators += 1
    return cut_lineage(df) if known[1].operators > 1 else df


def unplace(df: DataFrame) -> DataFrame:
    helpers = [c for c in df.columns if c in _places]
    return df.drop(*helpers, *[_places[c].micros for c in helpers])


def timed(df: DataFrame, by: list[str], t: str) -> tuple[DataFrame, str, list[str]]:
    """Frame, name of the column with the time in microseconds, columns to drop."""
    known = place_of(df, by)
    if known and known[1].t == t and known[1].micros in df.columns:
        return df, known[1].micros, []
    return df.withColumn("_o", F.unix_micros(t)), "_o", ["_o"]


def place_of(df: DataFrame, by: list[str]) -> tuple[str, Place] | None:
    """Helper column and measurements for ``by`` or for leading columns of it."""
    for i in range(len(by), 0, -1):
        for c in df.columns:
            if c in _places and _places[c].by == by[:i]:
                return c, _places[c]
    return None


def placed(df: DataFrame, by: list[str], order: str) -> tuple[DataFrame, list[str], list[str]]:
    """Frame, partition columns and helper columns to drop.

    Rows with a null key match nothing, so a helper column scatters them instead
    of leaving them in one partition. The helper of `place` is used again where
    present: Spark then sees the same placement and adds no shuffle.
    """
    known = place_of(df, by)
    if known:
        return df, [*by, known[0]], []
    keys = [*by, "_spread"]
    if "_spread" in df.columns:  # put there by the operator that calls this one
        return df, keys, []
    scattered = F.when(any_null(by), F.xxhash64(order))
    return df.withColumn("_spread", scattered), keys, ["_spread"]


def slices_for(
    df: DataFrame, by: list[str], order: str, rows: int | None = None, seen: dict[str, int] | None = None
) -> Slices | None:
    """Cut points for an operator on (by, order), measured only if not known already.

    Cut points decide about balance, never about results, so those of one time
    column serve another time column of the same key.
    """
    known = place_of(df, by)
    if known and rows is None and known[1].by == by:
        return known[1].slices
    if known and rows is None and known[1].slices is None:
        return None
    return plan_slices(df, by, order, rows, seen)


def largest_rows(df: DataFrame, by: list[str]) -> int:
    """Most rows of one key, or a bound on it from where the frame was placed."""
    known = place_of(df, by)
    return known[1].largest() if known else largest_key(df, by)


class Slices:
    """Cut points of the hot keys of one (key, order) pair."""

    def __init__(self, table: DataFrame, by: list[str], width: int, heavy: bool = False):
        self.table, self.by, self.width = table, by, width
        #: whether one value alone has as many rows as a slice should have
        self.heavy = heavy

    def assign(self, df: DataFrame, order: str) -> DataFrame:
        """Add ``_hot``, ``_slice`` (increasing with the order column) and ``_salt``.

        ``_slice`` is odd for a slice made of one order value, -1 for a null order.
        """
        o, cuts = F.col(order), F.col("_cuts")
        steps = [1 << i for i in reversed(range(self.width.bit_length()))]
        below = F.aggregate(
            F.array(*[F.lit(s) for s in steps]),
            F.lit(0),
            lambda lo, s: F.when(F.get(cuts, lo + s - 1) < o, lo + s).otherwise(lo),
        )
        d = df.join(F.broadcast(self.table), self.by, "left")
        d = d.withColumn("_below", F.when(cuts.isNotNull() & o.isNotNull(), below))
        single = F.coalesce(F.get(cuts, F.col("_below")) == o, F.lit(False))
        d = d.withColumns(
            {
                "_hot": cuts.isNotNull(),
                "_slice": F.when(cuts.isNull(), F.lit(0))
                .when(o.isNull(), F.lit(-1))
                .otherwise(F.col("_below") * 2 + single.cast("int")),
            }
        )
        return d.withColumn(
            "_salt", F.when(is_spread(), F.spark_partition_id()).otherwise(F.lit(0))
        ).drop("_cuts", "_below")


def is_spread() -> Column:
    """True for slices whose rows are peers and may be placed anywhere."""
    return (F.col("_slice") % 2) != 0


def plan_slices(
    df: DataFrame, by: list[str], order: str, rows: int | None = None, seen: dict[str, int] | None = None
) -> Slices | None:
    """Measure the keys of ``df`` and cut the hot ones; None when no key is hot.

    If it measures, it puts the number of rows with a key into ``seen``.

    A key is hot above max(rows, total / slice.max) rows. So there are fewer hot
    keys than slice.max, and their cut points number at most twice that: the
    table collected here and broadcast later is bounded whatever the input size.
    """
    spark = df.sparkSession
    if rows is None:
        if is_small(df):
            return None
        rows = limit(spark, "slice.rows")
    sizes = rows_per_key(df, by)
    total, top = sizes.agg(F.sum("_n"), F.max("_n")).first()
    if seen is not None:
        seen["rows"] = total or 0
    if not top:
        return None
    cut = max(rows, total // limit(spark, "slice.max"))
    if top <= cut:
        return None
    hot = sizes.where(F.col("_n") > cut).select(*by)
    sample = (
        df.select(*by, order)
        .where(F.col(order).isNotNull())
        .where(F.rand(17) < min(1.0, SAMPLES_PER_SLICE / cut))
        .join(F.broadcast(hot), by)
    )
    place = Window.partitionBy(*by).orderBy(order)
    found = (
        sample.withColumn("_i", F.row_number().over(place))
        .where(F.col("_i") % min(SAMPLES_PER_SLICE, cut) == 0)
        .groupBy(*by)
        .agg(F.sort_array(F.collect_set(order)).alias("_cuts"), F.count("*").alias("_points"))
    )
    rows_ = found.collect()
    if not rows_:
        return None
    width = max(len(r["_cuts"]) for r in rows_)
    heavy = any(r["_points"] > len(r["_cuts"]) for r in rows_)
    return Slices(spark.createDataFrame(rows_, found.schema).drop("_points"), by, width, heavy)


def tied(
    df: DataFrame, by: list[str], order: str, tie: list[str], slices: Slices | None, rows: int | None = None
) -> tuple[DataFrame, str, Slices | None]:
    """Frame, order column and slices for an operator that goes by row, in order of (order, tie).

    Rows of one time stamp are not peers to it. Where a time stamp alone has more rows
    than a task should hold, the cuts are taken anew on time and tie columns together,
    so that its rows are spread over slices like any others. Only rows that agree in
    the tie columns as well stay together.
    """
    if slices is None or not slices.heavy or not tie:
        return df, order, slices
    both = F.when(F.col(order).isNotNull(), F.struct(order, *tie))
    df = df.withColumn("_order_tie", both)
    finer = plan_slices(df, by, "_order_tie", rows or limit(df.sparkSession, "slice.rows"))
    return (df, order, slices) if finer is None else (df, "_order_tie", finer)


def running(
    df: DataFrame,
    by: list[str],
    order: str,
    folds: dict[str, Fold],
    slices: Slices | None = None,
    inclusive: bool = False,
    unique: bool = False,
) -> DataFrame:
    """Add, per row, each fold over the rows of the same key that come before it.

    "Before" means a strictly smaller ``order`` (``inclusive`` adds the row and
    its peers). ``order`` is numeric; when it is not an integer, values must be
    ``unique`` per key. Rows with a null key or order get the empty value, and
    the caller's expressions decide what a row contributes.
    """
    last = 0 if inclusive else (Window.currentRow - 1)

    def frame(w):
        if unique:
            return w.rowsBetween(Window.unboundedPreceding, last)
        return w.rangeBetween(Window.unboundedPreceding, last)

    ok = not_null([*by, order])
    d, keys, _ = placed(df, by, order)
    if slices is None:
        w = Window.partitionBy(*keys).orderBy(order)
    else:
        d = slices.assign(d, order)
        w = Window.partitionBy(*keys, "_slice", "_salt").orderBy(order)
    if any(f.counts_steps for f in folds.values()):
        prev = F.lag(order).over(w)
        d = d.withColumn("_first_peer", prev.isNull() | (prev != F.col(order)))
    local = d.withColumns({f"_l_{n}": f.local.over(frame(w)) for n, f in folds.items()})
    if slices is None:
        done = {
            n: F.when(ok, F.col(f"_l_{n}")).otherwise(f.empty) for n, f in folds.items()
        }
    else:
        carry = slice_carry(d, by, folds)
        local = local.join(F.broadcast(carry), [*by, "_slice"], "left")
        done = {}
        for n, f in folds.items():
            own = F.col(f"_p_{n}") if inclusive else F.lit(None)
            here = F.when(is_spread(), own).otherwise(F.col(f"_l_{n}"))
            done[n] = F.when(ok, f.join(F.col(f"_c_{n}"), here)).otherwise(f.empty)
    return local.select(
        *[F.col(c) for c in df.columns if c not in folds],
        *[value.alias(n) for n, value in done.items()],
    )


def slice_carry(d: DataFrame, by: list[str], folds: dict[str, Fold]) -> DataFrame:
    """One row per slice of a hot key: its own total and that of earlier slices."""
    parts = (
        d.where("_hot")
        .groupBy(*by, "_slice")
        .agg(*[f.part.alias(f"_p_{n}") for n, f in folds.items()])
    )
    before = (
        Window.partitionBy(*by)
        .orderBy("_slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return parts.withColumns(
        {f"_c_{n}": f.merge(F.col(f"_p_{n}")).over(before) for n, f in folds.items()}
    )


def group_transform(
    df: DataFrame, by: list[str], aggs: dict[str, Column], salt: str, hot: bool | None = None,
    distinct: dict[str, str] | None = None,
) -> DataFrame:
    """Put unordered group aggregates on every row of the group.

    One window when groups are known to fit a task. Otherwise a map-side
    combined aggregate joined back, which adaptive execution splits on a skewed
    key. ``distinct`` names columns whose distinct values are counted, always the
    second way, as no window offers it. Rows with a null key get nulls.
    """
    if distinct:
        aggs = aggs | {n: F.count_distinct(c) for n, c in distinct.items()}
        hot = True
    if hot is None:
        known = place_of(df, by)
        if known:
            hot = known[1].slices is not None
        else:
            rows = limit(df.sparkSession, "slice.rows")
            hot = not is_small(df) and largest_key(df, by) > rows
    ok = not_null(by)
    if not hot:
        d, keys, helpers = placed(df, by, salt)
        w = Window.partitionBy(*keys)
        d = d.withColumns({n: F.when(ok, a.over(w)) for n, a in aggs.items()})
        return d.drop(*helpers)
    d = settled(df, by)
    totals = d.where(ok).groupBy(*by).agg(*[a.alias(n) for n, a in aggs.items()])
    return d.join(totals, by, "left").select(*df.columns, *aggs)


