"""History of an entity as of each of its rows.

All operators answer the same question: what did the rows of this key look like
strictly before (or in a trailing period up to) this row? None of them joins the
table to itself.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitfeat.checkpoints import cut_lineage
from pitfeat.limits import broadcast_checked, dealt, limit, not_null, rows_per_key
from pitfeat.operators.median import before_medians
from pitfeat.operators.slices import (
    Slices,
    count_of,
    group_transform,
    largest_rows,
    max_of,
    min_of,
    place_of,
    placed,
    plan_slices,
    running,
    settled,
    slices_for,
    sum_of,
    tied,
    timed,
)

MICROS_PER_SECOND = 1_000_000


@dataclass(frozen=True)
class Agg:
    """What to compute over the earlier rows: a kind and the column it reads."""

    kind: str
    x: Column | None = None


def count(condition: Column | None = None) -> Agg:
    return Agg("count", F.lit(1) if condition is None else F.when(condition, 1))


def total(x: Column | str) -> Agg:
    return Agg("total", _col(x))


def mean(x: Column | str) -> Agg:
    return Agg("mean", _col(x))


def lowest(x: Column | str) -> Agg:
    return Agg("lowest", _col(x))


def highest(x: Column | str) -> Agg:
    return Agg("highest", _col(x))


def median(x: Column | str) -> Agg:
    return Agg("median", _col(x))


def distinct(x: Column | str) -> Agg:
    return Agg("distinct", _col(x))


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def prior_agg(
    df: DataFrame,
    by: list[str],
    t: str,
    aggs: dict[str, Agg],
    slice_rows: int | None = None,
    frame_rows: int | None = None,
) -> DataFrame:
    """Add aggregates over the rows of the same key with a strictly smaller time.

    Equal times never see each other. Rows with a null key or time have no
    history and are nobody's history: counts 0, the rest null.
    """
    d, keys, _ = placed(settled(df, by), by, t)
    d, o, _ = timed(d, by, t)
    # a row with null time must not contribute
    seen = F.col(o).isNotNull()
    d = d.withColumns({f"_x_{n}": F.when(seen, a.x) for n, a in aggs.items()})
    seen: dict[str, int] = {}
    slices = slices_for(d, by, o, slice_rows, seen)
    folds, done = {}, {}
    for n, a in aggs.items():
        x = F.col(f"_x_{n}")
        if a.kind == "count":
            folds[n] = count_of(x)
        elif a.kind == "total":
            folds[n] = sum_of(x)
        elif a.kind == "lowest":
            folds[n] = min_of(x)
        elif a.kind == "highest":
            folds[n] = max_of(x)
        elif a.kind == "mean":
            folds[f"_s_{n}"] = sum_of(x.cast("double"))
            folds[f"_n_{n}"] = count_of(x)
            done[n] = F.try_divide(F.col(f"_s_{n}"), F.col(f"_n_{n}"))
        elif a.kind not in ("median", "distinct"):
            raise ValueError(a.kind)
    distincts = [n for n, a in aggs.items() if a.kind == "distinct"]
    medians = [n for n, a in aggs.items() if a.kind == "median"]

    big = False
    if medians:
        frame_rows = frame_rows or limit(df.sparkSession, "frame.rows")
        big = largest_rows(d, by) > frame_rows
    if distincts and slices is None:
        # both windows below need rows placed by key only: one shuffle, two sorts
        if place_of(df, by) is None:
            d = dealt(d, keys, seen.get("rows"))
        for n in distincts:
            first = Window.partitionBy(*keys, f"_x_{n}").orderBy(o)
            d = d.withColumn(
                f"_f_{n}",
                F.when(F.col(f"_x_{n}").isNotNull() & (F.row_number().over(first) == 1), 1),
            )
            folds[n] = count_of(F.col(f"_f_{n}"))
    elif distincts:
        # the first sight of each value becomes an extra row that counts for one
        marks = None
        for n in distincts:
            v = f"_x_{n}"
            first = d.where(F.col(v).isNotNull() & not_null(by)).groupBy(*by, v)
            m = first.agg(F.min(o).alias(o)).groupBy(*by, o)
            m = m.agg(F.count("*").alias(f"_f_{n}")).withColumn("_mark", F.lit(True))
            marks = m if marks is None else marks.unionByName(m, allowMissingColumns=True)
            folds[n] = sum_of(F.col(f"_f_{n}"))
            done[n] = F.coalesce(n, F.lit(0))
        d = d.unionByName(marks, allowMissingColumns=True)
    if medians:
        d, scatter = mark_long(d, by, keys, o, slices, frame_rows) if big else (d, keys)
        w = (
            Window.partitionBy(*scatter)
            .orderBy(o)
            .rangeBetween(Window.unboundedPreceding, -1)
        )
        short = not_null([*by, o])
        if big:
            short = short & ~F.col("_long")
        for n in medians:
            # values of long keys never enter the frame
            half = F.percentile(F.when(short, F.col(f"_x_{n}").cast("double")), F.lit(0.5))
            d = d.withColumn(f"_m_{n}", F.when(short, half.over(w)))
            done[n] = F.coalesce(f"_m_{n}", f"_h_{n}") if big else F.col(f"_m_{n}")
    if folds:
        d = running(d, by, o, folds, slices)
    if distincts and slices is not None:
        d = d.where(F.col("_mark").isNull()).drop("_mark")
    if big:
        d = cut_lineage(d)
        long = d.where("_long")
        for n in medians:
            facts = long.select(
                *by,
                (F.col(o) * 2 + 1).alias("_at"),
                F.col(f"_x_{n}").cast("double").alias("_x"),
                F.lit(1).alias("_w"),
            )
            probes = long.select(*by, (F.col(o) * 2).alias("_at")).distinct()
            half = before_medians(facts, probes, by, slice_rows).select(
                *by, F.expr("_at div 2").alias(o), F.col("_median").alias(f"_h_{n}")
            )
            d = d.join(half, [*by, o], "left")
    d = d.withColumns(done)
    return d.select(*[F.col(c) for c in df.columns], *[F.col(n) for n in aggs])


def mark_long(
    d: DataFrame, by: list[str], keys: list[str], o: str, slices: Slices | None, frame_rows: int
) -> tuple[DataFrame, list[str]]:
    """Add ``_long``: does the key have more rows than a quadratic frame may take?

    Returns the partition columns of such frames as well. Without hot keys a
    count over the placed rows is free. With hot keys the counts are joined, and
    rows of long keys are scattered, as no frame will look at them.
    """
    if slices is None:
        size = F.count(F.lit(1)).over(Window.partitionBy(*keys))
        return d.withColumn("_long", not_null(by) & (size > frame_rows)), keys
    d = join_long(d, by, frame_rows)
    d = d.withColumn("_scatter", F.when(F.col("_long"), F.xxhash64(o)))
    return d, [*keys, "_scatter"]


def join_long(d: DataFrame, by: list[str], frame_rows: int) -> DataFrame:
    """Add ``_long`` from the counts of the keys; rows stay where they are if long keys are few."""
    long = rows_per_key(d, by).where(F.col("_n") > frame_rows).select(*by, F.lit(True).alias("_long"))
    d = d.join(broadcast_checked(long), by, "left")
    return d.withColumn("_long", F.coalesce("_long", F.lit(False)))


def prior_agg_other(
    left: DataFrame,
    right: DataFrame,
    by: list[str],
    t_left: str,
    t_right: str,
    aggs: dict[str, Agg],
    slice_rows: int | None = None,
) -> DataFrame:
    """Add to each left row aggregates over the right rows of its key strictly before it."""
    names = [f"_a_{n}" for n in aggs]
    facts = right.where(not_null([*by, t_right])).select(
        *by,
        F.col(t_right).alias("_t"),
        *[a.x.alias(c) for a, c in zip(aggs.values(), names)],
    )
    probes = left.select(
        *by, F.col(t_left).alias("_t"), F.struct(*left.columns).alias("_left")
    )
    both = probes.unionByName(facts, allowMissingColumns=True)
    # a probe must not count as history, so a plain count turns into a flag
    fact = F.col("_left").isNull()
    over = {
        n: Agg(a.kind, F.when(fact, F.col(c))) for (n, a), c in zip(aggs.items(), names)
    }
    d = prior_agg(both, by, "_t", over, slice_rows)
    return d.where(~fact).select("_left.*", *aggs)


def trailing_agg(
    df: DataFrame,
    by: list[str],
    t: str,
    seconds: int,
    aggs: dict[str, Agg],
    frame_rows: int | None = None,
    slice_rows: int | None = None,
) -> DataFrame:
    """Add aggregates over the rows of the same key in [time - seconds, time].

    Both ends and the row itself count. A sliding frame costs rows x frame, so
    it serves only short keys. Longer ones are summed over cells of time that are as
    long as the window; their medians and distinct values come from events that
    add a value and take it away.
    """
    width = seconds * MICROS_PER_SECOND
    d, keys, _ = placed(df, by, t)
    d = d.withColumn("_o", F.unix_micros(t))
    d = d.withColumns({f"_x_{n}": a.x for n, a in aggs.items()})
    frame_rows = frame_rows or limit(df.sparkSession, "frame.rows")
    names = [*df.columns, *aggs]
    if largest_rows(d, by) <= frame_rows:
        return _trailing_by_frame(d, by, keys, width, aggs).select(*names)
    if place_of(df, by) is None:
        d = join_long(d, by, frame_rows)
    else:
        d, _ = mark_long(d, by, keys, "_o", slices_for(d, by, "_o", slice_rows), frame_rows)
    d = cut_lineage(d)
    short = _trailing_by_frame(d.where("not _long"), by, keys, width, aggs).select(*names)
    long = _trailing_by_events(d.where("_long"), by, width, aggs, slice_rows)
    # one type, whatever way a key took
    kinds = {n: short.schema[n].dataType for n in aggs}
    return short.unionByName(long.select(*df.columns, *[F.col(n).cast(t).alias(n) for n, t in kinds.items()]))


def _trailing_by_frame(d, by, keys, width, aggs):
    ok = not_null([*by, "_o"])
    w = (
        Window.partitionBy(*keys)
        .orderBy("_o")
        .rangeBetween(-width, Window.currentRow)
    )
    done = {}
    for n, a in aggs.items():
        x = F.col(f"_x_{n}")
        value = {
            "count": lambda x=x: F.count(x).over(w),
            "total": lambda x=x: F.sum(x).over(w),
            "mean": lambda x=x: F.avg(x).over(w),
            "median": lambda x=x: F.percentile(x.cast("double"), F.lit(0.5)).over(w),
            "distinct": lambda x=x: F.size(F.collect_set(x).over(w)).cast("long"),
            "lowest": lambda x=x: F.min(x).over(w),
            "highest": lambda x=x: F.max(x).over(w),
        }[a.kind]()
        zero = F.lit(0) if a.kind in ("count", "distinct") else F.lit(None)
        done[n] = F.when(ok, value).otherwise(zero)
    return d.withColumns(done)


def _trailing_by_events(d, by, width, aggs, slice_rows):
    """Windows of long keys, found once for every moment of a key and joined to its rows."""
    rows = d.where(not_null([*by, "_o"]))
    enter, leave = F.col("_o") * 2, (F.col("_o") + width) * 2 + 1
    probes = cut_lineage(rows.select(*by, (F.col("_o") * 2 + 1).alias("_at")).distinct())
    events, done, tables, plain = None, {}, [], {}

    def add(part):
        nonlocal events
        events = part if events is None else events.unionByName(part, True)

    for n, a in aggs.items():
        x = F.col(f"_x_{n}")
        some = rows.where(x.isNotNull())
        if a.kind in ("count", "total", "mean", "lowest", "highest"):
            plain[n] = a.kind
        elif a.kind == "distinct":
            # a value is present during runs of sightings at most `width` apart
            cells = cut_lineage(some.select(*by, x.alias("_v"), "_o").distinct())
            pair = [*by, "_v"]
            seen = running(
                cells, pair, "_o", {"_prev": max_of(F.col("_o"))},
                plan_slices(cells, pair, "_o", slice_rows),
            )
            new = seen.where(F.col("_prev").isNull() | (F.col("_o") - F.col("_prev") > width))
            # a run begins with a row and ends at the one before the next run
            turns = F.array(
                F.struct(enter.alias("at"), F.lit(1).alias("w")),
                F.struct(((F.col("_prev") + width) * 2 + 1).alias("at"), F.lit(-1).alias("w")),
            )
            turns = new.select(*by, F.explode(turns).alias("_t")).where("_t.at is not null")
            add(turns.select(*by, F.col("_t.at").alias("_at"), F.col("_t.w").alias(f"_n_{n}")))
            ends = cells.groupBy(*pair).agg(F.max("_o").alias("_o"))
            add(ends.select(*by, leave.alias("_at"), F.lit(-1).alias(f"_n_{n}")))
            done[n] = F.coalesce(f"_n_{n}", F.lit(0))
        elif a.kind == "median":
            facts = [
                some.select(*by, at.alias("_at"), x.cast("double").alias("_x"), F.lit(w).alias("_w"))
                for at, w in ((enter, 1), (leave, -1))
            ]
            half = before_medians(facts[0].unionByName(facts[1]), probes, by, slice_rows)
            tables.append(half.withColumnRenamed("_median", n))
        else:
            raise ValueError(a.kind)
    if events is not None:
        sums = [c for c in events.columns if c not in (*by, "_at")]
        # what happens at one moment is one row
        line = probes.withColumn("_probe", F.lit(True)).unionByName(events, True).groupBy(*by, "_at")
        line = cut_lineage(line.agg(F.max("_probe").alias("_probe"), *[F.sum(c).alias(c) for c in sums]))
        slices = plan_slices(line, by, "_at", slice_rows)
        # a value that leaves at a probe's own moment is still there
        line = running(line, by, "_at", {c: sum_of(F.col(c)) for c in sums}, slices)
        tables.append(line.where("_probe").select(*by, "_at", *sums))
    if plain:
        tables.append(_trailing_by_cells(rows, by, width, plain, slice_rows).select(
            *by, (F.col("_o") * 2 + 1).alias("_at"), *plain))
        done |= {n: F.coalesce(n, F.lit(0)) for n, kind in plain.items() if kind == "count"}
    found = probes
    for table in tables:
        found = found.join(table, [*by, "_at"], "left")
    d = d.withColumn("_at", F.col("_o") * 2 + 1).join(found, [*by, "_at"], "left")
    return d.withColumns(done)


def _trailing_by_cells(rows, by, width, kinds, slice_rows):
    """Aggregates over [time - width, time] for every distinct time of a key.

    Time is cut into cells as long as the window, so a window is the end of one
    cell and the beginning of the next. Both are running aggregates, one of them
    from the end of the cell backwards. Nothing is ever subtracted, so a value
    that has left the window leaves no trace: no rounding, no NaN, no infinity.
    Rows of one moment are combined first.
    """
    size = width + 1
    cell = F.col("_o") - F.pmod(F.col("_o"), F.lit(size))
    parts, folds = {}, {}
    for n, kind in kinds.items():
        x = F.col(f"_x_{n}")
        if kind in ("count", "mean"):
            parts[f"_n_{n}"], folds[f"_n_{n}"] = F.count(x), sum_of
        if kind != "count":
            part, folds[f"_s_{n}"] = {"lowest": (F.min, min_of), "highest": (F.max, max_of)}.get(kind, (F.sum, sum_of))
            parts[f"_s_{n}"] = part(x.cast("double") if kind == "mean" else x)
    moments = cut_lineage(rows.groupBy(*by, "_o").agg(*[p.alias(c) for c, p in parts.items()]))

    def folded(side, line, inclusive):
        key = [*by, "_cell"]
        slices = plan_slices(line, key, "_at", slice_rows)
        over = {f"{c}{side}": fold(F.col(c)) for c, fold in folds.items()}
        return running(line, key, "_at", over, slices, inclusive=inclusive)

    here = folded("_b", moments.select("*", cell.alias("_cell"), F.col("_o").alias("_at")), True)
    # moved on by one cell, the rows before the window's start are those at or before the probe
    moved = moments.select(*by, (cell + size).alias("_cell"), (-F.col("_o") - size).alias("_at"), *parts)
    asked = moments.select(*by, "_o", cell.alias("_cell"), (-F.col("_o")).alias("_at"), F.lit(True).alias("_probe"))
    there = folded("_a", moved.unionByName(asked, True), False).where("_probe")
    both = here.select(*by, "_o", *[f"{c}_b" for c in folds]).join(
        there.select(*by, "_o", *[f"{c}_a" for c in folds]), [*by, "_o"])
    out = {}
    for n, kind in kinds.items():
        a, b = F.col(f"_s_{n}_a"), F.col(f"_s_{n}_b")
        count = lambda n=n: F.coalesce(f"_n_{n}_a", F.lit(0)) + F.coalesce(f"_n_{n}_b", F.lit(0))
        out[n] = {
            "count": lambda: count(),
            "total": lambda a=a, b=b: F.coalesce(a + b, a, b),
            "mean": lambda a=a, b=b: F.when(count() > 0, F.coalesce(a + b, a, b) / count()),
            "lowest": lambda a=a, b=b: F.least(a, b),
            "highest": lambda a=a, b=b: F.greatest(a, b),
        }[kind]()
    return both.select(*by, "_o", *[c.alias(n) for n, c in out.items()])


def last_n(
    df: DataFrame,
    by: list[str],
    t: str,
    tie: list[str],
    n: int,
    values: list[str],
    name: str = "recent",
    slice_rows: int | None = None,
) -> DataFrame:
    """Add an array of the ``n`` rows before this one, without those at the same time.

    Rows are counted back by (time, ``tie``); a row at the same time takes a
    place but does not appear. Each element is a struct of ``values``.
    """
    item = F.struct(F.col(t).alias("t"), *values)
    ok = not_null([*by, t])
    d, keys, _ = placed(settled(df, by), by, t)
    d, o, _ = timed(d, by, t)
    d = d.withColumn("_item", F.when(F.col(t).isNotNull(), item))
    d, at, slices = tied(d, by, o, tie, slices_for(d, by, o, slice_rows), slice_rows)
    if slices is not None:
        d = slices.assign(d, at)
        keys = [*keys, "_slice"]
    w = Window.partitionBy(*keys).orderBy(o, *tie)
    d = d.withColumn("_back", F.collect_list("_item").over(w.rowsBetween(-n, -1)))
    if slices is not None:
        # the last n rows of each slice, then those of the n slices before it
        late = Window.partitionBy(*by, "_slice").orderBy(*[F.desc(c) for c in (t, *tie)])
        ends = (
            d.where("_hot and _slice >= 0")
            .select(*by, t, *tie, "_slice", "_item")
            .withColumn("_i", F.row_number().over(late))
            .where(F.col("_i") <= n)
            .groupBy(*by, "_slice")
            .agg(F.sort_array(F.collect_list(F.struct(-F.col("_i"), "_item"))).alias("_end"))
        )
        before = Window.partitionBy(*by).orderBy("_slice").rowsBetween(-n, -1)
        carry = ends.select(
            *by,
            "_slice",
            F.flatten(F.collect_list(F.col("_end._item")).over(before)).alias("_ends"),
        )
        d = d.join(F.broadcast(carry), [*by, "_slice"], "left")
        joined = F.concat(F.coalesce("_ends", F.array()), "_back")
        skip = F.greatest(F.size(joined) - n, F.lit(0))
        d = d.withColumn("_back", F.slice(joined, skip + 1, n))
    earlier = F.filter("_back", lambda r: r["t"] < F.col(t))
    d = d.withColumn(name, F.when(ok, earlier).otherwise(F.filter("_back", lambda r: F.lit(False))))
    return d.select(*[F.col(c) for c in df.columns], name)


def recent_stats(df: DataFrame, x: str, name: str, recent: str = "recent") -> DataFrame:
    """Sum, mean and median of one field of a `last_n` array; null when it is empty."""
    values = F.filter(F.transform(recent, lambda r: r[x].cast("double")), lambda v: v.isNotNull())
    n = F.size(values)
    summed = F.aggregate(values, F.lit(0.0), lambda a, v: a + v)
    ordered = F.array_sort(values)
    low = F.get(ordered, F.floor((n - 1) / 2).cast("int"))
    high = F.get(ordered, F.floor(n / 2).cast("int"))
    return df.withColumns(
        {
            f"{name}_total": F.when(n > 0, summed),
            f"{name}_mean": F.when(n > 0, summed / n),
            f"{name}_median": F.when(n > 0, (low + high) / 2),
        }
    )


def gap_seconds(
    df: DataFrame, by: list[str], t: str, tie: list[str], name: str,
    slice_rows: int | None = None,
) -> DataFrame:
    """Whole seconds since the previous row of the key; null for the first."""
    d, keys, helpers = placed(settled(df, by), by, t)
    d, o, extra = timed(d, by, t)
    slices = slices_for(d, by, o, slice_rows)
    ok = not_null([*by, t])
    second = F.unix_seconds(t)
    if slices is None:
        w = Window.partitionBy(*keys).orderBy(o, *tie)
        d = d.withColumn(name, F.when(ok, second - F.lag(second).over(w)))
        return d.drop(*helpers, *extra)
    d, at, slices = tied(d, by, o, tie, slices, slice_rows)
    cut = slices.assign(d, at)
    w = Window.partitionBy(*keys, "_slice").orderBy(o, *tie)
    ends = cut.where("_hot").groupBy(*by, "_slice").agg(F.max(t).alias("_end"))
    before = Window.partitionBy(*by).orderBy("_slice")
    carry = ends.select(*by, "_slice", F.lag("_end").over(before).alias("_end"))
    d = cut.withColumn("_prev", F.lag(t).over(w)).join(
        F.broadcast(carry), [*by, "_slice"], "left"
    )
    prev = F.unix_seconds(F.coalesce("_prev", "_end"))
    d = d.withColumn(name, F.when(ok, second - prev))
    return d.select(*[F.col(c) for c in df.columns], name)


def until_first(
    df: DataFrame, by: list[str], t: str, success: Column, keep_without: bool = True,
    cutoff: str = "cutoff_time",
) -> DataFrame:
    """Keep each key's rows up to its first success.

    A key without success keeps all its rows, or none when ``keep_without`` is
    False.
    """
    first = F.min(F.when(success, F.col(t)))
    d = group_transform(df, by, {"_first": first, "_last": F.max(t)}, t)
    stop = F.coalesce("_first", "_last") if keep_without else F.col("_first")
    d = d.withColumn(cutoff, stop).where(F.col(t) <= F.col(cutoff))
    return d.drop("_first", "_last")


def user_flag(
    df: DataFrame, by: list[str], t: str, success: Column, name: str = "user_flag"
) -> DataFrame:
    """'RU' for rows strictly after the key's first success, else 'NU'."""
    d = group_transform(df, by, {"_first": F.min(F.when(success, F.col(t)))}, t)
    repeat = F.col(t) > F.col("_first")
    return d.withColumn(name, F.when(repeat, "RU").otherwise("NU")).drop("_first")


def age_tag(lag_hours: str, lo: float = 48, hi: float = 2160) -> Column:
    """'old' when the lag lies in [lo, hi] hours, else 'new' (also when unknown)."""
    return F.when(F.col(lag_hours).between(lo, hi), "old").otherwise("new")
