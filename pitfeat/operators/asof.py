"""Joins as of a time: the latest right row at or before each left row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitfeat.limits import not_null
from pitfeat.operators.slices import max_of, plan_slices, running

MICROS = 1_000_000


def latest_before(
    left: DataFrame,
    right: DataFrame,
    by: list[str],
    at: Column,
    of: Column,
    tie: list[str],
    payload: list[str],
    slice_rows: int | None = None,
) -> DataFrame:
    """Left rows plus ``_found``: the right row with the largest ``of`` <= ``at``.

    Both sides go into one time line per key and a running maximum carries the
    latest right row forward: no row pairs are formed, whatever the densities.
    """
    order = [F.col(c).alias(f"_tie{i}") for i, c in enumerate(tie)]
    found = F.struct(of.alias("_at"), *order, *[F.col(c) for c in payload])
    facts = right.where(not_null(by) & of.isNotNull()).select(
        *by, of.alias("_o"), found.alias("_right")
    )
    probes = left.select(*by, at.alias("_o"), F.struct(*left.columns).alias("_left"))
    line = probes.unionByName(facts, allowMissingColumns=True)
    slices = plan_slices(line, by, "_o", slice_rows)
    line = running(
        line, by, "_o", {"_found": max_of(F.col("_right"))}, slices, inclusive=True
    )
    return line.where(F.col("_left").isNotNull()).select("_left.*", "_found")


def _payload(left: DataFrame, right: DataFrame, by: list[str], prefix: str) -> dict[str, str]:
    names = {c: f"{prefix}{c}" for c in right.columns if c not in by}
    clash = set(names.values()) & set(left.columns)
    if clash:
        raise ValueError(f"columns on both sides, give a prefix: {sorted(clash)}")
    return names


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: list[str],
    t_left: str,
    t_right: str,
    tolerance_s: float | None = None,
    tie: list[str] | None = None,
    prefix: str = "",
    slice_rows: int | None = None,
) -> DataFrame:
    """Join to each left row the latest right row of its key, at most ``tolerance_s`` older.

    An equal time matches, and so does a distance of exactly the tolerance.
    Among right rows of equal time the largest ``tie`` wins. Left rows without a
    match keep nulls; null keys and times never match.
    """
    names = _payload(left, right, by, prefix)
    d = latest_before(
        left, right, by, F.unix_micros(t_left), F.unix_micros(t_right),
        tie or [], list(names), slice_rows,
    )
    if tolerance_s is not None:
        near = F.unix_micros(t_left) - F.col("_found._at") <= int(tolerance_s * MICROS)
        d = d.withColumn("_found", F.when(near, F.col("_found")))
    return d.select(
        *left.columns, *[F.col("_found")[c].alias(n) for c, n in names.items()]
    )


def banded_nearest(
    left: DataFrame,
    right: DataFrame,
    by: list[str],
    t_left: str,
    t_right: str,
    lo_hours: float = 48,
    hi_hours: float = 2160,
    tie: list[str] | None = None,
    prefix: str = "",
    keep_ties: bool = False,
    slice_rows: int | None = None,
) -> DataFrame:
    """Join the right row with the smallest lag in [lo, hi] hours, counted in whole seconds.

    The nearest row at least ``lo`` back is the latest row as of ``t - lo``, so
    this is an as-of join with a shifted probe. ``duration_hours`` holds the lag
    and ``lag_band`` is 'matched', 'recent' (only rows nearer than ``lo``),
    'stale' (only rows older than ``hi``) or 'none'. Every left row is kept;
    ``keep_ties`` returns one row for each right row at the smallest lag.
    """
    names = _payload(left, right, by, prefix)
    now, then = F.unix_seconds(t_left), F.unix_seconds(t_right)
    lo, hi = int(lo_hours * 3600), int(hi_hours * 3600)
    d = latest_before(
        left, right, by, now - lo, then, tie or [], list(names), slice_rows
    )
    lag = now - F.col("_found._at")
    d = d.withColumn("_stale", lag > hi)
    d = d.withColumn("_found", F.when(lag <= hi, F.col("_found")))
    # a row nearer than `lo` exists if the latest row as of now is that near
    base = d.withColumnRenamed("_found", "_match")
    base = latest_before(base, right, by, now, then, [], [], slice_rows)
    recent = (now - F.col("_found._at")) < lo
    band = (
        F.when(F.col("_match").isNotNull(), "matched")
        .when(recent, "recent")
        .when(F.col("_stale"), "stale")
        .otherwise("none")
    )
    hours = (now - F.col("_match._at")) / 3600
    if not keep_ties:
        return base.select(
            *left.columns,
            *[F.col("_match")[c].alias(n) for c, n in names.items()],
            hours.alias("duration_hours"),
            band.alias("lag_band"),
        )
    base = base.select(
        *left.columns, hours.alias("duration_hours"), band.alias("lag_band"),
        F.col("_match._at").alias("_at"),
    )
    right = right.select(*by, then.alias("_at"), *[F.col(c).alias(n) for c, n in names.items()])
    return base.join(right, [*by, "_at"], "left").select(
        *left.columns, *names.values(), "duration_hours", "lag_band"
    )
