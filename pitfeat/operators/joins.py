"""Equi-joins that assemble feature tables.

No side is forced into a broadcast: Catalyst broadcasts a side only when its
size is below ``spark.sql.autoBroadcastJoinThreshold``, and adaptive execution
re-checks that at run time and splits skewed keys.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitfeat.limits import dealt, limit, not_null


@dataclass(frozen=True)
class Dim:
    """A dimension table: its key columns match ``on`` of the fact, in order."""

    table: DataFrame
    key: list[str]
    on: list[str]
    columns: list[str]
    how: str = "left"


def enrich(df: DataFrame, dims: list[Dim]) -> DataFrame:
    """Star join: add the named columns of each dimension, inner or left."""
    for i, dim in enumerate(dims):
        keys = [f"_k{i}_{j}" for j in range(len(dim.key))]
        side = dim.table.where(not_null(dim.key)).select(
            *[F.col(c).alias(k) for c, k in zip(dim.key, keys)], *dim.columns
        )
        match = [F.col(c) == F.col(k) for c, k in zip(dim.on, keys)]
        df = df.join(side, match, dim.how).drop(*keys)
    return df


def assemble(base: DataFrame, on: list[str], parts: list[tuple[DataFrame, str]]) -> DataFrame:
    """Join feature tables to the base on its row id, each with its own join type."""
    for part, how in parts:
        base = base.join(part, on, how)
    return base


def assemble_bucketed(
    base: DataFrame, on: list[str], parts: list[tuple[DataFrame, str]]
) -> DataFrame:
    """`assemble` for tables stored in the same buckets of the row id, see `save_table`.

    Each join is a merge of buckets that lie in order already, so the chain reads
    every table once and moves no row. Without the hint a small part would be
    broadcast instead, at a size that nobody has checked.
    """
    return assemble(base.hint("merge"), on, [(part.hint("merge"), how) for part, how in parts])


def apply_lookup(
    df: DataFrame, lookup: DataFrame, column: str, name: str,
    key: str = "key", value: str = "value",
) -> DataFrame:
    """Translate a column through a key-value table; unknown keys give null."""
    pairs = lookup.where(F.col(key).isNotNull()).select(
        F.col(key).alias("_key"), F.col(value).alias(name)
    )
    return df.join(pairs, F.col(column) == F.col("_key"), "left").drop("_key")


def update_side(
    main: DataFrame, update: DataFrame, on: list[str], prefix: str = "main_"
) -> DataFrame:
    """Right outer join: every update row, with the prefixed columns of its main row."""
    old = main.select(
        *on, *[F.col(c).alias(f"{prefix}{c}") for c in main.columns if c not in on]
    )
    return old.join(update, on, "right")


def full_outer(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    return left.join(right, on, "outer")


def anti_join(df: DataFrame, other: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is not in ``other``; rows with a null key stay."""
    return df.join(other.select(*on), on, "left_anti")


def join_dealt(many: DataFrame, one: DataFrame, many_key: str, one_key: str) -> DataFrame:
    """Inner join on a key that is never frequent, in tasks of a bounded number of rows.

    ``many`` should be a table, as its rows are counted first.
    """
    on = F.col(many_key) == F.col(one_key)
    rows = many.count()
    if rows <= limit(many.sparkSession, "task.rows"):
        return many.join(one, on)
    return dealt(many, [many_key], rows).join(dealt(one, [one_key], rows), on)


def union_sources(parts: dict[str, DataFrame], source: str = "source") -> DataFrame:
    """Stack sources by column name and tag each row with where it came from."""
    out = None
    for tag, df in parts.items():
        df = df.withColumn(source, F.lit(tag))
        out = df if out is None else out.unionByName(df)
    return out


def concat_frames(*frames: DataFrame) -> DataFrame:
    """Stack frames by name; columns a frame lacks become null."""
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out
