"""Small helpers that the corpus operators share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACES = "[\\x20\\x09-\\x0D]+"


def column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def whole(text: str | Column) -> Column:
    """The text, null read as empty."""
    return F.coalesce(column(text), F.lit(""))


def words_of(text: Column, separators: str) -> Column:
    """Non-empty pieces between separators; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), separators), lambda w: w != "")


def ascii_lower(text: Column) -> Column:
    """A-Z only, so that lengths and other letters stay as they are."""
    return F.translate(text, UPPER, UPPER.lower())


def id_bucket(row_id: str | Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    return F.crc32(F.coalesce(column(row_id).cast("string"), F.lit(""))) % modulus


def bounded(df: DataFrame, rows: int) -> bool:
    """Whether the frame has at most so many rows; counting stops one beyond."""
    return df.limit(rows + 1).count() <= rows


def most_frequent(counted: DataFrame, count: str, most: int) -> DataFrame:
    """Rows above the least count that leaves at most ``most`` of them; reads ``counted`` twice or thrice.

    A histogram of powers of two, then one of the counts inside the power where the
    limit falls, give that count, so no task and not the driver ever holds more rows
    than are asked for. Rows at the count where the limit falls are all left out.
    """
    power = F.floor(F.log2(F.col(count).cast("double"))).cast("int")
    powers = counted.groupBy(power.alias("p")).agg(F.count("*").alias("n")).orderBy(F.desc("p")).collect()
    taken = 0
    for row in powers:
        if taken + row.n > most:
            break
        taken += row.n
    else:
        return counted
    # of one power there are few counts where it is high and few rows share a task's count where it is low
    inside = counted.where(power == row.p).groupBy(F.col(count).alias("c")).agg(F.count("*").alias("n"))
    above = Window.orderBy(F.desc("c")).rowsBetween(Window.unboundedPreceding, 0)
    inside = inside.withColumn("_up_to", F.sum("n").over(above)).where(F.col("_up_to") <= most - taken)
    least = inside.agg(F.min("c")).first()[0]
    return counted.where(F.col(count) >= least if least is not None else power > row.p)


def to_table(df: DataFrame, order: list[tuple[str, str]]) -> pa.Table:
    """A bounded frame on the driver as Arrow columns, sorted there."""
    return df.toArrow().sort_by(order)


def handing_back(run: Callable) -> Callable:
    """A function of batches that hands freed memory back when its task ends.

    Workers stay for later tasks and stages; what they have freed but keep counts
    against the memory of the executor.
    """
    def whole_task(batches):
        yield from run(batches)
        hand_back()

    return whole_task


def hand_back() -> None:
    """Give memory that is free, but kept, to the machine."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def keep_freed() -> None:
    """Let glibc keep freed arrays for the next ones, up to 64 MB, rather than get each page anew.

    These are the bounds that it grows to by itself, sooner or later, with the sizes it sees.
    """
    set_option = getattr(ctypes.CDLL(None), "mallopt", None)
    if set_option is not None:
        set_option(-3, 32 << 20)  # M_MMAP_THRESHOLD
        set_option(-1, 64 << 20)  # M_TRIM_THRESHOLD


def sized_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
