"""Exact medians over growing or sliding histories of any length.

Values become ranks, and every question "which value has k smaller ones before
time t?" walks down the digits of the rank. One step counts, per digit, the
earlier facts under the current prefix with a running sum, which `running`
keeps parallel inside a hot key. The number of steps is the number of base-16
digits of the largest rank; nothing is gathered per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitfeat.checkpoints import cut_lineage
from pitfeat.limits import not_null
from pitfeat.operators.slices import count_of, plan_slices, running, sum_of

DIGIT_BITS = 4
DIGITS = 1 << DIGIT_BITS


def before_medians(
    facts: DataFrame, probes: DataFrame, by: list[str], slice_rows: int | None = None
) -> DataFrame:
    """Median of the values present strictly before each probe.

    ``facts`` has the key, ``_at`` (long), ``_x`` (double) and ``_w``: +1 when the
    value appears, -1 when it goes. ``probes`` has distinct (key, ``_at``). The
    result has key, ``_at`` and ``_median``; probes without values are left out.
    """
    ok = not_null([*by, "_at"])
    # equal values that come or go at one moment are one fact
    facts = facts.where(ok & F.col("_x").isNotNull()).groupBy(*by, "_at", "_x").agg(F.sum("_w").alias("_w"))
    facts = cut_lineage(facts.where("_w <> 0"))
    probes = probes.where(ok)
    values = facts.select(*by, "_x").distinct()
    values = running(
        values, by, "_x", {"_r": count_of(F.col("_x"))},
        plan_slices(values, by, "_x", slice_rows), unique=True,
    )
    ranked = cut_lineage(
        facts.join(values, [*by, "_x"]).select(*by, "_at", "_w", F.col("_r").cast("long"))
    )
    values = cut_lineage(values)
    top = values.agg(F.max("_r")).first()[0]
    asks = _present(ranked, probes, by, slice_rows).where("_n > 0").select(
        *by,
        "_at",
        # the one or two middle ranks
        F.explode(F.array_distinct(F.array(F.expr("(_n - 1) div 2"), F.expr("_n div 2")))).alias(
            "_k"
        ),
        F.lit(0).cast("long").alias("_node"),
    )
    levels = max(1, -(-int(top or 0).bit_length() // DIGIT_BITS))
    for level in reversed(range(levels)):
        asks = cut_lineage(_descend(ranked, asks, by, level, slice_rows))
    found = asks.join(values.withColumnRenamed("_r", "_node"), [*by, "_node"])
    return found.groupBy(*by, "_at").agg(F.avg("_x").alias("_median"))


def _present(ranked, probes, by, slice_rows):
    line = probes.withColumn("_probe", F.lit(True)).unionByName(
        ranked.select(*by, "_at", "_w"), allowMissingColumns=True
    )
    slices = plan_slices(line, by, "_at", slice_rows)
    line = running(line, by, "_at", {"_n": sum_of(F.col("_w"))}, slices)
    return line.where("_probe").select(*by, "_at", "_n")


def _descend(ranked, asks, by, level, slice_rows):
    """Move every question from its prefix to the child that holds its answer."""
    digit = F.shiftright("_r", level * DIGIT_BITS).bitwiseAND(DIGITS - 1)
    facts = ranked.select(
        *by,
        F.shiftright("_r", (level + 1) * DIGIT_BITS).alias("_node"),
        "_at",
        "_w",
        digit.alias("_digit"),
    )
    line = asks.unionByName(facts, allowMissingColumns=True)
    node = [*by, "_node"]
    # earlier facts whose digit is at most i
    upto = {
        f"_n{i}": sum_of(F.when(F.col("_digit") <= i, F.col("_w"))) for i in range(DIGITS - 1)
    }
    line = running(line, node, "_at", upto, plan_slices(line, node, "_at", slice_rows))
    line = line.where(F.col("_digit").isNull())
    counts = F.array(*[F.coalesce(F.col(c), F.lit(0)) for c in upto])
    line = line.withColumn("_below", F.filter(counts, lambda n: n <= F.col("_k")))
    child = F.size("_below")
    skipped = F.coalesce(F.get("_below", child - 1), F.lit(0))
    return line.select(
        *by,
        "_at",
        (F.col("_k") - skipped).alias("_k"),
        (F.col("_node") * DIGITS + child).alias("_node"),
    )
