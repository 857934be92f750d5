"""Labels that travel along shared identifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitfeat.checkpoints import cut_lineage
from pitfeat.limits import not_null
from pitfeat.operators.components import connected


def propagate_label(
    df: DataFrame, by: list[str], label: str, name: str | None = None
) -> DataFrame:
    """Label 1 on every row of a key that has a labelled row; nulls never match.

    The labelled keys are reduced to a distinct list first, so what is joined
    grows with the keys, not with the rows.
    """
    bad = df.where((F.col(label) == 1) & not_null(by)).select(*by).distinct()
    return mark(df, bad, by, label, name or label)


def mark(df: DataFrame, bad: DataFrame, by: list[str], label: str, name: str) -> DataFrame:
    hit = df.join(bad.withColumn("_bad", F.lit(1)), by, "left")
    value = F.greatest(F.coalesce("_bad", F.lit(0)), F.coalesce(label, F.lit(0)))
    out = hit.withColumn(name, value.cast("int")).drop("_bad")
    return out.select(*df.columns, *([] if name in df.columns else [name]))


def propagate_two_hop(
    df: DataFrame,
    person: str,
    device: str,
    label: str,
    name: str | None = None,
    rounds: int | None = 1,
) -> DataFrame:
    """Spread labels: bad rows taint their devices, those taint their persons.

    One round marks every row of a person seen on a tainted device. More rounds
    start from the persons marked so far; ``rounds=None`` marks all that any number
    of rounds would reach, by components of the graph of persons and devices, so a
    long chain costs the logarithm of its length. Rounds work on the distinct
    (person, device) pairs. Null persons and devices never match.
    """
    pairs = df.where(not_null([person, device])).select(person, device).distinct()
    seeds = df.where(F.col(label) == 1)
    persons = seeds.where(not_null([person])).select(person).distinct()
    # a bad row taints its device even when its person is unknown
    devices = seeds.where(not_null([device])).select(device).distinct()
    if rounds is None:
        persons = _reached(cut_lineage(pairs), persons, devices, person, device)
        return mark(df, persons, [person], label, name or label)
    if rounds > 1:
        pairs = cut_lineage(pairs)
    for done in range(rounds):
        if done:
            devices = pairs.join(persons, person, "left_semi").select(device).distinct()
        reached = pairs.join(devices, device, "left_semi").select(person)
        grown = reached.unionByName(persons).distinct()
        persons = cut_lineage(grown) if done + 1 < rounds else grown
    return mark(df, persons, [person], label, name or label)


def _reached(
    pairs: DataFrame, persons: DataFrame, devices: DataFrame, person: str, device: str
) -> DataFrame:
    """Persons connected with a bad person or device, and the bad persons themselves.

    Persons of a device are linked with the smallest of them, so devices are no nodes.
    """
    first = pairs.groupBy(device).agg(F.min(person).alias("_first"))
    found = connected(pairs.join(first, device).select(person, "_first"), person, "_first")
    roots = cut_lineage(found.select(F.col("node").alias(person), F.col("root").alias("_root")))
    bad = persons.unionByName(pairs.join(devices, device, "left_semi").select(person)).distinct()
    bad = cut_lineage(bad)
    tainted = roots.join(bad, person, "left_semi").select("_root").distinct()
    return roots.join(tainted, "_root", "left_semi").select(person).unionByName(bad).distinct()
