"""Bounded, labelled samples for the byte networks, and their use on whole tables."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pitfeat.llm.byteconv import LENGTH, ByteConv, windows
from pitfeat.llm.common import handing_back, whole

#: documents per class and windows per document that training may see
DOCUMENTS = 1500
WINDOWS = 4
#: texts that a task judges at a time
SLICE = 512


def share_of_class(rows: DataFrame, key: str, label: str, documents: int = DOCUMENTS) -> DataFrame:
    """``documents`` rows of each class, all of a smaller one, chosen by a hash of row number and key.

    The row number spreads copies and null keys. Classes are counted first (few
    columns, combined before the shuffle), so one more pass can pick from all
    classes at once; it picks a few too many, which are ranked in their class.
    """
    counts = rows.groupBy(label).agg(F.count("*").alias("_n")).select(F.col(label).alias("_class"), "_n")
    hashed = rows.withColumn("_place", F.xxhash64(F.monotonically_increasing_id(), F.col(key).cast("string")))
    enough = documents + 5 * documents**0.5 + 10
    near = hashed.join(F.broadcast(counts), F.col(label) == F.col("_class")).where(
        F.pmod("_place", F.lit(1_000_000)) / 1e6 < F.lit(enough) / F.col("_n"))
    rank = F.row_number().over(Window.partitionBy(label).orderBy("_place"))
    return near.select(*rows.columns, rank.alias("_rank")).where(F.col("_rank") <= documents).drop("_rank")


def judged(docs: DataFrame, keep: list[str], text: str, added: list[tuple[str, str]],
           judge: Callable[[list[str | None]], tuple[list[pa.Array], list[bool] | None]]) -> DataFrame:
    """The kept columns and what ``judge`` adds for a list of texts; no shuffle.

    ``judge`` may also say which rows stay. A text that is kept travels to Python
    once, and is judged in slices of a batch, so one copy of a batch is held.
    """
    kept = docs.select(*keep)
    place = keep.index(text) if text in keep else len(keep)
    read = kept if place < len(keep) else docs.select(*keep, F.col(text).alias("_text_read"))
    names = [*keep, *(n for n, _ in added)]

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, SLICE):
                part = b.slice(at, SLICE)
                arrays, stay = judge(part.column(place).to_pylist())
                out = pa.RecordBatch.from_arrays([*part.columns[:len(keep)], *arrays], names)
                yield out if stay is None else out.filter(pa.array(stay, pa.bool_()))

    schema = StructType(list(kept.schema.fields))
    for name, kind in added:
        schema.add(name, kind)
    return read.mapInArrow(handing_back(run), schema)


def class_counts(rows: DataFrame, label: str) -> dict:
    return {r[0]: r[1] for r in rows.groupBy(label).count().collect()}


def sampled_windows(rows: DataFrame, text: str, label: str, seed: int = 5) -> list[tuple[object, np.ndarray, np.ndarray]]:
    """(label, windows, bytes in each) of sampled rows, brought to the driver.

    Of a longer text WINDOWS windows are drawn from all its windows, so at most
    rows * WINDOWS * LENGTH bytes arrive.
    """
    kind = rows.schema[label].dataType.simpleString()

    def run(batches):
        for b in batches:
            data, sizes = [], []
            for t in b.column("text").to_pylist():
                raw = t.encode()
                v, n = windows(raw)
                if len(v) > WINDOWS:
                    pick = np.sort(np.random.default_rng((seed, len(raw))).choice(len(v), WINDOWS, replace=False))
                    v, n = v[pick], n[pick]
                data.append(np.ascontiguousarray(v).tobytes())
                sizes.append(n.astype(int).tolist())
            yield pa.RecordBatch.from_arrays(
                [b.column("label"), pa.array(data, pa.binary()), pa.array(sizes, pa.list_(pa.int32()))],
                ["label", "windows", "sizes"])

    part = rows.select(F.col(label).alias("label"), whole(text).alias("text"))
    got = part.mapInArrow(run, f"label {kind}, windows binary, sizes array<int>").collect()
    # the order in which tasks end must not matter
    got.sort(key=lambda r: (bytes(r.windows), str(r.label)))
    return [(r.label, np.frombuffer(r.windows, np.uint8).reshape(-1, LENGTH), np.array(r.sizes, np.float32)) for r in got]


def fitted(sample, counts: dict, updates: int = 500) -> tuple[ByteConv | None, list]:
    """A network trained on the sample, its offsets moved to the true class shares."""
    names = sorted({label for label, _, _ in sample}, key=str)
    if not names:
        return None, []
    net = ByteConv.start(len(names))
    place = {name: i for i, name in enumerate(names)}
    labels = np.array([place[label] for label, _, _ in sample])
    net.fit([(v, s) for _, v, s in sample], labels, updates)
    seen = np.bincount(labels, minlength=len(names))
    true = np.array([max(1, counts.get(n, 1)) for n in names])
    net.offset += np.log(true / true.sum()).astype(np.float32) - np.log(seen / seen.sum()).astype(np.float32)
    return net, names
