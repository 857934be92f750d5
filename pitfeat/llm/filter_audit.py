"""How filters that are applied one after another interact.

Every text is judged once by every filter; its failures are a bit mask. Rows are
then counted by part and mask, so all orders of all filters follow from 2**f
counts a part, whatever the size of the corpus.

Orders are paths through the lattice of subsets: a state is the set of filters
already applied, an edge applies one more. A forward pass counts the paths that
reach a state, a backward pass those that leave it for the full set. An edge
removes the rows that fail its filter and none of its state's, and lies on
(forward of its state) x (backward of the next) orders; with these weights the
removals of a filter add up to its Shapley value times the number of orders. The
steps of each single order are read from the same edges.

Copies: a row fails ``copy`` if a smaller id has the same text anywhere. Rows meet
by a digest of the text, after equal rows were combined; the smallest id of a
digest is a partial minimum, and joins on (digest, id), so no group of copies
comes together in one task.

Defined cases: null texts are empty, null parts the empty string. A null id is
never a copy, nor does it make one, and has no label. Labels of a repeated id
count if any of them is 1. Repeated rows of one id count each, and are not copies
of each other. An empty table has no parts. Texts meet by a 128-bit digest: among
10**10 texts two different ones agree by chance with probability below 10**-18.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitfeat.checkpoints import cut_lineage
from pitfeat.llm.common import whole

_UPPER = bytes(range(65, 91))
_MARKS = b"#$%&*|"

#: failure conditions by letter, on the text as bytes, its words and its length in code points.
#: ``bytes.split`` cuts at exactly the six ASCII spaces, which no longer character contains.
RULES: dict[str, Callable[[bytes, list[bytes], int], bool]] = {
    "A": lambda raw, words, size: len(words) < 200,
    "B": lambda raw, words, size: 100 * len(set(words)) < 50 * len(words),
    "C": lambda raw, words, size: 100 * (len(raw) - len(raw.translate(None, _UPPER))) > 2 * size,
    "D": lambda raw, words, size: len(raw.translate(None, _MARKS)) < len(raw),
}
#: the filter against copies, which looks at the whole table
COPY = "E"
#: spreads null ids over so many partitions when labels are joined
SPREAD = 1024


# ---- the lattice

def paths(filters: int) -> tuple[list[int], list[int]]:
    """Orders that reach each state from the empty one, and that lead from it to the full one."""
    size = 1 << filters
    forward, backward = [0] * size, [0] * size
    forward[0] = backward[size - 1] = 1
    for state in range(size):
        for f in range(filters):
            if not state >> f & 1:
                forward[state | 1 << f] += forward[state]
    for state in reversed(range(size)):
        for f in range(filters):
            if not state >> f & 1:
                backward[state] += backward[state | 1 << f]
    return forward, backward


def edge_sums(counts: np.ndarray, filters: int) -> tuple[np.ndarray, np.ndarray]:
    """From counts by mask (last axis): rows that pass all filters of a state, and rows that
    each edge (state, filter) removes."""
    size = 1 << filters
    masks = np.arange(size)
    passed = np.stack([counts[..., (masks & state) == 0].sum(-1) for state in masks], -1)
    # an edge removes what its state still passes and the next one does not
    removed = np.zeros((*counts.shape[:-1], size, filters), np.int64)
    for state in masks:
        for f in range(filters):
            if not state >> f & 1:
                removed[..., state, f] = passed[..., state] - passed[..., state | 1 << f]
    return passed, removed


# ---- masks

def judged(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source",
           rules: dict = RULES) -> DataFrame:
    """doc_id, part, digest of the text and the mask of failed rules, a bit each; no shuffle."""
    kind = docs.schema[doc_id].dataType.simpleString()
    names = list(rules)

    def run(batches):
        tests = [rules[n] for n in names]
        for b in batches:
            masks, digests = [], []
            for t in b.column("_text"):
                t = t.as_py()
                raw = t.encode()
                words = raw.split()
                masks.append(sum(test(raw, words, len(t)) << k for k, test in enumerate(tests)))
                digests.append(hashlib.blake2b(raw, digest_size=16).digest())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("part"), pa.array(digests, pa.binary()), pa.array(masks, pa.int32())],
                ["doc_id", "part", "digest", "mask"])

    read = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                       whole(text).alias("_text"))
    return read.mapInArrow(run, f"doc_id {kind}, part string, digest binary, mask int")


def mask_counts(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                part: str = "source", rules: dict = RULES) -> DataFrame:
    """part, mask, and how many rows, good rows and toxic rows fail exactly the mask's filters.

    The copy filter takes the bit after those of the rules.
    """
    rows = cut_lineage(judged(docs, doc_id, text, part, rules).groupBy("doc_id", "part", "digest", "mask").agg(
        F.count("*").alias("n")))
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).where(F.col("doc_id").isNotNull()).withColumn(
        "first", F.lit(True))
    marked = rows.join(first, ["digest", "doc_id"], "left")
    copied = F.col("first").isNull() & F.col("doc_id").isNotNull()
    marked = marked.withColumn("mask", F.col("mask") + F.when(copied, 1 << len(rules)).otherwise(0))
    # ids with a mark are all that a label can touch; the rest is counted without a join
    marks = labels.where(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
    ).withColumn("_spread", F.lit(0))
    spread = F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("digest"), F.lit(SPREAD)).cast("int")).otherwise(0)
    labelled = marked.withColumn("spread", spread).join(
        marks, (F.col("doc_id") == F.col("_id")) & (F.col("spread") == F.col("_spread")), "left")
    return labelled.groupBy("part", "mask").agg(
        F.sum("n").alias("rows"), F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"))


# ---- the report

def audit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source",
          rules: dict = RULES) -> DataFrame:
    """A row for each part, order of the filters and step of it.

    kept: rows after the step; removed: by the step; redundant: fail its filter but were
    removed earlier; unique_fails: fail its filter only; good_lost, toxic_lost: removed
    rows with such a label; shapley: removals of the step's filter added up over all orders.
    """
    letters = [*rules, COPY]
    filters, size = len(letters), 1 << len(letters)
    forward, backward = paths(filters)
    orders = list(permutations(range(filters)))
    # the edge that each step of each order takes
    states = np.array([[sum(1 << f for f in o[:k]) for k in range(filters)] for o in orders]).ravel()
    taken = np.array(orders).ravel()
    names = ["".join(letters[f] for f in o) for o in orders for _ in range(filters)]
    steps = np.tile(np.arange(1, filters + 1), len(orders))
    weight = np.array([[0 if s >> f & 1 else forward[s] * backward[s | 1 << f] for f in range(filters)]
                       for s in range(size)])
    masks = np.arange(size)
    fails = np.array([(masks >> f & 1) == 1 for f in range(filters)])

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                counts = np.array([b.column(c)[i].as_py() for c in ("rows", "good", "toxic")], np.int64)
                passed, removed = edge_sums(counts, filters)
                edge = removed[:, states, taken]
                failing = fails.astype(np.int64) @ counts[0]
                columns = [
                    passed[0, states | 1 << taken], edge[0], failing[taken] - edge[0], counts[0, 1 << taken],
                    edge[1], edge[2], (removed[0] * weight).sum(0)[taken]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b.column("part")[i].as_py()] * len(names)), pa.array(names), pa.array(steps, pa.int32()),
                     *[pa.array(c, pa.int64()) for c in columns]],
                    ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
                     "toxic_lost", "shapley"])

    cells = mask_counts(docs, labels, doc_id, text, part, rules)
    by_mask = lambda c: F.array(*[
        F.sum(F.when(F.col("mask") == m, F.col(c)).otherwise(0)) for m in range(size)]).alias(c)
    tables = cells.groupBy("part").agg(*[by_mask(c) for c in ("rows", "good", "toxic")])
    return tables.mapInArrow(
        run, "part string, filter_order string, step int, kept long, removed long, redundant long, "
             "unique_fails long, good_lost long, toxic_lost long, shapley long")
