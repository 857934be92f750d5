"""Token counts from pre-token frequencies, without ids.

A byte-level BPE merges inside pre-tokens only, so a text has as many tokens as
its pre-tokens have pieces. Each distinct pre-token is therefore counted once
and joined to the frequencies per document.

The join is split by frequency. Frequent pre-tokens, at most HEAD of them, are
counted first and sent to all tasks, which sum them while they read; this takes
the hot keys out of the shuffle. The others travel as (row, pre-token, n), meet
their piece count in a join on the pre-token, and are summed per row. Which
pre-tokens are in the head comes from a hashed share of the texts and changes
only what is shuffled, never a count.

Rows are numbered by their place in the input, so ``docs`` should be a table, a
scan or a checkpointed frame, as those give a recomputed task the same rows.

Defined cases: null and empty texts have 0 bytes and 0 tokens. Repeated rows
each get a row; a null id stays null. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitfeat.checkpoints import cut_lineage
from pitfeat.llm.common import most_frequent, whole
from pitfeat.llm.pretokens import splitter

#: most pre-tokens in the table that every task holds; about 40 MB
HEAD = 1 << 18
#: one text in so many is read to choose them
HEAD_SHARE = 8
LIMIT = 512


def frequencies(path: str, text: str) -> tuple[Counter, int]:
    """Pre-tokens of a text with their counts, and the number of special strings."""
    s = splitter(path)
    parts = s.sections(text)
    found: Counter = Counter()
    for plain in parts[::2]:
        found.update(s.split(plain))
    return found, len(parts) // 2


def count_pieces(path: str, pretokens: list[str]) -> list[int]:
    """Pieces of each pre-token, as the library cuts it."""
    encoded = splitter(path).tokenizer.encode_batch_fast(pretokens, add_special_tokens=False)
    return [len(e.ids) for e in encoded]


def _piece_table(distinct: DataFrame, path: str) -> DataFrame:
    def run(batches):
        for b in batches:
            token = b.column("token")
            yield pa.RecordBatch.from_arrays(
                [token, pa.array(count_pieces(path, token.to_pylist()), pa.int32())],
                ["token", "pieces"])

    return distinct.mapInArrow(run, "token string, pieces int")


def _head(texts: DataFrame, path: str) -> dict[str, int]:
    """The most frequent pre-tokens of a share of the texts, with their pieces."""
    def run(batches):
        for b in batches:
            found: Counter = Counter()
            for t in b.column("_text").to_pylist():
                found.update(frequencies(path, t)[0])
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())],
                ["token", "n"])

    part = texts.where(F.pmod(F.xxhash64("_text"), F.lit(HEAD_SHARE)) == 0).select("_text")
    often = part.mapInArrow(run, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))
    rows = _piece_table(most_frequent(cut_lineage(often), "n", HEAD).select("token"), path).toArrow()
    return dict(zip(rows["token"].to_pylist(), rows["pieces"].to_pylist()))


def token_counts(
    docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", limit: int = LIMIT
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row."""
    spark = docs.sparkSession
    kind = docs.schema[doc_id].dataType.simpleString()
    texts = docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("_text"))
    head = spark.sparkContext.broadcast(_head(texts, path))

    def run(batches):
        for b in batches:
            tails, sums = [], []
            for t in b.column("_text").to_pylist():
                found, total = frequencies(path, t)
                known, tail = head.value, []
                for token, n in found.items():
                    pieces = known.get(token)
                    if pieces is None:
                        tail.append({"token": token, "n": n})
                    else:
                        total += pieces * n
                sums.append(total)
                tails.append(tail)
            yield pa.RecordBatch.from_arrays(
                [b.column("_row"), b.column("doc_id"), b.column("n_bytes"), pa.array(sums, pa.int64()),
                 pa.array(tails, pa.list_(pa.struct([("token", pa.string()), ("n", pa.int32())])))],
                ["row", "doc_id", "n_bytes", "head", "tail"])

    numbered = texts.select(
        F.monotonically_increasing_id().alias("_row"), "doc_id",
        F.octet_length("_text").cast("long").alias("n_bytes"), "_text")
    # read three times below: rows, distinct pre-tokens, frequencies
    read = cut_lineage(numbered.mapInArrow(
        run, f"row long, doc_id {kind}, n_bytes long, head long, tail array<struct<token:string,n:int>>"))
    tail = read.select("row", F.explode("tail").alias("t")).select("row", "t.token", "t.n")
    pieces = _piece_table(tail.select("token").distinct(), path)
    rest = tail.join(pieces, "token").groupBy("row").agg(
        F.sum(F.col("n").cast("long") * F.col("pieces")).alias("rest"))
    total = F.col("head") + F.coalesce("rest", F.lit(0))
    return read.select("row", "doc_id", "n_bytes", "head").join(rest, "row", "left").select(
        "doc_id", "n_bytes", total.alias("n_tokens"), (total > limit).alias("over_limit"))
