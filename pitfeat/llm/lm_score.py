"""Scoring texts with a language model learned from the corpus.

Word counts cover every training text and are joined to every word of every
text. The recurrent model knows the most frequent words one by one and the
others by bucket; within a bucket a word has its share of the counts, smoothed
like the base score, so a word never seen has a probability too.

Counts: tasks count their own words, which are then summed. The most frequent
words, at most HEAD, go to every task in one table; the others travel as (row,
word, n) and meet their count in a join.

Training: all training texts are dealt to trainers of about TRAINER texts by a
hash of row and text, so that copies spread evenly. A first trainer warms the
model up, then all go on from it at once and their weights are averaged, in
groups of FAN, weighted by tokens.

Defined cases: null and empty texts are the end token alone. Without a training
text all counts are 0. Rows are numbered by their place in the input, so
``docs`` should be a table, a scan or a checkpointed frame; repeated rows each
get a row. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitfeat.checkpoints import cut_lineage
from pitfeat.llm.common import hand_back, handing_back, keep_freed, most_frequent, to_table, whole
from pitfeat.llm.gru import Gru

#: words in the table that every task holds; about 35 MB
HEAD = 1 << 18
#: words that a task holds while it counts; about 45 MB
COUNTED = 1 << 18
#: words the model tells apart, and buckets of the others
KNOWN, BUCKETS = 1500, 32
#: texts of one trainer; weights averaged at once
TRAINER, FAN = 1000, 16


def tokens(text: str) -> list[bytes]:
    """``bytes.split`` cuts at exactly the six ASCII spaces, ``bytes.lower`` changes A-Z only."""
    return text.encode().lower().split()


def bucket(word: bytes) -> int:
    """Rare words by their last two bytes."""
    return zlib.crc32(word[-2:]) % BUCKETS


def _bucket(word: Column) -> Column:
    start = F.greatest(F.octet_length(word) - 1, F.lit(1))
    return (F.crc32(F.substring(word, start, F.lit(2))) % BUCKETS).cast("int")


def word_counts(texts: DataFrame) -> DataFrame:
    """word (lower-case bytes) and c over all texts."""
    counted = texts.select("_text").mapInArrow(handing_back(_count_words), "word binary, c long")
    return counted.groupBy("word").agg(F.sum("c").alias("c"))


def _count_words(batches, most: int = COUNTED):
    """Counts of batches of texts, let go whenever ``most`` words are held."""
    found: Counter = Counter()
    for b in batches:
        for t in b.column("_text"):
            found.update(tokens(t.as_py()))
            if len(found) >= most:
                yield _counted(found)
                found = Counter()
    if found:
        yield _counted(found)


def _counted(found: Counter) -> pa.RecordBatch:
    words = pa.array(found.keys(), pa.binary(), size=len(found))
    return pa.RecordBatch.from_arrays([words, pa.array(found.values(), pa.int64(), size=len(found))], ["word", "c"])


class Lexicon:
    """Frequent words with their counts, and the totals that the scores need."""

    def __init__(self, head: list[tuple[bytes, int]], texts: int, total: int, distinct: int,
                 rare: dict[int, tuple[int, int]]):
        self.index = {w: i for i, (w, _) in enumerate(head)}
        counts = np.array([c for _, c in head], np.float64)
        known = min(KNOWN, len(head))
        self.log = np.log10(counts + 0.1)
        #: symbols: the end, known words, then buckets
        self.known = known + 1
        self.symbol = np.array(
            [1 + i if i < known else self.known + bucket(w) for i, (w, _) in enumerate(head)], np.int32)
        self.texts, self.total = texts, total + texts
        self.distinct = distinct + (texts > 0)
        self.base_norm = np.log10(self.total + 0.1 * (self.distinct + 1))
        for w, c in head[:known]:
            n, v = rare[bucket(w)]
            rare[bucket(w)] = (n - c, v - 1)
        self.rare = np.array([rare.get(b, (0, 0)) for b in range(BUCKETS)], np.float64)
        self.rare_norm = np.log10(self.rare[:, 0] + 0.1 * (self.rare[:, 1] + 1))
        self.known_counts = np.concatenate(([texts], counts[:known]))

    def symbols(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Symbol of each word, and its place in the table or -1."""
        at = np.fromiter(map(self.index.get, words, repeat(-1)), np.int32, len(words))
        out = self.symbol[at] if len(self.symbol) else np.zeros(len(words), np.int32)
        for i in np.flatnonzero(at < 0).tolist():
            out[i] = self.known + bucket(words[i])
        return out, at


def lexicon(counts: DataFrame, texts: int, head: int = HEAD) -> Lexicon:
    rows = to_table(most_frequent(counts, "c", head), [("c", "descending"), ("word", "ascending")])
    often = list(zip(rows["word"].to_pylist(), rows["c"].to_pylist()))
    totals = counts.groupBy(_bucket(F.col("word")).alias("b")).agg(
        F.sum("c").alias("n"), F.count("*").alias("v")).collect()
    return Lexicon(often, texts, sum(r.n for r in totals), sum(r.v for r in totals),
                   {r.b: (r.n, r.v) for r in totals})


# ---- training

def train(texts: DataFrame, lex, trainer: int = TRAINER) -> Gru:
    """A model trained on all the texts; ``lex`` is a broadcast Lexicon."""
    start = Gru.start(lex.value.known_counts, lex.value.rare[:, 0])
    trainers = max(1, round(lex.value.texts / trainer))
    place = F.xxhash64(F.monotonically_increasing_id(), "_text")
    dealt = texts.select("_text", F.pmod(place, F.lit(trainers)).cast("int").alias("trainer"))
    first = _average(_trained(dealt.where("trainer = 0"), start, lex, 3), 1)
    if first is None and trainers > 1:
        some = dealt.agg(F.min("trainer")).first()[0]
        first = _average(_trained(dealt.where(F.col("trainer") == some), start, lex, 3), 1)
    if first is None:
        return start
    model = start.unpack(first)
    model.unpack(_average(_trained(dealt, model, lex, 2), trainers))
    return model


def _trained(dealt: DataFrame, model: Gru, lex, passes: int) -> DataFrame:
    """Per trainer: its number, the tokens it saw and its weights."""
    sent = dealt.sparkSession.sparkContext.broadcast(model)

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        keep_freed()
        texts = [lex.value.symbols(tokens(t))[0] for t in pdf["_text"]]
        own = _copy(sent.value)
        seen = 0
        for k in range(passes):
            seen += own.train(texts, rate=6e-3 / (1 + k), seed=k)
        done = pd.DataFrame({"trainer": [key[0]], "tokens": [float(seen)], "weights": [own.packed().tobytes()]})
        hand_back()
        return done

    return dealt.groupBy("trainer").applyInPandas(run, "trainer int, tokens double, weights binary")


def _copy(model: Gru) -> Gru:
    return Gru(model.known, model.buckets, *[p.copy() for p in model.parameters()])


def _average(trained: DataFrame, trainers: int) -> np.ndarray | None:
    """Mean of the weights by tokens, in a tree of groups of FAN."""
    def mean(pdf: pd.DataFrame) -> pd.DataFrame:
        total = pdf["tokens"].sum()
        data = sum(np.frombuffer(w, np.float32) * np.float32(t / total) for w, t in zip(pdf["weights"], pdf["tokens"]))
        return pd.DataFrame({"trainer": [int(pdf["trainer"].iloc[0]) // FAN], "tokens": [total],
                             "weights": [data.astype(np.float32).tobytes()]})

    trained = cut_lineage(trained)
    while trainers > 1:
        trained = cut_lineage(trained.groupBy(F.floor(F.col("trainer") / FAN)).applyInPandas(
            mean, "trainer int, tokens double, weights binary"))
        trainers = -(-trainers // FAN)
    row = trained.first()
    return None if row is None else np.frombuffer(row.weights, np.float32)


# ---- scoring

def score(docs: DataFrame, training: Column, doc_id: str = "doc_id", text: str = "text", head: int = HEAD) -> DataFrame:
    """doc_id, training, n_tokens, n_known, train_tokens, base_score, score of every row.

    ``training`` is true for rows to learn from. Scores are log10 probabilities.
    """
    spark = docs.sparkSession
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), training.alias("training"), whole(text).alias("_text"))
    learned = rows.where("training")
    counts = cut_lineage(word_counts(learned))
    lex = spark.sparkContext.broadcast(lexicon(counts, learned.count(), head))
    model = spark.sparkContext.broadcast(train(learned, lex))

    def run(batches):
        keep_freed()
        words_of, net = lex.value, model.value
        ln10 = np.log(10)
        for b in batches:
            texts = b.column("_text")
            n, known, base, inside, symbols = [], [], [], [], []
            tail: tuple[list[int], list[bytes], list[int]] = ([0], [], [])
            for t in texts:
                words = tokens(t.as_py())
                s, at = words_of.symbols(words)
                have = at >= 0
                logs = words_of.log[at[have]]
                n.append(len(words) + 1)
                known.append(int(have.sum()) + (words_of.texts > 0))
                base.append(float(logs.sum() + np.log10(words_of.texts + 0.1)))
                rare = s >= words_of.known
                # within a bucket: the word's own share; its count is here or in the join
                share = words_of.log[at[rare & have]].sum() - words_of.rare_norm[s[rare] - words_of.known].sum()
                inside.append(float(share))
                symbols.append(s)
                rest = Counter(words[i] for i in np.flatnonzero(~have).tolist())
                tail[1].extend(rest)
                tail[2].extend(rest.values())
                tail[0].append(len(tail[1]))
            pairs = pa.StructArray.from_arrays([pa.array(tail[1], pa.binary()), pa.array(tail[2], pa.int32())], ["word", "n"])
            total = net.score(symbols) / ln10 + np.array(inside)
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), b.column("doc_id"), b.column("training"), pa.array(n, pa.int64()),
                 pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(total, pa.float64()),
                 pa.ListArray.from_arrays(pa.array(tail[0], pa.int32()), pairs)],
                ["row", "doc_id", "training", "n_tokens", "known", "base", "model", "tail"])

    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "training", "_text")
    read = cut_lineage(numbered.mapInArrow(
        handing_back(run), f"row long, doc_id {kind}, training boolean, n_tokens long, known long, base double, model double, "
             "tail array<struct<word:binary,n:int>>"))
    tail = read.select("row", F.explode("tail").alias("t")).select("row", "t.word", "t.n")
    met = tail.join(counts, "word", "left")
    c = F.coalesce("c", F.lit(0))
    rest = met.groupBy("row").agg(
        F.sum(F.col("n") * F.log10(c + 0.1)).alias("more"),
        F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("seen"))
    more = F.coalesce("more", F.lit(0.0))
    lex = lex.value
    return read.drop("tail").join(rest, "row", "left").select(
        "doc_id", "training", "n_tokens", (F.col("known") + F.coalesce("seen", F.lit(0))).alias("n_known"),
        F.lit(int(lex.total)).cast("long").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * F.lit(float(lex.base_norm))).alias("base_score"),
        (F.col("model") + more).alias("score"))

