"""Benchmark decontamination by winnowing.

A fingerprint is the smallest hash of K-word grams in each run of W grams. Two
texts that share W + K - 1 = 10 consecutive words share the whole run, hence its
minimum: every shared span of ten words or more meets in a join on fingerprints.
Items of fewer than ten words are one window; for each such length that occurs,
documents also offer their grams of that length.

Documents with a common fingerprint are looked at again: each place of a shared
fingerprint is extended to the windows of ten words that hold it, and these are
held against the items' windows, which are known by a digest of their words. A
word is hit when it lies in such a window, or in a whole short item. No pairs of
texts and items are formed but those that the result names.

Rows are keyed by the digest of their text, so copies are compared once, and a
recomputed task gives the same keys.

Defined cases: null, empty and wordless texts have no words and are not
contaminated; wordless items never occur; an item without id takes part under
the id ''. Repeated documents each get a row; repeated items count once. Other
columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitfeat.checkpoints import cut_lineage
from pitfeat.llm.common import ascii_lower, bounded, column, words_of

SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
WINDOW = 10
K = 5
W = WINDOW - K + 1
#: rows of two longs up to which the test side of the join is broadcast
BROADCAST_ROWS = 1_000_000


def words(text: str | Column) -> Column:
    return words_of(ascii_lower(column(text)), SEPARATORS)


def grams(w: Column, k: int) -> Column:
    """A hash for every k consecutive words."""
    n = F.size(w)
    return F.when(
        n >= k,
        F.transform(
            F.slice(w, 1, F.greatest(n - (k - 1), F.lit(0))),
            lambda x, i: F.xxhash64(F.lit(k), x, *[F.get(w, i + j) for j in range(1, k)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def minima(g: Column) -> Column:
    """The smallest gram of each run of W grams, distinct."""
    n = F.size(g)
    runs = F.transform(F.sequence(F.lit(1), n - (W - 1)), lambda s: F.array_min(F.slice(g, s, W)))
    return F.when(n >= W, F.array_distinct(runs)).otherwise(F.array().cast("array<bigint>"))


def fingerprints(docs: DataFrame, w: Column, short: list[int], keep: list[str]) -> DataFrame:
    """One row per distinct fingerprint of a text."""
    named = docs.select(*keep, grams(w, K).alias("_g"), *[grams(w, k).alias(f"_g{k}") for k in short])
    every = [minima(F.col("_g")), *[F.array_distinct(F.col(f"_g{k}")) for k in short]]
    return named.select(*keep, F.explode(F.concat(*every)).alias("fp"))


def item_table(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """Distinct items with words: item, _iw."""
    named = items.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), words(text).alias("_iw"))
    return named.where(F.size("_iw") > 0).distinct()


def windows_of(bench: DataFrame) -> DataFrame:
    """Distinct (window, item): digest of ten consecutive words, or of a whole shorter item."""
    n, iw = F.least(F.lit(WINDOW), F.size("_iw")), F.col("_iw")
    starts = F.sequence(F.lit(1), F.size(iw) - n + 1)
    every = F.transform(starts, lambda s: _digest(F.slice(iw, s, n)))
    return bench.select("item", F.explode(F.array_distinct(every)).alias("window"))


def _digest(some: Column) -> Column:
    return F.unhex(F.md5(F.array_join(some, " ")))


def find_hits(
    docs: DataFrame, items: DataFrame,
    text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """Every place where a window of an item occurs in a text, and the items of each window.

    The first has key (digest of the text), start (first word), length and window, the
    second window and item. A passage that many texts and many items share makes a row
    for each text and one for each item, not for each pair of them.
    """
    bench = item_table(items, item_id, item_text)
    size = F.size("_iw")
    short = sorted(r[0] for r in bench.where(size < WINDOW).select(size).distinct().collect())

    item_fp = cut_lineage(_item_fingerprints(bench, short))
    probe = item_fp.select("fp").distinct()
    few = bounded(probe, BROADCAST_ROWS)
    probe = F.broadcast(probe) if few else probe
    named = docs.where(F.col(text).isNotNull()).select(
        F.unhex(F.md5(F.col(text))).alias("key"), F.col(text).alias("_text"))
    split = named.select("key", words("_text").alias("_w"))
    suspects = fingerprints(split, F.col("_w"), short, ["key"]).join(probe, "fp", "left_semi")
    suspects = cut_lineage(suspects.select("key").distinct())
    if bounded(suspects, BROADCAST_ROWS):
        suspects = F.broadcast(suspects)
    # read twice below, so written once; it holds suspects only, and each text once
    again = cut_lineage(named.join(suspects, "key", "left_semi").groupBy("key").agg(
        F.first("_text").alias("_text")))
    windows = cut_lineage(windows_of(bench))
    found = _extend(again.select("key", words("_text").alias("_w")), item_fp, few, windows)
    return cut_lineage(found), windows


def _item_fingerprints(bench: DataFrame, short: list[int]) -> DataFrame:
    """Distinct k, fp of all items."""
    iw, size = F.col("_iw"), F.size("_iw")
    long_fp = fingerprints(bench.where(size >= WINDOW), iw, [], ["item"]).select(F.lit(K).alias("k"), "fp")
    parts = [long_fp, *[
        bench.where(size == k).select(F.lit(k).alias("k"), F.explode(grams(iw, k)).alias("fp")) for k in short]]
    # a short item of K words has a length of its own, told from the grams of longer ones by ``whole``
    whole = [F.lit(False), *[F.lit(True)] * len(short)]
    return reduce(DataFrame.unionByName, [p.withColumn("whole", w) for p, w in zip(parts, whole)]).distinct()


def _extend(suspects: DataFrame, item_fp: DataFrame, few: bool, windows: DataFrame) -> DataFrame:
    """Windows around the places of shared fingerprints, held against the items' windows.

    A window of ten words of an item holds the gram that was selected in it, so each
    occurrence of that gram is extended to all windows that hold it, and no others.
    """
    dw = F.col("_w")
    sizes = [(r.k, r.whole) for r in item_fp.select("k", "whole").distinct().collect()]
    seeds = []
    for k, whole in sorted(sizes):
        fp = item_fp.where((F.col("k") == k) & (F.col("whole") == whole)).select("fp")
        places = suspects.select("key", F.posexplode(grams(dw, k)).alias("p", "fp"))
        met = places.join(F.broadcast(fp) if few else fp, "fp", "left_semi")
        length, back = (k, 0) if whole else (WINDOW, W - 1)
        seeds.append(met.select(
            "key", F.explode(F.sequence(F.greatest(F.col("p") - back, F.lit(0)), F.col("p"))).alias("start"),
            F.lit(length).alias("length")))
    if not seeds:
        return windows.select(
            F.col("window").alias("key"), F.lit(0).alias("start"), F.lit(0).alias("length"), "window").limit(0)
    starts = reduce(DataFrame.unionByName, seeds).distinct()
    # the texts are bounded by the suspects; their starts meet them by key
    own = starts.groupBy("key").agg(F.collect_list(F.struct("start", "length")).alias("_s"))
    placed = suspects.join(own, "key").select("key", "_w", F.explode(F.filter(
        "_s", lambda x: x["start"] + x["length"] <= F.size("_w"))).alias("_at"))
    found = placed.select("key", "_at.start", "_at.length", _digest(
        F.slice("_w", F.col("_at.start") + 1, F.col("_at.length"))).alias("window"))
    return found.join(windows.select("window").distinct(), "window", "left_semi").select(
        "key", "start", "length", "window")


def contamination(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """doc_id, n_words, n_hit, items (sorted ids) of every row of docs."""
    found, windows = find_hits(docs, items, text, item_id, item_text)
    places = found.groupBy("key", "start").agg(F.max("length").alias("length"))
    # words covered by windows: each reaches to its end or to where the next begins
    spans = places.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "length"))).alias("_s"))
    covered = F.aggregate(
        F.col("_s"), F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(F.lit(0), s["start"] + s["length"] - F.greatest(a["end"], s["start"]))).alias("n"),
            F.greatest(a["end"], s["start"] + s["length"]).alias("end")),
        lambda a: a["n"])
    named = found.select("key", "window").distinct().join(windows, "window")
    per_key = spans.select("key", covered.alias("_hit")).join(
        named.groupBy("key").agg(F.array_sort(F.collect_set("item")).alias("_items")), "key")
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.unhex(F.md5(F.col(text))).alias("key"),
        F.size(words(text)).cast("long").alias("n_words"))
    return rows.join(per_key, "key", "left").select(
        "doc_id", "n_words",
        F.coalesce("_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("_items", F.array().cast("array<string>")).alias("items"))


def drop_contaminated(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """Rows of docs whose text holds no window of an item; null texts stay."""
    found, _ = find_hits(docs, items, text, item_id, item_text)
    keys = found.select(F.col("key").alias("_key")).distinct()
    marked = docs.withColumn("_key_of_text", F.unhex(F.md5(F.col(text))))
    return marked.join(keys, F.col("_key_of_text") == F.col("_key"), "left_anti").drop("_key_of_text")
