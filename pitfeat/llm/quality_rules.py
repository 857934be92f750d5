"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps one bit per failed
rule beside the measurements, so a policy is a mask that can be versioned and
compared later without touching a text again.

Defined cases: a null or empty text has no words (every count 0, fails
``too_few_words``). Repeated rows each get a ledger row. Other columns of the
input are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitfeat.llm.common import SPACES, whole, words_of

SYMBOLS = "#*$%&|<>"

#: The place in the list is the bit. New rules go to the end: old ledgers stay readable.
RULES = [
    "too_few_words", "repeated_words", "symbol_ratio", "repeated_lines",
    "shouting", "exclamations", "word_length",
]

#: Rules of each policy version.
POLICIES = {
    "base": RULES[:2],
    "v1": RULES[:4],
    "v2": RULES,
}


def failures() -> dict[str, Column]:
    """Failure condition of each rule over the measurements."""
    n, chars = F.col("n_words"), F.col("word_chars")
    return {
        "too_few_words": n < 50,
        "repeated_words": 100 * F.col("n_repeat_words") > 50 * n,
        "symbol_ratio": 10 * F.col("n_symbols") > 3 * n,
        "repeated_lines": 10 * F.col("n_dup_lines") > 3 * F.col("n_lines"),
        "shouting": 10 * F.col("n_upper") > 5 * chars,
        "exclamations": 10 * F.col("n_exclaim") > 5 * n,
        "word_length": (chars < 2 * n) | (chars > 20 * n),
    }


def bit(rule: str) -> int:
    return 1 << RULES.index(rule)


def mask(policy: str) -> int:
    return sum(bit(r) for r in POLICIES[policy])


def _without(text: Column, letters: str) -> Column:
    """Characters of the text that are among the letters."""
    return (F.length(text) - F.length(F.translate(text, letters, ""))).cast("long")


def _repeated_words(words: Column, grams: Column) -> Column:
    """Words inside 3-word windows that occur twice or more, first one included.

    ``grams`` holds a 64-bit hash per window. Sorting (hash, place) brings equal
    windows together; the covered words are then summed over the gaps between
    the places, 3 words at most each. Texts without a repeat skip all that.
    """
    sorted_grams = F.array_sort(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))

    def places(s: Column) -> Column:
        def place(e, k):
            same = (F.get(s, k - 1)["h"] == e["h"]) | (F.get(s, k + 1)["h"] == e["h"])
            return F.when(same, e["p"])

        return F.array_sort(F.filter(F.transform(s, place), lambda p: p.isNotNull()))

    def covered(p: Column) -> Column:
        gaps = F.transform(p, lambda x, k: F.least(F.lit(3), F.get(p, k + 1) - x))
        return F.aggregate(gaps, F.lit(0), lambda a, b: a + b)

    return F.when(
        F.size(F.array_distinct(grams)) < F.size(grams),
        _let(sorted_grams, lambda s: _let(places(s), covered)),
    ).otherwise(0).cast("long")


def _let(value: Column, use) -> Column:
    """Evaluate a value once and use it several times."""
    return F.element_at(F.transform(F.array(value), use), 1)


def measure(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the measurements of every text; no shuffle."""
    t = F.col("_text")
    split = docs.select(
        F.col(doc_id).alias("_id"), whole(text).alias("_text"),
        words_of(F.col(text), SPACES).alias("_words"),
    )
    w = F.col("_words")
    n = F.size(w)
    gram = lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))
    grams = F.when(n > 2, F.transform(F.slice(w, 1, n - 2), gram)).otherwise(
        F.array().cast("array<bigint>"))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    read = split.select("_id", "_text", "_words", grams.alias("_grams"), lines.alias("_lines"))
    return read.select(
        F.col("_id").alias("doc_id"),
        n.cast("long").alias("n_words"),
        F.length(F.translate(t, " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
        _without(t, SYMBOLS).alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _repeated_words(w, F.col("_grams")).alias("n_repeat_words"),
        (F.length(t) - F.length(F.regexp_replace(t, "\\p{Lu}+", ""))).cast("long").alias("n_upper"),
        _without(t, "!").alias("n_exclaim"),
    )


def ledger(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Measurements and ``fail_bits`` (long) of every document."""
    return with_bits(measure(docs, doc_id, text))


def with_bits(measured: DataFrame) -> DataFrame:
    bits = F.lit(0).cast("long")
    for rule, failed in failures().items():
        bits = bits.bitwiseOR(F.when(failed, F.lit(bit(rule))).otherwise(0).cast("long"))
    return measured.withColumn("fail_bits", bits)


def fails(policy: str) -> Column:
    return F.col("fail_bits").bitwiseAND(F.lit(mask(policy)).cast("long")) != 0


def apply_policy(book: DataFrame, policy: str) -> DataFrame:
    """Add base_failed and kept under a policy version."""
    return book.withColumns({"base_failed": fails("base"), "kept": ~fails("base") & ~fails(policy)})


def ablations(book: DataFrame, policy: str) -> DataFrame:
    """What each rule of a policy does, from the bits alone.

    Per rule: documents it fails, documents that only it fails (they would be
    kept without it), and documents kept without it. The ledger is reduced to
    one row per distinct bit pattern, at most 2 ** rules, before anything else.
    """
    full = F.lit(mask(policy)).cast("long")
    patterns = book.groupBy(F.col("fail_bits").bitwiseAND(full).alias("bits")).agg(
        F.count("*").alias("n"))
    names = POLICIES[policy]
    table = F.explode(F.array(*[
        F.struct(F.lit(r).alias("rule"), F.lit(bit(r)).cast("long").alias("bit")) for r in names]))
    each = patterns.select("bits", "n", table.alias("r")).select("bits", "n", "r.*")
    hit = F.col("bits").bitwiseAND(F.col("bit")) != 0
    count = lambda cond: F.sum(F.when(cond, F.col("n")).otherwise(0)).cast("long")
    return each.groupBy("rule").agg(
        count(hit).alias("failed"),
        count(F.col("bits") == F.col("bit")).alias("failed_alone"),
        count(F.col("bits").bitwiseAND(F.bitwise_not("bit")) == 0).alias("kept_without"),
    )
