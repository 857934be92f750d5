"""Column expressions for cleaning and parsing."""

from __future__ import annotations

import difflib
import functools

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flag(condition: Column, yes=1, no=0) -> Column:
    """``yes`` where the condition holds, else (also when unknown) ``no``."""
    return F.when(condition, F.lit(yes)).otherwise(F.lit(no))


def bank_of_address(address: str, coalesce_other: bool = True) -> Column:
    """What follows '@' in a payment address.

    An address without '@' gives 'other'. A missing one does too, unless
    ``coalesce_other`` is False: then it stays null and a later fill can act.
    """
    a = F.col(address)
    bank = F.when(a.contains("@"), F.get(F.split(a, "@"), F.lit(1)))
    return bank.otherwise("other") if coalesce_other else F.when(a.isNotNull(), bank.otherwise("other"))


def bank_of_account(code: str, coalesce_other: bool = True) -> Column:
    """First four characters of a branch code; a missing code gives 'other' or null."""
    bank = F.substring(code, 1, 4)
    return F.coalesce(bank, F.lit("other")) if coalesce_other else bank


def local_time(t: str, hours: int = 5, minutes: int = 30) -> Column:
    """Time shifted by a fixed offset."""
    return F.col(t) + F.make_dt_interval(hours=F.lit(hours), mins=F.lit(minutes))


def dimension_value(dims: str | Column, index: int, index_field="index", value_field="value") -> Column:
    """Value of the first entry of an array of structs that has this index, else null."""
    dims = F.col(dims) if isinstance(dims, str) else dims
    at = F.array_position(dims[index_field], F.lit(index)).cast("int")
    return F.when(at > 0, F.get(dims[value_field], at - 1))


def json_value(column: str, path: str) -> Column:
    return F.get_json_object(column, path)


def strip_escapes(column: str) -> Column:
    """JSON text that was escaped once too often, without its backslashes."""
    return F.regexp_replace(column, r"\\", "")


def json_list_total(column: str, names: list[str]) -> Column:
    """Summed length of several JSON lists in one object; a missing list counts 0."""
    out = F.lit(0)
    for n in names:
        size = F.json_array_length(F.get_json_object(column, f"$.{n}"))
        out = out + F.coalesce(size, F.lit(0))
    return out


def literal_null(column: str, text: str = "null") -> Column:
    """Null where the text is literally 'null'."""
    return F.nullif(F.col(column), F.lit(text))


def log_floor(x: str) -> Column:
    """ln(max(1, x))."""
    return F.log(F.greatest(F.lit(1.0), F.col(x).cast("double")))


def yeo_johnson(x: str | Column, lmbda: float) -> Column:
    """Yeo-Johnson power transform for a fixed lambda."""
    v = (F.col(x) if isinstance(x, str) else x).cast("double")
    up = F.log1p(v) if lmbda == 0 else (F.pow(v + 1, F.lit(lmbda)) - 1) / lmbda
    rest = 2.0 - lmbda
    down = -F.log1p(-v) if rest == 0 else -(F.pow(1 - v, F.lit(rest)) - 1) / rest
    return F.when(v >= 0, up).otherwise(F.when(v < 0, down))


def cast_all(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast columns; text that does not parse becomes null instead of an error."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def fill(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Fill nulls per column; a value that does not fit the column type is refused."""
    text = (T.StringType,)
    for c, v in values.items():
        kind = df.schema[c].dataType
        if isinstance(v, str) != isinstance(kind, text):
            raise TypeError(f"{c} is {kind.simpleString()}, cannot be filled with {v!r}")
    return df.na.fill(values)


def prefix_columns(df: DataFrame, prefix: str) -> DataFrame:
    return df.toDF(*[f"{prefix}{c}" for c in df.columns])


def strip_prefix(df: DataFrame, prefix: str) -> DataFrame:
    """Remove a leading prefix once from the columns that have it."""
    return df.toDF(*[c[len(prefix):] if c.startswith(prefix) else c for c in df.columns])


def contract(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exactly these columns in this order; a missing one is an error."""
    return df.select(*columns)


@functools.lru_cache(maxsize=100_000)
def _ratio(x: str, y: str) -> float:
    return difflib.SequenceMatcher(None, x, y).ratio()


@F.pandas_udf(T.DoubleType())
def word_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Matching-blocks ratio of two words, as difflib defines it."""
    return pd.Series([None if x is None or y is None else _ratio(x, y) for x, y in zip(a, b)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def _best_similarity(pairs: pd.Series) -> pd.Series:
    """Largest ratio of words given as 'x y x y ...'; null for no pair."""
    out = []
    for text in pairs:
        words = text.split(" ") if text else []
        out.append(max(map(_ratio, words[::2], words[1::2]), default=None))
    return pd.Series(out, dtype="float64")


def name_match(
    df: DataFrame, a: str, b: str, name: str, threshold: float = 0.7, tokens: str = "all",
    measure: str = "blocks",
) -> DataFrame:
    """Do two names share a word: one contains the other, or their likeness >= threshold?

    ``tokens='first'`` compares only the first word of ``a``. Each row is judged on
    its own, no row is moved. Containment is settled by built-in functions.
    ``measure='blocks'`` is the matching-blocks ratio: word pairs go to Python if
    no word contains another and their lengths and common characters leave the
    threshold in reach. ``measure='levenshtein'`` is 1 - distance / longer length,
    built in.
    """
    if measure not in ("blocks", "levenshtein"):
        raise ValueError(measure)

    def words(c):
        return F.filter(F.split(F.lower(F.trim(c)), r"\s+"), lambda w: w != "")

    def some(test):
        return F.exists("_a", lambda x: F.exists("_b", lambda y: test(x, y)))

    left = words(a) if tokens == "all" else F.slice(words(a), 1, 1)
    d = df.withColumns({"_a": left, "_b": words(b)})
    d = d.withColumn("_inside", F.coalesce(some(lambda x, y: x.contains(y) | y.contains(x)), F.lit(False)))
    if measure == "levenshtein":
        def alike(x, y):
            shorter, longer = F.least(F.length(x), F.length(y)), F.greatest(F.length(x), F.length(y))
            # the distance is at least the difference of the lengths
            return (shorter >= threshold * longer) & (1 - F.levenshtein(x, y) / longer >= threshold)

        close = some(alike)
    else:
        def in_reach(x, y):
            # matched characters are at most the shorter word, and those of either word that the other has
            matched = F.least(F.length(x), F.length(y), _common(x, y), _common(y, x))
            return 2 * matched / (F.length(x) + F.length(y)) >= threshold

        pairs = F.flatten(F.transform("_a", lambda x: F.transform(
            F.filter("_b", lambda y: in_reach(x, y)), lambda y: F.concat_ws(" ", x, y))))
        d = d.withColumn("_open", F.when(~F.col("_inside") & (F.size(pairs) > 0), F.array_join(pairs, " ")))
        d = d.withColumn("_r", _best_similarity("_open"))
        close = F.col("_open").isNotNull() & (F.col("_r") >= threshold)
    verdict = F.col("_inside") | F.coalesce(close, F.lit(False))
    rest = [c for c in df.columns if c not in (a, b, name)]
    return d.select(a, b, *rest, verdict.alias(name))


def _common(x: Column, y: Column) -> Column:
    """Number of characters of x that y has."""
    return F.length(x) - F.length(F.call_function("translate", x, y, F.lit("")))
