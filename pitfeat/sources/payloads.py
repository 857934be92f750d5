"""Elements of JSON payloads, each taken or rejected for itself."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROKEN, NO_ARRAY, NO_OBJECT, WRONG_TYPE = "broken payload", "no array", "no object", "wrong type"


def payload_elements(
    df: DataFrame, column: str, path: str, fields: dict[str, tuple[str, str]], keep: list[str] | None = None,
) -> DataFrame:
    """A row for every element of the array at ``path`` of a JSON text.

    ``fields`` maps a column to the field it comes from and its type. The payload is
    parsed once, as a variant, so one odd element does not spoil its neighbours:

    * ``position``: place of the element in its array; null for a payload without elements,
    * the fields, null where the element lacks them or holds null,
    * ``unknown``: the fields not asked for, as JSON; null if there are none,
    * ``reject``: null for a good element, else why it is bad, and ``rejected`` its text.
      A payload that cannot be parsed, or has no array at the path, is one rejected row.

    So good and bad rows together account for every element and every payload that has
    none. A null payload and an empty array give no row.
    """
    names = {f for f, _ in fields.values()}
    if len(names) < len(fields):
        raise ValueError("a field is taken twice")
    keep = keep or []
    own = {"position", "unknown", "reject", "rejected", *fields}
    if own & set(keep):
        raise ValueError(f"kept columns clash with {sorted(own & set(keep))}")
    read = df.where(F.col(column).isNotNull()).select(
        *keep, F.col(column).cast("string").alias("_text"), F.try_parse_json(F.col(column).cast("string")).alias("_v"))
    # a JSON null parses to a variant, broken text does not
    items = F.try_variant_get("_v", f"$.{path}" if path else "$", "array<variant>")
    found = read.withColumn("_items", items)
    why = F.when(F.col("_v").isNull(), BROKEN).otherwise(NO_ARRAY)
    none = found.where("_items is null").select(
        *keep, F.lit(None).cast("int").alias("position"),
        *[F.lit(None).cast(kind).alias(n) for n, (_, kind) in fields.items()],
        F.lit(None).cast("string").alias("unknown"), why.alias("reject"), F.col("_text").alias("rejected"))
    each = found.where("_items is not null").select(*keep, F.posexplode("_items").alias("position", "_e"))
    parts = each.withColumn("_map", F.try_variant_get("_e", "$", "map<string,variant>"))
    value = {n: F.try_element_at("_map", F.lit(f)) for n, (f, _) in fields.items()}
    got = {n: F.try_variant_get(value[n], "$", kind) for n, (_, kind) in fields.items()}
    wrong = F.lit(False)
    for n in fields:
        given = value[n].isNotNull() & ~F.is_variant_null(value[n])
        lost = got[n].isNull()
        if fields[n][1] in ("int", "long", "bigint"):  # a cast would cut 2.5 down to 2
            lost = lost | (F.try_variant_get(value[n], "$", "double") != got[n])
        wrong = wrong | (F.coalesce(given, F.lit(False)) & F.coalesce(lost, F.lit(False)))
    # an array element that is itself missing counts as JSON null
    reject = F.when(F.col("_map").isNull(), NO_OBJECT).when(wrong, WRONG_TYPE)
    rest = F.map_filter("_map", lambda k, _: ~k.isin(*names))
    good = parts.withColumn("reject", reject).select(
        *keep, "position",
        *[F.when(F.col("reject").isNull(), got[n]).alias(n) for n in fields],
        F.when(F.col("reject").isNull() & (F.size(rest) > 0), F.to_json(rest)).alias("unknown"),
        "reject", F.when(F.col("reject").isNotNull(), F.coalesce(F.to_json("_e"), F.lit("null"))).alias("rejected"))
    return good.unionByName(none)


def good_elements(elements: DataFrame) -> DataFrame:
    return elements.where("reject is null").drop("reject", "rejected")


def bad_elements(elements: DataFrame, keep: list[str] | None = None) -> DataFrame:
    return elements.where("reject is not null").select(*(keep or []), "position", "reject", "rejected")
