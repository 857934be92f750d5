"""Reading tables, files, JDBC and landed JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def with_timestamps(df: DataFrame) -> DataFrame:
    """Cast zone-free timestamps to timestamps of the session zone (meant to be UTC)."""
    naive = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in naive}) if naive else df


def read_table(
    spark: SparkSession, name: str, date_col: str | None = None,
    lo: str | None = None, hi: str | None = None,
) -> DataFrame:
    """Catalog table or Parquet path, pruned to [lo, hi) on the raw date column.

    The filter compares the stored column itself, so it reaches the files; the
    timestamp cast comes after it.
    """
    if "/" in name or name.endswith(".parquet"):
        df = spark.read.parquet(name)
    else:
        df = spark.table(name)
    if date_col and lo is not None:
        df = df.where(F.col(date_col) >= F.lit(lo).cast(df.schema[date_col].dataType))
    if date_col and hi is not None:
        df = df.where(F.col(date_col) < F.lit(hi).cast(df.schema[date_col].dataType))
    return with_timestamps(df)


def since_days(df: DataFrame, date_col: str, today: str, days: int) -> DataFrame:
    """Rows of the last ``days`` days before ``today``, which the caller passes in."""
    return df.where(F.col(date_col) >= F.date_sub(F.lit(today).cast("date"), days))


def up_to_largest(df: DataFrame, column: str, seen: DataFrame) -> DataFrame:
    """Rows whose key is at most the largest in ``seen``, its own table's keys at some moment.

    The bound is one row, found by its own aggregate; without a row in ``seen`` there is none.
    """
    bound = seen.agg(F.max(column).alias("_bound"))
    return df.join(F.broadcast(bound), F.col(column) <= F.col("_bound")).drop("_bound")


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """CSV with a header, read by a declared schema: nothing is inferred."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def snapshot_query(
    table: str, part_col: str, highest: int | None,
    columns: list[str] | None = None, predicate: str | None = None,
) -> str:
    """Subquery with the rows up to the largest key seen at the start; none if there was none."""
    picked = ", ".join(columns) if columns else "*"
    where = "1 = 0" if highest is None else f"{part_col} <= {highest}"
    if predicate:
        where += f" AND ({predicate})"
    return f"(SELECT {picked} FROM {table} WHERE {where}) t"


def read_jdbc(
    spark: SparkSession, url: str, table: str, part_col: str, partitions: int,
    columns: list[str] | None = None, predicate: str | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Parallel read of a database table up to the largest key at the start.

    The bounds come from one min/max query on this very table. Rows added later
    lie beyond them and are left out, so all partitions see the same table.
    ``predicate`` runs in the database. Credentials and driver belong in
    ``options``, supplied by the caller.
    """
    reader = spark.read.format("jdbc").option("url", url).options(**(options or {}))
    where = f" WHERE {predicate}" if predicate else ""
    span = f"(SELECT MIN({part_col}) AS LO, MAX({part_col}) AS HI FROM {table}{where}) b"
    lo, hi = reader.option("dbtable", span).load().first()
    return (
        spark.read.format("jdbc")
        .option("url", url)
        .options(**(options or {}))
        .option("dbtable", snapshot_query(table, part_col, hi, columns, predicate))
        .option("partitionColumn", part_col)
        .option("lowerBound", 0 if lo is None else lo)
        .option("upperBound", 1 if hi is None else max(hi, lo + 1))
        .option("numPartitions", partitions)
        .load()
    )


def payload_rejects(df: DataFrame, column: str, schema: str, keep: list[str] | None = None) -> DataFrame:
    """Rows whose payload does not fit the schema, as a whole: kept columns and the payload.

    ``explode_payload`` gives no row for them, not even for elements that would fit;
    a payload without the array, or with an empty one, has no row in either.
    ``payload_elements`` takes and rejects element by element.
    """
    bad = F.from_json(
        column, _with_broken(schema), {"columnNameOfCorruptRecord": "_broken"})
    return df.where(F.col(column).isNotNull() & bad["_broken"].isNotNull()).select(*(keep or []), column)


def _with_broken(schema: str) -> T.StructType:
    return T.StructType([*T.StructType.fromDDL(schema).fields, T.StructField("_broken", T.StringType())])


def explode_payload(
    df: DataFrame, column: str, schema: str, path: str, renames: dict[str, str],
    epoch_ms: dict[str, str] | None = None, keep: list[str] | None = None,
) -> DataFrame:
    """Rows of a JSON array inside a payload, renamed.

    ``schema`` describes the whole payload and ``path`` is the dotted way to the
    array. ``epoch_ms`` maps a millisecond column to the timestamp it becomes.
    Two sources renamed to one target would silently lose one: refused.
    """
    targets = list(renames.values())
    twice = {t for t in targets if targets.count(t) > 1}
    if twice:
        raise ValueError(f"several fields renamed to {sorted(twice)}")
    keep = keep or []
    read = F.from_json(column, _with_broken(schema), {"columnNameOfCorruptRecord": "_broken"})
    parsed = df.select(*keep, read.alias("_payload")).where(F.col("_payload._broken").isNull())
    rows = parsed.select(*keep, F.inline(F.col(f"_payload.{path}")))
    taken = (set(rows.columns) - set(renames)) & set(targets)
    if taken:
        raise ValueError(f"renames collide with {sorted(taken)}")
    rows = rows.withColumnsRenamed(renames)
    stamps = {new: F.timestamp_millis(F.col(old)) for old, new in (epoch_ms or {}).items()}
    return rows.withColumns(stamps) if stamps else rows


def table_or_empty(spark: SparkSession, name: str, schema: str | T.StructType) -> DataFrame:
    """The table if it exists, otherwise an empty frame of its schema."""
    if spark.catalog.tableExists(name):
        return spark.table(name)
    return spark.createDataFrame([], schema)


def is_empty(df: DataFrame) -> bool:
    return df.isEmpty()
