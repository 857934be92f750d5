"""Writing tables so that a retry or a lost executor leaves no half result."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class VersionedTable:
    """A Parquet table replaced as a whole: each version in its own folder.

    A version is written beside the current one, so a table may be rewritten
    from itself. Readers use the newest complete version: Spark puts the
    success mark there only after all tasks have committed. Writing the same
    version again is harmless. There is one writer at a time; a table with several,
    or one of which little changes at a time, is a ``BucketedTable``.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _files(self):
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        return root.getFileSystem(self.spark._jsc.hadoopConfiguration()), root

    def _folder(self, version: int) -> str:
        return f"{self.path}/version={version:012d}"

    def versions(self) -> list[int]:
        fs, root = self._files()
        if not fs.exists(root):
            return []
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        names = [s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()]
        found = [int(n.split("=")[1]) for n in names if n.startswith("version=")]
        return sorted(v for v in found if fs.exists(path(f"{self._folder(v)}/_SUCCESS")))

    def current(self) -> int | None:
        done = self.versions()
        return done[-1] if done else None

    def read(self) -> DataFrame | None:
        version = self.current()
        return None if version is None else self.spark.read.parquet(self._folder(version))

    def marks(self) -> dict:
        """What was noted with the current version."""
        version, (fs, _) = self.current(), self._files()
        if version is None or not fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(self._marks(version))):
            return {}
        return json.loads(self.spark.read.text(self._marks(version), wholetext=True).first()[0])

    def _marks(self, version: int) -> str:
        return f"{self.path}/marks-{version:012d}.json"

    def write(
        self, df: DataFrame, version: int | None = None, files: int | None = None, keep: int = 2,
        marks: dict | None = None,
    ) -> int:
        """Write a version (the next one by default) and drop all but ``keep``.

        Marks are written first; they count once the version is complete.
        """
        if version is None:
            version = (self.current() or 0) + 1
        if marks is not None:
            fs, _ = self._files()
            out = fs.create(self.spark._jvm.org.apache.hadoop.fs.Path(self._marks(version)), True)
            out.writeBytes(json.dumps(marks))
            out.close()
        out = df.repartition(files) if files else df
        out.write.mode("overwrite").parquet(self._folder(version))
        fs, _ = self._files()
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        for old in self.versions()[:-keep]:
            fs.delete(path(self._folder(old)), True)
            fs.delete(path(self._marks(old)), False)
        return version


def append_merging(df: DataFrame, path: str) -> None:
    """Append rows whose columns may differ from those already there."""
    df.write.mode("append").parquet(path)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(path)


def append_log(df: DataFrame, path: str, run_id: str, run_time: str) -> None:
    """Add the rows of one run to a log, stamped with the time of the run.

    Each run owns a folder and overwrites only that one, so repeating a run does
    not duplicate its rows.
    """
    stamped = df.withColumn("log_timestamp", F.lit(run_time).cast("timestamp"))
    stamped.write.mode("overwrite").parquet(f"{path.rstrip('/')}/run={run_id}")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def save_table(
    df: DataFrame, name: str, bucket_by: list[str] | None = None, buckets: int = 0, path: str | None = None
) -> None:
    """Replace a catalog table, bucketed by key when later joins use that key.

    Rows are put by key before they are written, so a bucket is one file and is read
    back in order. With a ``path`` the files lie there and outlive the table's name.
    """
    if bucket_by:
        df = df.repartition(buckets, *bucket_by)
    writer = df.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    if bucket_by:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    writer.saveAsTable(name)


def drop_staging(spark: SparkSession, names: list[str], prefix: str) -> None:
    """Drop staging tables; a name without the staging prefix is refused."""
    for name in names:
        if not name.split(".")[-1].startswith(prefix):
            raise ValueError(f"{name} is not a staging table")
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
