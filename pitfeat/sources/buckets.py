"""A Parquet table in hash buckets, of which a fold rewrites only those it touches."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Fold = Callable[[DataFrame | None, DataFrame], DataFrame]
BUCKET = "_bucket"


class BucketedTable:
    """Rows placed by a hash of their key; a version is a list of bucket folders.

    The manifest of a version names the folder of every bucket and the last batch
    of every query folded in. It is put in place as a whole and only if that
    version does not exist yet, so of two writers that finish at once one has to
    look at the other's version first: it keeps its own buckets if the other left
    them alone, else folds again. Data folders are never changed, so readers of an
    older version go on undisturbed until ``vacuum`` is asked to clear it away.

    ``buckets`` bounds the manifest and what a driver looks at; it should grow with
    the table, so that a bucket stays a small part of it.
    """

    def __init__(self, spark: SparkSession, path: str, by: list[str], buckets: int = 64, attempts: int = 20):
        self.spark, self.path, self.by = spark, path.rstrip("/"), list(by)
        self.buckets, self.attempts = buckets, attempts

    # ---- reading

    def version(self) -> int:
        """Newest version, 0 for a table not yet written."""
        names = [s.getPath().getName() for s in self._list(f"{self.path}/manifests")]
        return max((int(n[:-5]) for n in names if n.endswith(".json")), default=0)

    def manifest(self, version: int | None = None) -> dict:
        version = self.version() if version is None else version
        if version == 0:
            return {"buckets": {}, "marks": {}, "schema": None, "count": self.buckets}
        text = self.spark.read.text(self._manifest(version), wholetext=True).first()[0]
        found = json.loads(text)
        if found["count"] != self.buckets:
            raise ValueError(f"the table has {found['count']} buckets, not {self.buckets}")
        return found

    def read(self, version: int | None = None, only: list[int] | None = None) -> DataFrame | None:
        """The rows of a version, or of some of its buckets; None when there are none."""
        return self._rows(self.manifest(version), only)

    def _rows(self, manifest: dict, only: list[int] | None = None) -> DataFrame | None:
        if manifest["schema"] is None:
            return None
        schema = T.StructType.fromJson(manifest["schema"])
        folders = [f for b, f in manifest["buckets"].items() if only is None or int(b) in only]
        if not folders:
            return self.spark.createDataFrame([], schema) if only is None else None
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in sorted(folders)])

    # ---- writing

    def bucket(self):
        return F.pmod(F.xxhash64(*self.by), F.lit(self.buckets)).cast("int")

    def touched(self, delta: DataFrame) -> list[int]:
        """Buckets of the rows: at most as many numbers as the table has buckets."""
        return sorted(r[0] for r in delta.select(self.bucket().alias(BUCKET)).distinct().collect())

    def fold(self, delta: DataFrame, fold: Fold, query: str = "", batch: int | None = None) -> bool:
        """Fold rows into the buckets of their keys; False if this batch was folded before.

        ``fold(stored, delta)`` sees the stored rows of the touched buckets only, or
        None, and returns what these buckets hold from then on, keyed as before.
        """
        mine = self.touched(delta)
        written: tuple[dict, dict] | None = None
        for _ in range(self.attempts):
            version = self.version()
            old = self.manifest(version)
            if batch is not None and old["marks"].get(query, -1) >= batch:
                return False
            seen = {str(b): old["buckets"].get(str(b)) for b in mine}
            if written is None or written[0] != seen:
                # the first attempt, or another writer changed a bucket of ours
                rows = fold(self._rows(old, mine) if mine else None, delta)
                empty = {"buckets": {}, "schema": old["schema"] or rows.schema.jsonValue()}
                written = seen, self._write(rows, mine) if mine else empty
            new = dict(old["buckets"])
            for b in mine:
                new.pop(str(b), None)
            folders, schema = written[1]["buckets"], written[1]["schema"]
            marks = old["marks"] | ({query: batch} if batch is not None else {})
            done = {"buckets": new | folders, "marks": marks, "schema": schema, "count": self.buckets}
            if self._create(self._manifest(version + 1), json.dumps(done)):
                return True
        raise RuntimeError(f"no version could be written in {self.attempts} attempts")

    def _write(self, rows: DataFrame, mine: list[int]) -> dict:
        """Write the rows of some buckets into a new folder, one part for each bucket."""
        folder = f"data/{uuid.uuid4().hex}"
        out = rows.withColumn(BUCKET, self.bucket())
        # adaptive execution splits a bucket that is larger than a task should write
        out = out.hint("rebalance", BUCKET)
        out.write.partitionBy(BUCKET).parquet(f"{self.path}/{folder}")
        names = [s.getPath().getName() for s in self._list(f"{self.path}/{folder}")]
        found = [int(n.split("=")[1]) for n in names if n.startswith(f"{BUCKET}=")]
        stray = set(found) - set(mine)
        if stray:
            raise ValueError(f"the fold returned keys of buckets it was not given: {sorted(stray)}")
        return {"buckets": {str(b): f"{folder}/{BUCKET}={b}" for b in found}, "schema": rows.schema.jsonValue()}

    def vacuum(self, keep: int = 2, older_than_s: float = 7 * 86_400) -> int:
        """Delete folders that none of the newest ``keep`` versions names and that are old enough.

        The age spares what a reader of an older version, or a writer that has not
        finished, may still use. Returns how many folders were deleted.
        """
        newest = self.version()
        named = {f.rsplit("/", 1)[0] for v in range(max(1, newest - keep + 1), newest + 1)
                 for f in self.manifest(v)["buckets"].values()}
        before = (time.time() - older_than_s) * 1000
        gone = 0
        for status in self._list(f"{self.path}/data"):
            if f"data/{status.getPath().getName()}" not in named and status.getModificationTime() <= before:
                self._fs().delete(status.getPath(), True)
                gone += 1
        return gone

    # ---- files

    def _manifest(self, version: int) -> str:
        return f"{self.path}/manifests/{version:012d}.json"

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(name)

    def _fs(self):
        return self._path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _list(self, folder: str) -> list:
        fs = self._fs()
        return list(fs.listStatus(self._path(folder))) if fs.exists(self._path(folder)) else []

    def _create(self, name: str, text: str) -> bool:
        """Put a whole file in place unless there is one; False if there is."""
        jvm, fs = self.spark._jvm, self._fs()
        draft = self._path(f"{self.path}/drafts/{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        target = self._path(name)
        fs.mkdirs(target.getParent())
        try:
            if fs.getUri().getScheme() == "file":
                # a rename would replace a file; a hard link is made only where there is none
                to, of = (jvm.java.io.File(p.toUri().getPath()).toPath() for p in (target, draft))
                jvm.java.nio.file.Files.createLink(to, of)
            else:
                context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                    target.toUri(), self.spark._jsc.hadoopConfiguration())
                never = self.spark.sparkContext._gateway.new_array(
                    getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
                context.rename(draft, target, never)
            return True
        except Exception as e:
            if "FileAlreadyExists" in str(e):
                return False
            raise
        finally:
            fs.delete(draft, False)
