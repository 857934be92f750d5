"""Cutting lineage in the shared folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach.

    Taken from ``spark.checkpoint.dir``. Only a local session, where driver and
    executors are one process, may fall back to a temporary folder.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(
        CHECKPOINT_DIR
    )
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by the cluster")
    made = tempfile.mkdtemp(prefix="pitfeat-")
    spark.conf.set(CHECKPOINT_DIR, made)
    return made


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the frame to the shared folder and read it back.

    The files survive the loss of executors. Unlike a checkpointed RDD they are
    computed once, read column by column, and have a known size, so the plans
    that follow can tell small from large without measuring.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, "cut")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_folder(spark: SparkSession, kind: str) -> str:
    """A new, empty folder name under the shared folder."""
    return f"{_folder(spark)}/{kind}-{uuid.uuid4().hex}"


def drop_cuts(spark: SparkSession) -> None:
    """Delete this application's intermediate tables, once no frame needs them."""
    root = spark._jvm.org.apache.hadoop.fs.Path(_folder(spark))
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(root, True)


def _folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}"
