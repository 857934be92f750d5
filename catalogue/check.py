"""Run registered queries against their SQL in DuckDB: python -m catalogue.check SF_DIR [names]."""

import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

import catalogue

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def session(cores: int = int(os.environ.get("CHECK_CPUS", "8"))) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, (bool, int)):
        return float(value)
    return value if value is None or isinstance(value, str) else str(value)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def connect(sf_dir):
    db = duckdb.connect()
    for t in TABLES:
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return db


def compare(spark, db, sf_dir, name):
    """None when equal, otherwise what differs."""
    df = catalogue.queries()[name](spark, sf_dir)
    got = normal(df.columns, df.collect())
    sql = catalogue.oracle_sql().get(name)
    if sql is None:
        return None if df.columns and got[1] else "no rows"
    result = db.execute(sql)
    want = normal([c[0] for c in result.description], result.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} / {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} / {len(want[1])}"
    bad = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    return f"{len(bad)} rows differ, e.g. {bad[0]}" if bad else None


def main(sf_dir, names):
    spark, db = session(), connect(sf_dir)
    failed = 0
    for name in names or catalogue.queries():
        started = time.time()
        try:
            problem = compare(spark, db, sf_dir, name)
        except Exception as e:  # report and go on with the other queries
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        print(f"{name:32s} {time.time() - started:6.2f}s {problem or 'ok'}", flush=True)
    print("failed:", failed)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
