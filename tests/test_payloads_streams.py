"""Payload elements, label streams, scoring on a stream and bucketed assembly."""

import json
import random

import pytest
from pyspark.sql import functions as F

from catalogue import storage
from pitfeat.operators import joins
from pitfeat.sources import payloads, sinks
from pitfeat.sources.sinks import VersionedTable
from pitfeat.streaming import incremental as inc
from pitfeat.streaming import monitoring

FIELDS = {"num": ("id", "int"), "q": ("q", "double")}


def test_payload_elements(spark):
    odd = ('{"d":{"a":[{"id":1,"q":"2.5","x":{"y":[1]}},{"id":"z"},{"id":null},7,null,{"id":2.5},{"id":3.0},[1],'
           '{"id":true}]}}')
    rows = [(1, odd), (2, '{"d":'), (3, None), (4, '{"d":{"a":[]}}'), (5, '{"d":3}'), (6, "null"),
            (7, '{"d":{"a":{"id":1}}}'), (8, '{"d":{"a":[{}]}}'), (9, "")]
    df = spark.createDataFrame(rows, "k int, t string")
    found = payloads.payload_elements(df, "t", "d.a", FIELDS, ["k"])
    got = {(r.k, r.position): (r.num, r.q, r.unknown, r.reject) for r in found.collect()}
    wrong, bare = (None, None, None, payloads.WRONG_TYPE), (None, None, None, payloads.NO_OBJECT)
    assert got == {
        (1, 0): (1, 2.5, '{"x":{"y":[1]}}', None), (1, 1): wrong, (1, 2): (None, None, None, None), (1, 3): bare,
        (1, 4): bare, (1, 5): wrong, (1, 6): (3, None, None, None), (1, 7): bare, (1, 8): got[1, 8],
        (2, None): (None, None, None, payloads.BROKEN), (9, None): (None, None, None, payloads.BROKEN),
        (5, None): (None, None, None, payloads.NO_ARRAY), (6, None): (None, None, None, payloads.NO_ARRAY),
        (7, None): (None, None, None, payloads.NO_ARRAY), (8, 0): (None, None, None, None),
    }
    good, bad = payloads.good_elements(found), payloads.bad_elements(found, ["k"])
    assert good.count() + bad.count() == found.count()
    assert {r.rejected for r in bad.where("k = 1").collect()} >= {'{"id":"z"}', "7", "null", "[1]"}
    with pytest.raises(ValueError):
        payloads.payload_elements(df, "t", "a", {"x": ("id", "int"), "y": ("id", "int")})
    with pytest.raises(ValueError):
        payloads.payload_elements(df, "t", "a", {"k": ("id", "int")}, ["k"])
    assert payloads.payload_elements(df.limit(0), "t", "d.a", FIELDS).count() == 0


def test_good_and_bad_are_all_elements(spark):
    r = random.Random(3)
    some = [{"id": 1}, {"id": "x"}, 5, None, [], {"q": 2, "z": 1}, {"id": {"a": 1}}]
    rows, total = [], 0
    for k in range(200):
        items = [r.choice(some) for _ in range(r.randrange(5))]
        total += len(items)
        rows.append((k, json.dumps({"a": items})))
    found = payloads.payload_elements(spark.createDataFrame(rows, "k int, t string"), "t", "a", FIELDS)
    assert payloads.good_elements(found).count() + payloads.bad_elements(found).count() == total


def test_a_payload_is_taken_or_rejected_once(spark):
    from pitfeat.sources.tables import explode_payload, payload_rejects

    df = spark.createDataFrame([('{"d":[{"id":1},{"id":"x"}]}',), ('{"d":[{"id":2}]}',), ("{}",)], "t string")
    schema = "struct<d:array<struct<id:int>>>"
    assert [r.id for r in explode_payload(df, "t", schema, "d", {}).collect()] == [2]
    assert payload_rejects(df, "t", schema).count() == 1


def at(spark, rows, schema):
    d = spark.createDataFrame(rows, f"{schema}, s long")
    return d.withColumn("t", F.timestamp_seconds("s")).drop("s")


def test_labels_that_come_late_or_never(spark, tmp_path):
    log_parts = [[(1, 0.9, 100), (2, 0.1, 100), (3, 0.5, 100), (4, 0.7, 100)], [(9, 0.0, 9000)], [(9, 0.0, 9001)]]
    label_parts = [[(1, 1, 100), (2, 0, 99), (3, 1, 1100), (4, 0, 1101)], [(8, 0, 9000)], [(8, 0, 9001)]]
    for logs, labels in zip(log_parts, label_parts):
        log = at(spark, logs, "id long, score double")
        known = at(spark, labels, "id long, label int")
        log.write.mode("append").parquet(str(tmp_path / "log"))
        known.write.mode("append").parquet(str(tmp_path / "labels"))
        both = monitoring.labelled_log(
            inc.read_stream(spark, str(tmp_path / "log"), log.schema),
            inc.read_stream(spark, str(tmp_path / "labels"), known.schema),
            ["id"], "t", "t", "label", 1000, "10 seconds", "10 seconds")
        q = (both.writeStream.format("parquet").option("path", str(tmp_path / "out"))
             .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
        q.awaitTermination()
    got = {r.id: r.label for r in spark.read.schema(both.schema).parquet(str(tmp_path / "out")).collect()}
    # the same time and exactly the wait count; a label before its row, or a second too late, does not
    assert got == {1: 1, 2: None, 3: 1, 4: None}


def test_scored_once_with_the_features_of_the_moment(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "features"))
    folder, log, checkpoint = (str(tmp_path / n) for n in ("in", "log", "cp"))

    def score(rows, features):
        return rows.withColumn("n", F.lit(0).cast("long")) if features is None else rows.join(features, "k", "left")

    for step, features in enumerate([None, [(1, 10)], [(1, 11)]]):
        if features:
            table.write(spark.createDataFrame(features, "k long, n long"))
        rows = spark.createDataFrame([(1, step)], "k long, step int")
        rows.coalesce(1).write.mode("append").parquet(folder)
        monitoring.score_stream(inc.read_stream(spark, folder, rows.schema), table, score, log, checkpoint).awaitTermination()
    got = monitoring.read_log(spark, log)
    assert sorted((r.step, r.n, r.batch) for r in got.collect()) == [(0, 0, 0), (1, 10, 1), (2, 11, 2)]
    # a batch that ran but was not committed runs again: drop its commit and go on
    for name in ("2", ".2.crc"):
        (tmp_path / "cp" / "commits" / name).unlink()
    monitoring.score_stream(inc.read_stream(spark, folder, rows.schema), table, score, log, checkpoint).awaitTermination()
    assert monitoring.read_log(spark, log).count() == 3


def test_bucketed_assembly_moves_nothing(spark):
    d = storage.assembled_bucketed(spark, "/root/testdata/sf0.001")
    plan = spark._jvm.PythonSQLUtils.explainString(d._jdf.queryExecution(), "simple")
    assert plan.count("SortMergeJoin") == 3 and "Exchange" not in plan and "BroadcastHash" not in plan
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("staging_")]
    assert d.count() == storage.orders(spark, "/root/testdata/sf0.001").count()


def test_save_table_replaces(spark, tmp_path):
    for n in (5, 3):
        sinks.save_table(spark.range(n), "staging_range_test", ["id"], 2, str(tmp_path / "t"))
        assert spark.table("staging_range_test").count() == n
    a = spark.table("staging_range_test")
    assert joins.assemble_bucketed(a, ["id"], [(a.withColumn("x", F.lit(1)), "left")]).count() == 3
    sinks.drop_staging(spark, ["staging_range_test"], "staging_")
