import difflib

import pytest
from pyspark.sql import functions as F

from pitfeat.functions import columns as c
from pitfeat.sources import sinks
from pitfeat.sources import tables as t


def values(df, *exprs):
    return [tuple(r) for r in df.select(*exprs).collect()]


def test_banks(spark):
    d = spark.createDataFrame([("a@x",), ("zz",), (None,)], "v string")
    assert [r[0] for r in values(d, c.bank_of_address("v"))] == ["x", "other", "other"]
    open_ = values(d, c.bank_of_address("v", coalesce_other=False))
    assert [r[0] for r in open_] == ["x", "other", None]
    d = spark.createDataFrame([("HDFC0001",), ("",), (None,)], "v string")
    assert [r[0] for r in values(d, c.bank_of_account("v"))] == ["HDFC", "", "other"]


def test_dimension_value(spark):
    d = spark.createDataFrame(
        [([(1, "a"), (49, "b")],), ([(1, "a")],), ([],), (None,)],
        "dims array<struct<index:int,value:string>>",
    )
    assert [r[0] for r in values(d, c.dimension_value("dims", 49))] == ["b", None, None, None]


def test_json(spark):
    d = spark.createDataFrame(
        [('{"buy":[1,2],"new-projects":[3]}',), ('{"rent":[]}',), (None,)], "v string"
    )
    total = c.json_list_total("v", ["buy", "rent", "new-projects", "pg"])
    assert [r[0] for r in values(d, total)] == [3, 0, 0]
    d = spark.createDataFrame([('{\\"orderId\\":\\"7\\"}',)], "v string")
    assert values(d.withColumn("v", c.strip_escapes("v")), c.json_value("v", "$.orderId")) == [("7",)]


def test_fill_is_typed_and_casts_forgive(spark):
    d = spark.createDataFrame([(None, None)], "n double, s string")
    assert values(c.fill(d, {"n": 0.0, "s": "other"}), "n", "s") == [(0.0, "other")]
    with pytest.raises(TypeError):
        c.fill(d, {"n": "other"})
    d = spark.createDataFrame([("12",), ("x",)], "v string")
    assert values(c.cast_all(d, {"v": "bigint"}), "v") == [(12,), (None,)]


def test_prefixes(spark):
    d = spark.createDataFrame([(1, 2)], "k long, main_main_x long")
    assert c.prefix_columns(d, "main_").columns == ["main_k", "main_main_main_x"]
    assert c.strip_prefix(d, "main_").columns == ["k", "main_x"]
    with pytest.raises(Exception):
        c.contract(d, ["k", "absent"]).columns


def brute_match(a, b, tokens):
    left = a.lower().split()
    for x in left if tokens == "all" else left[:1]:
        for y in b.lower().split():
            if x in y or y in x or difflib.SequenceMatcher(None, x, y).ratio() >= 0.7:
                return True
    return False


@pytest.mark.parametrize("tokens", ["all", "first"])
def test_name_match(spark, tokens):
    names = ["aaa smith", "smith", "Jon Smyth", "john", "Johnny b", "bob stone", "smithe", "abcd xyz"]
    pairs = [(a, b) for a in names for b in names]
    d = spark.createDataFrame([*pairs, (None, "x"), pairs[0]], "a string, b string")
    got = c.name_match(d, "a", "b", "same", tokens=tokens).collect()
    assert len(got) == len(pairs) + 2
    for r in got:
        assert r.same == (r.a is not None and brute_match(r.a, r.b, tokens)), r


def test_payload(spark):
    body = '{"data":{"rows":[{"orderId":1,"when":1000},{"orderId":2,"when":2500}]}}'
    schema = "struct<data:struct<rows:array<struct<orderId:bigint,when:bigint>>>>"
    d = spark.createDataFrame([(body,), (None,)], "body string")
    got = t.explode_payload(d, "body", schema, "data.rows", {"orderId": "order_id"}, {"when": "at"})
    assert values(got, "order_id", F.unix_millis("at")) == [(1, 1000), (2, 2500)]
    with pytest.raises(ValueError):
        t.explode_payload(d, "body", schema, "data.rows", {"orderId": "x", "when": "x"})
    with pytest.raises(ValueError):
        t.explode_payload(d, "body", schema, "data.rows", {"orderId": "when"})


def test_pruned_read(spark, tmp_path):
    path = str(tmp_path / "x.parquet")
    spark.sql(
        "select id, cast('2024-01-01' as timestamp_ntz) + make_dt_interval(cast(id as int)) as t "
        "from range(10)"
    ).write.parquet(path)
    d = t.read_table(spark, path, "t", "2024-01-03", "2024-01-05")
    assert sorted(r.id for r in d.collect()) == [2, 3]
    assert dict(d.dtypes)["t"] == "timestamp"
    plan = spark._jvm.PythonSQLUtils.explainString(d._jdf.queryExecution(), "formatted")
    assert "GreaterThanOrEqual(t" in plan and "LessThan(t" in plan
    assert t.since_days(d, "t", "2024-01-05", 1).count() == 1


def test_csv_and_guards(spark, tmp_path):
    d = spark.createDataFrame([(1, "a")], "k int, v string")
    sinks.write_csv(d, str(tmp_path / "csv"))
    assert values(t.read_csv(spark, str(tmp_path / "csv"), "k int, v string"), "k", "v") == [(1, "a")]
    empty = t.table_or_empty(spark, "no_such_table", "k int")
    assert t.is_empty(empty) and empty.columns == ["k"]


def test_jdbc_snapshot_query():
    assert t.snapshot_query("e", "id", 9, ["a"], "k in (1)") == (
        "(SELECT a FROM e WHERE id <= 9 AND (k in (1))) t"
    )
    assert t.snapshot_query("e", "id", None) == "(SELECT * FROM e WHERE 1 = 0) t"


def test_versioned_table(spark, tmp_path):
    table = sinks.VersionedTable(spark, str(tmp_path / "v"))
    assert table.read() is None and table.current() is None
    table.write(spark.createDataFrame([(1,)], "k long"))
    # a table may be rewritten from itself
    table.write(table.read().withColumn("k", F.col("k") + 1))
    table.write(table.read().withColumn("k", F.col("k") + 1), files=1)
    assert values(table.read(), "k") == [(3,)] and table.versions() == [2, 3]
    # a version without the success mark does not exist for readers
    (tmp_path / "v" / "version=000000000009").mkdir()
    assert table.current() == 3


def test_logs_and_merged_schema(spark, tmp_path):
    d = spark.createDataFrame([(1,)], "k long")
    for _ in range(2):
        sinks.append_log(d, str(tmp_path / "log"), "r1", "2024-01-01 00:00:00")
    sinks.append_log(d, str(tmp_path / "log"), "r2", "2024-01-02 00:00:00")
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2
    path = str(tmp_path / "m")
    sinks.append_merging(d, path)
    sinks.append_merging(d.withColumn("x", F.lit(1)), path)
    assert set(sinks.read_merged(spark, path).columns) == {"k", "x"}
    with pytest.raises(ValueError):
        sinks.drop_staging(spark, ["main"], "stage_")
    sinks.drop_staging(spark, ["stage_a"], "stage_")


@pytest.mark.parametrize("measure", ["blocks", "levenshtein"])
def test_name_match_moves_no_row(spark, measure):
    """Every row is judged where it lies; copies and nulls are kept."""
    d = spark.createDataFrame([("ab cd", "xx cde"), ("ab cd", "xx cde"), ("abcd", "wxyz"), (None, "x"), ("", "x")], "a string, b string")
    got = c.name_match(d, "a", "b", "same", measure=measure)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    assert sorted(r.same for r in got.collect()) == [False, False, False, True, True]
