"""The entry file's contract, and a spread of queries against their SQL."""

import subprocess
import sys
from pathlib import Path

import pytest

import catalogue
import __spark_entry__ as entry
from catalogue.check import compare, connect

SF = "/root/testdata/sf0.001"
SOME = [
    "session_intent_success", "click_features_latest", "trailing_long", "stream_sessions",
    "txn_prior_mean_median", "txn_prior_median_long", "feature_store", "pre_event_leads",
    "banded_nearest_event", "label_two_rounds", "describe_by_label_spread", "pr_points",
]


@pytest.fixture(autouse=True)
def generated_code(spark):
    """These queries run as they do in use, with generated code."""
    held = {k: spark.conf.get(k) for k in ("spark.sql.codegen.wholeStage", "spark.sql.codegen.factoryMode")}
    spark.conf.set("spark.sql.codegen.wholeStage", "true")
    spark.conf.set("spark.sql.codegen.factoryMode", "FALLBACK")
    yield
    for k, v in held.items():
        spark.conf.set(k, v)


def test_contract(spark):
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries)
    # corpus queries, where present, have tests of their own
    assert set(catalogue.queries()) - set(sql) == {
        "imputed_neighbours", "fuzzy_name_match", "gbt_scores",
    }
    assert entry.entry(spark).count() > 0


def test_entry_without_corpus_packages():
    """A package that only corpus operators need is missing: all other queries stay."""
    code = ("import sys; sys.modules['ahocorasick'] = None; sys.modules['xxhash'] = None\n"
            "import __spark_entry__ as e, catalogue\n"
            "assert set(e.queries()) == set(catalogue.queries()), len(e.queries())")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).resolve().parents[1])


@pytest.mark.parametrize("name", SOME)
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(SF), SF, name) is None


@pytest.mark.parametrize("name", [
    "click_features_latest", "sessionize_events_6h", "txn_prior_counts", "txn_last3", "prior_distinct_accounts",
    "asof_click_before_purchase", "pr_points",
])
def test_query_equals_sql_in_slices(spark, name):
    """Every key with more than 40 rows is cut; the result stays the same."""
    spark.conf.set("spark.pitfeat.small.bytes", "0")
    spark.conf.set("spark.pitfeat.slice.rows", "40")
    try:
        assert compare(spark, connect(SF), SF, name) is None
    finally:
        spark.conf.unset("spark.pitfeat.small.bytes")
        spark.conf.unset("spark.pitfeat.slice.rows")
