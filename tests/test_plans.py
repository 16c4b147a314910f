"""Shapes of the physical plans when no table is small enough to broadcast by itself."""

import re

import pytest

from __spark_entry__ import queries

NAMES = ["news_ratio_12m", "training_mart", "finance_asof_pivot", "trade_share_delta", "macro_asof_12m", "split_halves",
         "article_tags", "filing_select", "stratified_split", "random_oversample", "smote", "adasyn"]


@pytest.fixture(scope="module")
def plan(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield lambda name: queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    spark.conf.set(key, before)


@pytest.mark.parametrize("name", NAMES)
def test_joins_have_keys_and_no_row_python(plan, name):
    assert not re.findall("CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython", plan(name))


def test_folds_walk_the_data_once(plan):
    """One broadcast of the prefixes that hold boundaries and one of the cuts, for all folds together."""
    assert plan("stratified_folds").count("BroadcastExchange") == 2


def test_only_calendar_tables_are_broadcast(plan):
    for name, tables in (("news_ratio_12m", 0), ("macro_asof_12m", 1), ("training_mart", 2)):
        assert plan(name).count("BroadcastExchange") == tables


def test_scans_read_only_needed_columns(plan):
    text = plan("text_cleanse")
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint>" in plan("news_ratio_12m")


@pytest.mark.parametrize("name", ["news_ratio_12m", "trade_share_delta", "stock_lookback"])
def test_date_bounds_reach_the_stored_column(plan, name):
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\([lo]_(ship|order)date", plan(name))
