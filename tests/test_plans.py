"""Shapes of physical plans that must hold at any scale."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import FOLDER
from tidemark.plans import QUERIES
from tidemark.sources.readers import latest_by, read_period


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(autouse=True)
def large_tables(spark):
    """Plan as if no side were small enough to broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", [
    "jn01_star_join", "jn03_one_row_and_grid", "jn05_dimension_twice", "jn07_composite_match", "jn09_nearest_point", "jn12_anti_join",
    "flt03_recent", "flt04_scalar_subquery", "ag13_compare_windows", "dq06_duplicates", "dq11_table_condition", "so04_promote_and_prune",
    "pl01_high_value_orders", "pl02_weekly_report", "pl06_sales_mart", "pl08_feature_table", "pl15_entity_mart"])
def test_no_pairwise_joins_and_no_forced_broadcasts(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    for shape in ("CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastExchange"):
        assert shape not in text


def test_top_one_is_pruned_before_the_shuffle(t):
    text = plan(latest_by(t.events, ["user_id"], [F.desc("ts")]))
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text


def test_filters_and_columns_reach_the_scan(t):
    text = plan(read_period(t.orders, "o_orderdate", 1998, 2).select("o_orderkey"))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text


def test_pair_aggregate_combines_before_the_shuffle(spark):
    text = plan(QUERIES["jn04_pair_events"](spark, FOLDER))
    assert "partial_min" in text and "Join" not in text
