"""Physical plans: what must be pushed down, and what must not appear."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from suite.panels import TIES
from suite.registry import table

QUERIES = entry_module.queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["blocked_streak_rate", "panel_rates", "recent_n", "velocity", "error_buckets", "group_avg_rows"])
def test_no_cross_join(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["blocked_streak_rate", "panel_rates", "recent_n", "group_avg_rows"])
def test_no_single_partition(spark, sf_dir, name):
    assert "SinglePartition" not in plan(QUERIES[name](spark, sf_dir))


def test_recency_limit_runs_before_the_shuffle(spark, sf_dir):
    text = plan(QUERIES["recent_n"](spark, sf_dir))
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_only_needed_columns_are_read(spark, sf_dir):
    text = plan(QUERIES["panel_rates"](spark, sf_dir))
    assert "l_extendedprice" not in text and "l_quantity" not in text


def test_price_filter_reaches_the_scan(spark, sf_dir):
    from hearthrate.operators.clean import cap_price

    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(12,2)").alias("price"))
    assert "DataFilters" in plan(cap_price(orders, cap=1000.0))


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_partitioning_does_not_change_results(spark, sf_dir, parts):
    from hearthrate.operators import panel

    lines = table(spark, sf_dir, "lineitem").repartition(parts, "l_suppkey")
    out = panel.blocked_streaks(lines, "l_partkey", "l_shipdate", TIES, F.col("l_returnflag") == "R")
    base = QUERIES["blocked_streak_rate"](spark, sf_dir)
    columns = ["l_partkey", "dates", "blocked_dates", "streaks"]
    assert out.select(columns).exceptAll(base.select(columns)).count() == 0
