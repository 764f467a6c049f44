"""Plans of the headline queries: what is scanned, shuffled and pushed down."""

import re

import pytest

from sparkmart import workload

QUERIES = workload.queries()


@pytest.fixture
def plan(spark, sf_dir, plan_of):
    return lambda name, mode="simple": plan_of(QUERIES[name](spark, sf_dir), mode)


def test_fact_is_never_shuffled(plan):
    text = plan("fct_sales_converted")
    assert text.count("BroadcastHashJoin") == 4
    assert "Exchange hashpartitioning" not in text


def test_mart_shuffles_partial_sums_only(plan):
    text = plan("mart_monthly_sales")
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("Exchange rangepartitioning") == 1
    assert "partial_sum" in text


def test_mart_reads_three_order_columns(plan):
    scans = re.findall(r"orders.parquet.*?ReadSchema: (struct<[^>]*>)", plan("mart_monthly_sales"))
    assert scans == ["struct<o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>"]


def test_sort_vanishes_under_an_aggregate(spark, sf_dir, plan_of):
    total = QUERIES["mart_monthly_sales"](spark, sf_dir).groupBy().sum("transactions")
    assert "Sort" not in plan_of(total, "simple")


def test_pivot_filter_reaches_the_orders(plan):
    assert "EqualTo(o_orderstatus,O)" in plan("cross_rates")


def test_cross_rates_aggregate_once(spark, sf_dir, plan_of):
    rates = QUERIES["cross_rates"](spark, sf_dir)
    rates.collect()
    final = plan_of(rates, "simple").split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_joins_python_or_single_task_windows(plan, name):
    text = plan(name)
    for operator in ("CartesianProduct", "NestedLoopJoin", "PythonUDF", "EvalPython", "Window"):
        assert operator not in text


@pytest.mark.parametrize("name", ["policy_row_filter", "policy_no_identity"])
def test_row_filter_is_pushed(plan, name):
    assert "Not(EqualTo(c_mktsegment,BUILDING))" in plan(name)


def test_insert_counts_the_batch_once(spark, sf_dir, plan_of):
    outcome = QUERIES["registry_insert_absent"](spark, sf_dir)
    outcome.collect()
    final = plan_of(outcome, "simple").split("== Initial Plan ==")[0]
    assert final.count("ReusedExchange") >= 2
