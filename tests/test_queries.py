"""Every registered query against its SQL twin."""

import __spark_entry__ as driver
import oracle
import pytest
from sparkmart import workload

QUERIES = workload.queries()
ORACLES = workload.oracle_sql()


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    result = QUERIES[name](spark, sf_dir)
    assert oracle.differences(result, duck, ORACLES[name]) is None


def test_entry(spark):
    result = driver.entry(spark)
    assert result.columns == [
        "sales_year",
        "sales_month",
        "country_code",
        "country_name",
        "total_sales_eur",
        "transactions",
    ]
    assert result.count() > 0


@pytest.mark.parametrize("name", ["full_refresh", "model_table_contract", "source_count"])
def test_query_runs_twice(spark, sf_dir, duck, name):
    first = QUERIES[name](spark, sf_dir)
    second = QUERIES[name](spark, sf_dir)
    assert oracle.differences(second, duck, ORACLES[name]) is None
    assert oracle.differences(first, duck, ORACLES[name]) is None
