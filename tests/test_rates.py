import pytest
from pyspark.errors import PySparkException

from sparkmart.operators import cross_rates, inverse_rates, pivot_rates
from sparkmart.workload.sales import exchange_rates

# Worked out by dividing the seed rates quoted against EUR.
CROSS = {
    ("EUR", "EUR"): 1.0,
    ("EUR", "USD"): 1.1,
    ("EUR", "CAD"): 1.4,
    ("EUR", "GBP"): 0.9,
    ("USD", "EUR"): 0.9090909090909091,
    ("USD", "USD"): 1.0,
    ("USD", "CAD"): 1.2727272727272725,
    ("USD", "GBP"): 0.8181818181818181,
    ("CAD", "EUR"): 0.7142857142857143,
    ("CAD", "USD"): 0.7857142857142858,
    ("CAD", "CAD"): 1.0,
    ("CAD", "GBP"): 0.6428571428571429,
    ("GBP", "EUR"): 1.1111111111111112,
    ("GBP", "USD"): 1.2222222222222223,
    ("GBP", "CAD"): 1.5555555555555554,
    ("GBP", "GBP"): 1.0,
}


@pytest.mark.parametrize("slots", [None, 1, 3, 16])
def test_cross_rates(spark, slots):
    result = cross_rates(exchange_rates(spark), "EUR", slots)
    got = {(r.from_currency, r.to_currency): r.rate for r in result.collect()}
    assert got == CROSS
    assert result.count() == 16


def test_slots_follow_the_quotes(spark):
    rates = spark.range(600).selectExpr(
        "'EUR' AS base_cur", "cast(id AS string) AS quote_cur", "1.0D + id AS rate"
    )
    found = cross_rates(rates, "EUR")
    assert found.count() == 360_000
    assert found.select("from_currency", "to_currency").distinct().count() == 360_000
    assert cross_rates(rates.limit(0), "EUR").count() == 0


def test_cross_rates_is_an_equi_join(spark, plan_of):
    plan = plan_of(cross_rates(exchange_rates(spark), "EUR"))
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_inverse_rates(spark):
    got = {r.currency: r.rate for r in inverse_rates(exchange_rates(spark), "EUR").collect()}
    assert got == {"EUR": 1.0, "USD": 1 / 1.1, "CAD": 1 / 1.4, "GBP": 1 / 0.9}


def test_pivot_is_matched_exactly(spark):
    assert pivot_rates(exchange_rates(spark), "eur").count() == 0


def test_zero_rate_raises(spark):
    rates = spark.sql("SELECT 'EUR' AS base_cur, 'XXX' AS quote_cur, 0.0D AS rate")
    for derived in (cross_rates(rates, "EUR"), inverse_rates(rates, "EUR")):
        with pytest.raises(PySparkException, match="DIVIDE_BY_ZERO"):
            derived.collect()
