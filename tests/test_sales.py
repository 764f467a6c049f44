"""The sales models on hand-made rows, against the totals in FIXTURES.md."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException

from sparkmart.operators import DuplicateKeyError
from sparkmart.plans import convert, monthly, stage
from sparkmart.sources import read_seed
from sparkmart.workload.sales import exchange_rates

# Seed rows of sales and countries.
SALES = """datetime,amount,currency,country,store_id
2023-01-01 10:00:00,100,USD,US,1
2023-01-02 11:30:00,150,USD,US,1
2023-01-03 12:45:00,200,USD,US,2
2023-01-04 14:00:00,250,EUR,DE,3
2023-01-05 15:15:00,300,EUR,DE,3
2023-01-06 16:30:00,350,GBP,UK,4
2023-01-07 17:45:00,400,GBP,UK,4
2023-01-08 18:00:00,450,CAD,CA,5
2023-01-09 19:15:00,500,CAD,CA,5
2023-01-10 20:30:00,550,USD,US,2"""
COUNTRIES = """country_code,country_name,currency
US,United States,USD
CA,Canada,CAD
GB,United Kingdom,GBP
FR,France,EUR
DE,Germany,EUR"""


@pytest.fixture
def seeds(spark, tmp_path):
    (tmp_path / "sales.csv").write_text(SALES)
    (tmp_path / "countries.csv").write_text(COUNTRIES)
    return (
        read_seed(spark, str(tmp_path / "sales.csv")),
        read_seed(spark, str(tmp_path / "countries.csv")),
    )


def raw(spark, *rows):
    return spark.createDataFrame(
        rows, "datetime string, amount string, currency string, country string, store_id string"
    )


def no_countries(spark):
    return spark.createDataFrame(
        [], "country_code string, country_name string, currency string"
    )


def test_staging_types_and_codes(seeds):
    staged = stage(*seeds)
    assert dict(staged.dtypes) == {
        "sold_at": "timestamp_ntz",
        "amount": "double",
        "currency": "string",
        "country_code": "string",
        "store_id": "int",
        "country_name": "string",
        "country_currency": "string",
    }
    row = staged.where("store_id = 4").orderBy("sold_at").first()
    assert row.sold_at == dt.datetime(2023, 1, 6, 16, 30)
    assert (row.country_code, row.country_name, row.country_currency) == (
        "GB",
        "United Kingdom",
        "GBP",
    )


def test_fact_amounts(spark, seeds):
    fact = convert(stage(*seeds), exchange_rates(spark))
    assert dict(fact.dtypes)["amount_eur"] == "decimal(18,2)"
    amounts = [row.amount_eur for row in fact.orderBy("sold_at").collect()]
    assert amounts == [
        Decimal(text)
        for text in "91.00 136.50 182.00 250.00 300.00 388.50 444.00 319.50 355.00 500.50".split()
    ]


def test_monthly_totals_in_order(spark, seeds):
    mart = monthly(convert(stage(*seeds), exchange_rates(spark)))
    assert [tuple(row) for row in mart.collect()] == [
        (2023, 1, "CA", "Canada", Decimal("674.50"), 2),
        (2023, 1, "DE", "Germany", Decimal("550.00"), 2),
        (2023, 1, "GB", "United Kingdom", Decimal("832.50"), 2),
        (2023, 1, "US", "United States", Decimal("910.00"), 4),
    ]
    assert [kind for _, kind in mart.dtypes] == [
        "bigint",
        "bigint",
        "string",
        "string",
        "decimal(18,2)",
        "bigint",
    ]


def test_other_target_currency(spark, seeds):
    fact = convert(stage(*seeds), exchange_rates(spark), to="usd")
    assert {"fx_rate_to_usd", "amount_usd"} <= set(fact.columns)
    total = monthly(fact, "usd", ordered=False).where("country_code = 'DE'").first()
    assert total.total_sales_usd == Decimal("605.00")


def test_nulls_and_mixed_case(spark):
    sales = raw(
        spark,
        (None, "1.005", "usd", "uk", "1"),
        ("2024-02-29 00:00:00", None, None, None, None),
        ("2024-02-29 00:00:00", "0.145", "xyz", "zz", "2"),
    )
    staged = stage(sales, no_countries(spark))
    got = convert(staged, exchange_rates(spark)).orderBy("store_id").collect()
    assert [(r.country_code, r.country_name, r.sale_currency) for r in got] == [
        (None, None, None),
        ("GB", None, "USD"),
        ("ZZ", None, "XYZ"),
    ]
    assert [r.fx_rate_to_eur for r in got] == [1.0, 0.91, 1.0]
    assert [r.amount_eur for r in got] == [None, Decimal("0.91"), Decimal("0.15")]


def test_half_cents_round_up(spark):
    sales = raw(spark, *[("2024-01-01 00:00:00", a, "EUR", "DE", "1") for a in ("1.005", "-1.005")])
    fact = convert(stage(sales, no_countries(spark)), exchange_rates(spark))
    assert sorted(r.amount_eur for r in fact.collect()) == [Decimal("-1.01"), Decimal("1.01")]


def test_null_keys_form_one_group_and_sort_last(spark):
    sales = raw(
        spark,
        (None, "1", "EUR", None, "1"),
        (None, "2", "EUR", None, "1"),
        ("2024-01-01 00:00:00", "3", "EUR", "DE", "1"),
    )
    mart = monthly(convert(stage(sales, no_countries(spark)), exchange_rates(spark))).collect()
    assert [(r.sales_year, r.country_code, r.total_sales_eur, r.transactions) for r in mart] == [
        (2024, "DE", Decimal("3.00"), 1),
        (None, None, Decimal("3.00"), 2),
    ]


@pytest.mark.parametrize("column", ["amount", "store_id", "datetime"])
def test_bad_cells_raise(spark, column):
    row = {"datetime": "2024-01-01 00:00:00", "amount": "1", "store_id": "1"} | {column: "x"}
    sales = raw(spark, (row["datetime"], row["amount"], "EUR", "DE", row["store_id"]))
    with pytest.raises(PySparkException, match="CAST_INVALID_INPUT"):
        stage(sales, no_countries(spark)).collect()


def test_doubled_rate_repeats_or_raises(spark):
    rates = exchange_rates(spark).union(
        spark.sql("SELECT 'usd' AS base_cur, 'eur' AS quote_cur, 2.0D AS rate")
    )
    sales = raw(spark, ("2024-01-01 00:00:00", "10", "USD", "US", "1"))
    staged = stage(sales, no_countries(spark))
    amounts = sorted(r.amount_eur for r in convert(staged, rates).collect())
    assert amounts == [Decimal("9.10"), Decimal("20.00")]
    with pytest.raises(DuplicateKeyError, match="USD"):
        convert(staged, rates, on_duplicate="error")
    with pytest.raises(ValueError, match="on_duplicate"):
        convert(staged, rates, on_duplicate="drop")


def test_doubled_country_repeats_sales(spark, seeds):
    sales, countries = seeds
    doubled = countries.union(countries.where("country_code = 'US'"))
    assert stage(sales, doubled).count() == 14
