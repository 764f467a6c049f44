"""Cross rates over rates that come out of the order and customer tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.functions import money
from sparkmart.operators import cross_rates as rate_matrix
from sparkmart.operators import inverse_rates as rates_back
from sparkmart.operators import lookup
from sparkmart.workload.tables import load


def price_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A nation's rate against an order status is its mean order price there."""
    buyers = load(spark, sf_dir, "customer").join(
        load(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    priced = lookup(
        load(spark, sf_dir, "orders"), buyers, {"o_custkey": "c_custkey"}, {"nation": "n_name"}
    )
    return priced.groupBy(
        F.col("o_orderstatus").alias("base_cur"), F.col("nation").alias("quote_cur")
    ).agg(
        (F.sum(money(F.col("o_totalprice"))).cast("double") / F.count("*")).alias("rate")
    )


def balance_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A nation's rate against a market segment is its total balance there."""
    held = load(spark, sf_dir, "customer").join(
        load(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return held.groupBy(
        F.col("c_mktsegment").alias("base_cur"), F.col("n_name").alias("quote_cur")
    ).agg(F.sum(money(F.col("c_acctbal"))).cast("double").alias("rate"))


def cross_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rate_matrix(price_levels(spark, sf_dir), "O")


def inverse_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates_back(price_levels(spark, sf_dir), "O")


def cross_ratio_by_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rate_matrix(balance_levels(spark, sf_dir), "MACHINERY").select(
        "from_currency", "to_currency", F.round("rate", 6).alias("rate")
    )


QUERIES = {
    "cross_rates": cross_rates,
    "inverse_rates": inverse_rates,
    "cross_ratio_by_nation": cross_ratio_by_nation,
}

_PRICES = """
with rates as (
    select o_orderstatus as base_cur, n_name as quote_cur,
           cast(sum(cast(o_totalprice as decimal(18,2))) as double) / count(*) as rate
    from orders join customer on o_custkey = c_custkey
    join nation on c_nationkey = n_nationkey
    group by 1, 2
), quoted as (select quote_cur as currency, rate from rates where base_cur = 'O')
"""

CROSS = f"""
{_PRICES}
select a.currency as from_currency, b.currency as to_currency, b.rate / a.rate as rate
from quoted a cross join quoted b
"""

ORACLES = {
    "cross_rates": CROSS,
    "inverse_rates": f"{_PRICES} select currency, 1 / rate as rate from quoted",
    "cross_ratio_by_nation": """
        with quoted as (
            select n_name as currency,
                   cast(sum(cast(c_acctbal as decimal(18,2))) as double) as rate
            from customer join nation on c_nationkey = n_nationkey
            where c_mktsegment = 'MACHINERY'
            group by 1
        )
        select a.currency as from_currency, b.currency as to_currency,
               round(b.rate / a.rate, 6) as rate
        from quoted a cross join quoted b
    """,
}
