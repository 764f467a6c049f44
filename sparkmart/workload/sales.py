"""Sales models over orders, customers and nations.

A sale is an order; its country is the customer's nation, its currency that of
the nation's region. One nation's code is an old spelling of another's, one is
not in the country list, and one region's currency has no quote in EUR.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.functions import money
from sparkmart.operators import lookup
from sparkmart.plans.sales import convert, monthly, stage
from sparkmart.workload.tables import load

REPLACEMENTS = {"NATION_1": "NATION_2", "NATION_24": "NATION_99"}

# Seed exchange rates (base currency, quote currency, rate).
RATES = """
    ('EUR', 'EUR', 1), ('USD', 'USD', 1), ('CAD', 'CAD', 1), ('GBP', 'GBP', 1),
    ('EUR', 'USD', 1.1), ('EUR', 'CAD', 1.4), ('EUR', 'GBP', 0.9),
    ('USD', 'EUR', 0.91), ('USD', 'CAD', 1.27), ('USD', 'GBP', 0.82),
    ('CAD', 'EUR', 0.71), ('CAD', 'USD', 0.79), ('CAD', 'GBP', 0.65),
    ('GBP', 'EUR', 1.11), ('GBP', 'USD', 1.22), ('GBP', 'CAD', 1.54)
"""

# Currencies of Africa, America, Asia, Europe and the Middle East, in mixed case.
REGION_CURRENCY = """
    case n_regionkey when 0 then 'gbp' when 1 then 'usd' when 2 then 'jpy'
    when 3 then 'Eur' else 'Cad' end
"""


def exchange_rates(spark: SparkSession) -> DataFrame:
    return spark.sql(
        "SELECT base_cur, quote_cur, cast(rate AS double) AS rate "
        f"FROM VALUES {RATES} AS rates(base_cur, quote_cur, rate)"
    )


def nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """25 nations with their region's currency."""
    return load(spark, sf_dir, "nation").withColumn("currency", F.expr(REGION_CURRENCY))


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nations(spark, sf_dir).select(
        F.col("n_name").alias("country_code"),
        F.initcap(F.replace("n_name", F.lit("_"), F.lit(" "))).alias("country_name"),
        F.upper("currency").alias("currency"),
    )


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    buyers = load(spark, sf_dir, "customer").join(
        nations(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    sold = lookup(
        load(spark, sf_dir, "orders"),
        buyers,
        {"o_custkey": "c_custkey"},
        {"nation": "n_name", "nation_currency": "currency", "store": "c_nationkey"},
    )
    return sold.select(
        F.col("o_orderdate").alias("datetime"),
        F.col("o_totalprice").alias("amount"),
        F.col("nation_currency").alias("currency"),
        F.lower("nation").alias("country"),
        F.col("store").alias("store_id"),
    )


def staged_sales(spark: SparkSession, sf_dir: str, **lookup_options: int) -> DataFrame:
    return stage(
        raw_sales(spark, sf_dir), countries(spark, sf_dir), REPLACEMENTS, **lookup_options
    )


def converted_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convert(staged_sales(spark, sf_dir), exchange_rates(spark))


def stg_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging of a raw table that is all text."""
    raw = raw_sales(spark, sf_dir)
    text = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])
    return stage(text, countries(spark, sf_dir), REPLACEMENTS)


def stg_sales_large_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same staging by the way for dimensions too large to broadcast."""
    return staged_sales(spark, sf_dir, broadcast_bytes=0, rows_per_task=1000)


def lookup_skewed_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines against all orders, shuffled; one order gets a share of all lines."""
    lines = load(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linenumber") == 1, 1).otherwise(F.col("l_orderkey")).alias("order_key"),
        "l_linenumber",
        "l_quantity",
    )
    orders = load(spark, sf_dir, "orders")
    taken = {"status": "o_orderstatus", "customer": "o_custkey"}
    joined = lookup(
        lines, orders, {"order_key": "o_orderkey"}, taken, broadcast_bytes=0, rows_per_task=500
    )
    return joined.groupBy("order_key", "status", "customer").agg(
        F.count("*").alias("lines"),
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("decimal(18,2)").alias("quantity"),
    )


def lookup_wide_skew(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents against the largest one of each key, shuffled; all long texts share a key that
    has few rows and many of the bytes."""
    keyed = load(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(F.col("n_chars") > 8000, "long").otherwise(F.col("source")).alias("shelf"),
        "text",
        "n_chars",
    )
    largest = keyed.groupBy("shelf").agg(F.max("n_chars").alias("largest"))
    joined = lookup(
        keyed.withColumn("text_key", F.md5("text")),
        largest,
        {"shelf": "shelf"},
        {"largest": "largest"},
        broadcast_bytes=0,
        task_bytes=1 << 18,
    )
    return joined.select("doc_id", "shelf", "text", "text_key", "largest")


def fct_sales_converted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return converted_sales(spark, sf_dir)


def mart_monthly_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly(converted_sales(spark, sf_dir))


def fx_missing_rate_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Currencies without a EUR quote, which count at par."""
    quoted = exchange_rates(spark).where("quote_cur = 'EUR'")
    unquoted = converted_sales(spark, sf_dir).join(
        quoted, F.col("sale_currency") == F.col("base_cur"), "left_anti"
    )
    return unquoted.groupBy("sale_currency", "fx_rate_to_eur").agg(
        F.sum(money(F.col("amount_original"))).cast("decimal(18,2)").alias("total_original"),
        F.sum("amount_eur").cast("decimal(18,2)").alias("total_eur"),
        F.count("*").alias("transactions"),
    )


def dim_miss_and_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension that lacks one region's nations and lists another's twice."""
    region = load(spark, sf_dir, "region")
    known = load(spark, sf_dir, "nation").join(
        region, F.col("n_regionkey") == F.col("r_regionkey"), "left"
    )
    listed = known.where("r_name <> 'ASIA'").select(
        "n_nationkey", F.col("n_name").alias("country_name")
    )
    again = known.where("r_name = 'EUROPE'").select(
        "n_nationkey", F.concat("n_name", F.lit(" (old)")).alias("country_name")
    )
    return lookup(
        load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey"),
        listed.union(again),
        {"c_nationkey": "n_nationkey"},
        {"country_name": "country_name"},
    )


QUERIES = {
    "stg_sales": stg_sales,
    "stg_sales_large_dimension": stg_sales_large_dimension,
    "lookup_skewed_large": lookup_skewed_large,
    "lookup_wide_skew": lookup_wide_skew,
    "fct_sales_converted": fct_sales_converted,
    "mart_monthly_sales": mart_monthly_sales,
    "fx_missing_rate_default": fx_missing_rate_default,
    "dim_miss_and_fanout": dim_miss_and_fanout,
}

_STAGED = f"""
nations as (
    select n_nationkey, n_name, {REGION_CURRENCY} as currency from nation
),
countries as (
    select n_name as country_code, replace(n_name, 'NATION_', 'Nation ') as country_name,
           upper(currency) as currency
    from nations
),
sales as (
    select o_orderdate as datetime, o_totalprice as amount, n.currency,
           lower(n_name) as country, c_nationkey as store_id
    from orders
    left join customer on o_custkey = c_custkey
    left join nations n on c_nationkey = n_nationkey
),
typed as (
    select cast(datetime as timestamp) as sold_at, cast(amount as double) as amount,
           upper(currency) as currency,
           case upper(country) when 'NATION_1' then 'NATION_2' when 'NATION_24' then 'NATION_99'
                else upper(country) end as country_code,
           cast(store_id as integer) as store_id
    from sales
),
staged as (
    select t.*, c.country_name, c.currency as country_currency
    from typed t left join countries c on t.country_code = c.country_code
)
"""

_CONVERTED = f"""
{_STAGED},
rates(base_cur, quote_cur, rate) as (values {RATES}),
converted as (
    select sold_at, store_id, country_code, country_name, currency as sale_currency,
           amount as amount_original,
           coalesce(cast(rate as double), 1.0) as fx_rate_to_eur,
           cast(cast(amount * coalesce(cast(rate as double), 1.0) as varchar) as decimal(18,2))
               as amount_eur
    from staged left join rates on upper(currency) = upper(base_cur) and quote_cur = 'EUR'
)
"""

MART = f"""
with {_CONVERTED}
select cast(extract(year from sold_at) as bigint) as sales_year,
       cast(extract(month from sold_at) as bigint) as sales_month,
       country_code, country_name,
       cast(sum(amount_eur) as decimal(18,2)) as total_sales_eur,
       count(*) as transactions
from converted group by 1, 2, 3, 4 order by 1, 2, 3
"""

ORACLES = {
    "stg_sales": f"with {_STAGED} select * from staged",
    "stg_sales_large_dimension": f"with {_STAGED} select * from staged",
    "lookup_skewed_large": """
        select order_key, o_orderstatus as status, o_custkey as customer, count(*) as lines,
               cast(sum(cast(l_quantity as decimal(18,2))) as decimal(18,2)) as quantity
        from (select case when l_linenumber = 1 then 1 else l_orderkey end as order_key,
                     l_quantity from lineitem)
        left join orders on order_key = o_orderkey
        group by 1, 2, 3
    """,
    "lookup_wide_skew": """
        with keyed as (
            select *, case when n_chars > 8000 then 'long' else source end as shelf from documents
        )
        select doc_id, shelf, text, md5(text) as text_key,
               max(n_chars) over (partition by shelf) as largest
        from keyed
    """,
    "fct_sales_converted": f"with {_CONVERTED} select * from converted",
    "mart_monthly_sales": MART,
    "fx_missing_rate_default": f"""
        with {_CONVERTED}
        select sale_currency, fx_rate_to_eur,
               cast(sum(cast(amount_original as decimal(18,2))) as decimal(18,2))
                   as total_original,
               cast(sum(amount_eur) as decimal(18,2)) as total_eur,
               count(*) as transactions
        from converted
        where sale_currency not in (select base_cur from rates where quote_cur = 'EUR')
        group by 1, 2
    """,
    "dim_miss_and_fanout": """
        with known as (
            select * from nation join region on n_regionkey = r_regionkey
        ), listed as (
            select n_nationkey, n_name as country_name from known where r_name <> 'ASIA'
            union all
            select n_nationkey, n_name || ' (old)' from known where r_name = 'EUROPE'
        )
        select c_custkey, c_name, c_nationkey, country_name
        from customer left join listed on c_nationkey = n_nationkey
    """,
}
