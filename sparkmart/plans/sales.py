"""Sales models: staging, currency conversion, monthly totals by country."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.functions import money, month_number, recode, year_number
from sparkmart.operators.lookups import lookup

# Country codes replaced in staging.
COUNTRY_CODES = {"UK": "GB"}


def stage(
    sales: DataFrame,
    countries: DataFrame,
    replacements: Mapping[str, str] = COUNTRY_CODES,
    **lookup_options: int,
) -> DataFrame:
    """Typed sales with normalised codes and their country's name and currency.

    ``sales`` has datetime, amount, currency, country and store_id, as text or
    typed already (casts to the same type vanish from the plan). ``countries`` has
    country_code, country_name and currency.
    """
    typed = sales.select(
        F.col("datetime").cast("timestamp_ntz").alias("sold_at"),
        F.col("amount").cast("double").alias("amount"),
        F.upper("currency").alias("currency"),
        recode(F.col("country"), replacements).alias("country_code"),
        F.col("store_id").cast("int").alias("store_id"),
    )
    return lookup(
        typed,
        countries,
        {"country_code": "country_code"},
        {"country_name": "country_name", "country_currency": "currency"},
        **lookup_options,
    )


def convert(
    staged: DataFrame,
    rates: DataFrame,
    to: str = "EUR",
    default_rate: float = 1.0,
    on_duplicate: str = "repeat",
    **lookup_options: int,
) -> DataFrame:
    """Sales in a target currency, by direct quotes; no quote means ``default_rate``.

    A currency quoted twice repeats its sales, or raises with
    ``on_duplicate="error"``.
    """
    suffix = to.lower()
    quotes = rates.where(F.upper("quote_cur") == to.upper()).select(
        "base_cur", F.col("rate").cast("double").alias("rate")
    )
    if on_duplicate not in ("repeat", "error"):
        raise ValueError(f"on_duplicate is 'repeat' or 'error', not {on_duplicate!r}")
    quoted = lookup(
        staged,
        quotes,
        {"currency": "base_cur"},
        {"_rate": "rate"},
        normalise=F.upper,
        unique=on_duplicate == "error",
        **lookup_options,
    )
    rate = F.coalesce("_rate", F.lit(default_rate))
    return quoted.select(
        "sold_at",
        "store_id",
        "country_code",
        "country_name",
        F.col("currency").alias("sale_currency"),
        F.col("amount").alias("amount_original"),
        rate.alias(f"fx_rate_to_{suffix}"),
        money(F.col("amount") * rate).alias(f"amount_{suffix}"),
    )


def monthly(converted: DataFrame, currency: str = "EUR", ordered: bool = True) -> DataFrame:
    """Total and number of sales per month and country.

    Sums are exact decimals. The order is for readers; leave it out when more
    work follows.
    """
    suffix = currency.lower()
    totals = converted.groupBy(
        year_number(F.col("sold_at")).alias("sales_year"),
        month_number(F.col("sold_at")).alias("sales_month"),
        "country_code",
        "country_name",
    ).agg(
        money(F.sum(f"amount_{suffix}")).alias(f"total_sales_{suffix}"),
        F.count("*").alias("transactions"),
    )
    if not ordered:
        return totals
    return totals.orderBy(
        *[F.asc_nulls_last(c) for c in ("sales_year", "sales_month", "country_code")]
    )


def _text(value: str) -> str:
    """A text literal for SQL whose braces name references."""
    quoted = value.replace("\\", "\\\\").replace("'", "\\'")
    return "'" + quoted.replace("{", "{{").replace("}", "}}") + "'"


def chain_sql(
    replacements: Mapping[str, str] = COUNTRY_CODES, to: str = "EUR", default_rate: float = 1.0
) -> dict[str, str]:
    """The three models above as SQL text for stored views, in the order of building.

    ``{sales}``, ``{countries}`` and ``{exchange_rates}`` are the relations they start from.
    Stored text holds no join choices: Spark makes them by size each time a view is read.
    """
    suffix = to.lower()
    recoded = "upper(country)"
    if replacements:
        cases = " ".join(f"when {_text(old)} then {_text(new)}" for old, new in replacements.items())
        recoded = f"case upper(country) {cases} else upper(country) end"
    rate = f"coalesce(q.rate, cast({default_rate} as double))"
    amount = f"cast(amount * {rate} as decimal(18,2))"
    return {
        "stg_sales": f"""
            with typed as (
                select cast(datetime as timestamp_ntz) as sold_at, cast(amount as double) as amount,
                       upper(currency) as currency, {recoded} as country_code,
                       cast(store_id as int) as store_id
                from {{sales}}
            )
            select t.*, c.country_name, c.currency as country_currency
            from typed t left join {{countries}} c on t.country_code = c.country_code
        """,
        f"fct_sales_{suffix}": f"""
            with quotes as (
                select upper(base_cur) as base_cur, cast(rate as double) as rate
                from {{exchange_rates}} where upper(quote_cur) = {_text(to.upper())}
            )
            select sold_at, store_id, country_code, country_name, currency as sale_currency,
                   amount as amount_original, {rate} as fx_rate_to_{suffix},
                   {amount} as amount_{suffix}
            from {{stg_sales}} left join quotes q on upper(currency) = q.base_cur
        """,
        f"mart_monthly_sales_{suffix}": f"""
            select cast(year(sold_at) as bigint) as sales_year,
                   cast(month(sold_at) as bigint) as sales_month, country_code, country_name,
                   cast(sum(amount_{suffix}) as decimal(18,2)) as total_sales_{suffix},
                   count(*) as transactions
            from {{fct_sales_{suffix}}} group by all
            order by sales_year nulls last, sales_month nulls last, country_code nulls last
        """,
    }
