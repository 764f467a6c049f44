"""Exchange rates by way of a pivot currency."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CURRENCIES_PER_SLOT = 256


def pivot_rates(rates: DataFrame, pivot: str) -> DataFrame:
    """(currency, rate) of all quotes with the pivot as base currency."""
    return rates.where(F.col("base_cur") == pivot).select(
        F.col("quote_cur").alias("currency"), F.col("rate").cast("double").alias("rate")
    )


def inverse_rates(rates: DataFrame, pivot: str) -> DataFrame:
    """Rates from each currency back to the pivot. A zero rate raises."""
    return pivot_rates(rates, pivot).select("currency", (1.0 / F.col("rate")).alias("rate"))


def cross_rates(rates: DataFrame, pivot: str, slots: int | None = None) -> DataFrame:
    """(from_currency, to_currency, rate) for every ordered pair of quoted currencies.

    The whole matrix is the result, so its size is the square of the currencies.
    It is built as an equi-join on a slot number: the "to" side is dealt out over
    the slots and the "from" side repeated in each, so every pair meets exactly
    once, the work spreads over the slots, and nothing need fit into a broadcast.
    Slots follow the number of quotes, ``CURRENCIES_PER_SLOT`` to one, unless given; a
    short list has a single one.
    """
    quoted = pivot_rates(rates, pivot)
    if slots is None:
        counted = quoted.agg(F.count("*")).scalar()
        count = F.greatest(F.ceil(counted / CURRENCIES_PER_SLOT), F.lit(1)).cast("bigint")
    else:
        count = F.lit(slots).cast("bigint")
    from_side = quoted.select(
        F.col("currency").alias("from_currency"),
        F.col("rate").alias("from_rate"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), count - 1)).alias("_slot"),
    )
    to_side = quoted.select(
        F.col("currency").alias("to_currency"),
        F.col("rate").alias("to_rate"),
        F.pmod(F.xxhash64("currency", "rate", F.spark_partition_id()), count).alias("_slot"),
    )
    return from_side.join(to_side, "_slot").select(
        "from_currency",
        "to_currency",
        (F.col("to_rate") / F.col("from_rate")).alias("rate"),
    )
