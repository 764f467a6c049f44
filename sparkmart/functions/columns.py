"""Built-in column expressions; all of them stay inside generated code."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)


def money(value: Column) -> Column:
    """Round half up to cents; sums of the result do not depend on row order."""
    return value.cast(MONEY)


def recode(code: Column, replacements: Mapping[str, str]) -> Column:
    """Upper-case a code and replace the listed ones; NULL stays NULL."""
    upper = F.upper(code)
    cases = None
    for old, new in replacements.items():
        hit = upper == F.lit(old)
        cases = F.when(hit, new) if cases is None else cases.when(hit, new)
    return upper if cases is None else cases.otherwise(upper)


def year_number(moment: Column) -> Column:
    return F.year(moment).cast("bigint")


def month_number(moment: Column) -> Column:
    return F.month(moment).cast("bigint")
