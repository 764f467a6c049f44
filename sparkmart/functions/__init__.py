"""Column expressions shared by the models."""

from sparkmart.functions.columns import money, month_number, recode, year_number

__all__ = ["money", "month_number", "recode", "year_number"]
