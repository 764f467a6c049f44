"""Table models and how they are built and published."""

from sparkmart.plans.product import ModelContext, Product, relation_name
from sparkmart.plans.sales import chain_sql, convert, monthly, stage

__all__ = [
    "ModelContext",
    "Product",
    "chain_sql",
    "convert",
    "monthly",
    "relation_name",
    "stage",
]
