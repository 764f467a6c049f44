"""Registered queries over the test tables, each with its SQL twin for the check."""

from sparkmart.workload import policies, products, rates, registry, sales, sources

MODULES = (sales, rates, sources, policies, products, registry)


def queries():
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql():
    return {name: text for module in MODULES for name, text in module.ORACLES.items()}
