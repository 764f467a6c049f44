"""Compare a Spark result with the SQL twin's, columns by name and rows as a multiset."""

from __future__ import annotations

import math
import os
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        path = os.path.join(sf_dir, f"{table}.parquet")
        connection.execute(f"create view {table} as select * from '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, list):
        return tuple(_plain(item) for item in value)
    return value


def _counted(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, connection, sql: str, show: int = 5) -> str | None:
    """None when equal, else a short account of what differs."""
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    expected = _counted(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    actual = _counted(df.columns, [tuple(row) for row in df.collect()])
    if actual == expected:
        return None
    extra, missing = actual - expected, expected - actual
    return (
        f"{sum(actual.values())} rows against {sum(expected.values())}; "
        f"only in Spark {list(extra.items())[:show]}; only in SQL {list(missing.items())[:show]}"
    )
