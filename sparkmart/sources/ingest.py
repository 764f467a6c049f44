"""Full-refresh ingest: read every stream of a catalog and replace its table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from sparkmart.sources.delimited import read_stream
from sparkmart.sources.raw import land_raw
from sparkmart.sources.tables import full_refresh


def sync_streams(
    spark: SparkSession,
    source: Mapping,
    catalog: Mapping,
    schema: str,
    *,
    raw: bool = False,
    base_folder: str | None = None,
    root: str | None = None,
) -> dict[str, DataFrame]:
    """Read the catalog's streams from ``source`` into tables of ``schema``.

    Each stream replaces the table of its name, or with ``raw`` the table
    ``<name>_raw_data`` of JSON records. Gives the tables by their names.
    """
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}" + (f" LOCATION '{root}'" if root else ""))
    tables = {}
    for stream in catalog["streams"]:
        mode = stream.get("destination_sync_mode", "overwrite")
        if mode != "overwrite":
            raise ValueError(f"unsupported destination sync mode {mode!r}")
        rows = read_stream(spark, source, stream, base_folder=base_folder)
        name = stream["stream"]["name"]
        if raw:
            rows, name = land_raw(rows), f"{name}_raw_data"
        tables[name] = full_refresh(rows, f"{schema}.{name}", root)
    return tables
