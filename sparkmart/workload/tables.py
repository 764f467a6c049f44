"""The test tables, with declared schemas so that no file is read to infer them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sparkmart.sources import SourceTable
from sparkmart.workspace import shared_folder

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
        "c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
        "value double, props string"
    ),
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def zone(spark: SparkSession, schema: str) -> str:
    """A schema in the catalog with its folder, which is returned."""
    folder = f"{shared_folder(spark)}/sparkmart/zones/{schema}"
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema} LOCATION '{folder}'")
    return folder


def lay_table(spark: SparkSession, sf_dir: str, name: str, schema: str) -> SourceTable:
    """A catalog table laid over a given file, without copying it."""
    zone(spark, schema)
    spark.sql(f"DROP TABLE IF EXISTS {schema}.{name}")
    spark.catalog.createTable(
        f"{schema}.{name}",
        path=f"{sf_dir.rstrip('/')}/{name}.parquet",
        source="parquet",
        schema=T.StructType.fromDDL(SCHEMAS[name]),
    )
    return SourceTable(name, schema)
