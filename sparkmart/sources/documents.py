"""Registry documents: JSON objects ``{"data_products": {name: record}}``.

A registry is stored as many small documents, one JSON line per record. They
are written and read in parallel, and no task ever holds the whole map. A single
many-entry document is read as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The document's top-level key, and the flags of one record.
ROOT = "data_products"
FLAGS = (
    "code_repository",
    "keycloak_group",
    "keycloak_domain_group",
    "keycloak_product_group",
    "trino_dev_catalog",
    "trino_prd_catalog",
)
RECORD = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("domain", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("admin_emails", T.ArrayType(T.StringType())),
        *[T.StructField(flag, T.BooleanType()) for flag in FLAGS],
    ]
)


def to_documents(df: DataFrame, key: str = "name", root: str = ROOT) -> DataFrame:
    """One document per row: a map with the single entry key -> record."""
    return df.select(F.create_map(F.col(key), F.struct(*df.columns)).alias(root))


def explode_documents(documents: DataFrame, root: str = ROOT) -> DataFrame:
    """The records of all documents as rows; an empty map gives none."""
    return documents.select(F.explode(root).alias("_key", "_record")).select("_record.*")


def write_documents(df: DataFrame, path: str, key: str = "name", root: str = ROOT) -> None:
    """Write records as JSON lines, NULL columns included."""
    to_documents(df, key, root).write.mode("errorifexists").option(
        "ignoreNullFields", "false"
    ).json(path)


def read_documents(
    spark: SparkSession,
    path: str,
    record: T.StructType = RECORD,
    root: str = ROOT,
    *,
    whole_file: bool = False,
) -> DataFrame:
    """Read documents back to rows. ``whole_file`` reads files that hold one
    document over many lines; such a file is one task's work, so keep it small."""
    schema = T.StructType([T.StructField(root, T.MapType(T.StringType(), record))])
    reader = spark.read.schema(schema).option("mode", "FAILFAST")
    documents = reader.option("multiLine", str(whole_file).lower()).json(path)
    return explode_documents(documents, root)
