"""Parquet tables: declared sources and full-refresh replacement.

A refreshed relation is a stored view, its pointer, over a version: a table that is written once,
with files and layout of its own, and never changed. To publish a version is to alter the pointer's
text, one step in the catalog whatever has changed in the layout, so a reader finds the old rows or
the new ones and never neither. Versions are kept in a schema of their own beside the relation's.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from sparkmart.workspace import shared_folder


@dataclass(frozen=True)
class SourceTable:
    """A table that someone else fills, named by schema and optional catalog."""

    table: str
    schema: str
    catalog: str | None = None

    @property
    def full_name(self) -> str:
        parts = [self.catalog, self.schema, self.table]
        return ".".join(f"`{part}`" for part in parts if part)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.full_name)


def write_parquet(df: DataFrame, path: str) -> DataFrame:
    """Write to a path not yet in use and return a DataFrame that reads it."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _literal(text: str) -> str:
    return "'" + str(text).replace("\\", "\\\\").replace("'", "\\'") + "'"


def full_refresh(
    df: DataFrame,
    table: str,
    root: str | None = None,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Replace all rows of ``table`` by ``df`` and return the table.

    The rows go to a version in a new directory below ``root`` first, and only then is the
    table pointed at it, in one step, whether the layout is the old one or not. So ``df`` may read
    the very table it replaces, a failed write or a failed step leaves the old content in place,
    and running readers keep their files. Old versions stay until ``remove_superseded``. Only a
    table that something else made under this name is dropped first.
    """
    spark = df.sparkSession
    publish(spark, table, store_version(df, table, root), properties or {})
    return spark.table(table)


def _parts(name: str) -> list[str]:
    return [quoted or plain for quoted, plain in re.findall(r"`([^`]+)`|([^.`]+)", name)]


def _quoted(parts: list[str]) -> str:
    return ".".join(f"`{part}`" for part in parts)


def versions_schema(spark: SparkSession, table: str) -> str:
    """The schema that holds the versions of the tables of ``table``'s schema."""
    *catalog, schema = _parts(table)[:-1] or [spark.catalog.currentDatabase()]
    return _quoted([*catalog, f"{schema}__versions"])


def _new_version(spark: SparkSession, table: str) -> tuple[str, str]:
    """The name of a version not yet made, and the part of it that is its own."""
    schema, own = versions_schema(spark, table), uuid.uuid4().hex
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    return f"{schema}.`{_parts(table)[-1]}__{own}`", own


def store_version(df: DataFrame, table: str, root: str | None = None) -> str:
    """Write the rows of ``df`` as a version of ``table`` that nothing points at yet."""
    spark = df.sparkSession
    version, own = _new_version(spark, table)
    location = f"{_folder(spark, table, root)}/{own}"
    df.write.mode("errorifexists").parquet(location)
    spark.catalog.createTable(version, path=location, source="parquet", schema=df.schema)
    return version


def store_view_version(rows: DataFrame, text: str, view: str) -> str:
    """Store SQL ``text`` as a version of ``view``, with the column order and comments of ``rows``."""
    spark = rows.sparkSession
    version, _ = _new_version(spark, view)
    columns = []
    for field in rows.schema.fields:
        comment = field.metadata.get("comment")
        columns.append(f"`{field.name}`" + (f" COMMENT {_literal(comment)}" if comment else ""))
    selected = ", ".join(f"`{name}`" for name in rows.columns)
    spark.sql(f"CREATE VIEW {version} ({', '.join(columns)}) AS SELECT {selected} FROM ({text})")
    return version


def publish(
    spark: SparkSession, table: str, version: str | None, properties: Mapping[str, str]
) -> None:
    """Point ``table`` at ``version``; without a version, take the name away.

    The tags follow in steps of their own, where they differ.
    """
    if version is None:
        spark.sql(f"DROP VIEW IF EXISTS {table}")
        return
    columns = ", ".join(f"`{name}`" for name in spark.table(version).columns)
    text = f"SELECT {columns} FROM {version}"
    if spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType == "VIEW":
        # Altered and not replaced: to replace a view is to drop and create it.
        spark.sql(f"ALTER VIEW {table} AS {text}")
        _set_tags(spark, table, properties)
        return
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    tags = f" TBLPROPERTIES ({_pairs(properties)})" if properties else ""
    spark.sql(f"CREATE VIEW {table}{tags} AS {text}")


def published_version(spark: SparkSession, table: str) -> str | None:
    """The version that ``table`` points at."""
    if not spark.catalog.tableExists(table):
        return None
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    text = described.where("col_name = 'View Text'").first()
    found = re.search(r" FROM (\S+__[0-9a-f]{32}`)$", text["data_type"]) if text else None
    return found[1] if found else None


def publish_all(spark: SparkSession, schema: str, found: Mapping[str, tuple[str, dict]]) -> None:
    """Point several tables of ``schema`` at (version, tags), all of them or none.

    A manifest, itself a stored view, is made in one step before the first pointer and dropped after
    the last. If a pointer can't be altered, those before it are put back. If the driver is lost
    in between, the manifest stays and ``finish_publishing`` carries on.
    """
    if not found:
        return
    manifest = f"{versions_schema(spark, f'{schema}.x')}.`build__{uuid.uuid4().hex}`"
    rows = ", ".join(
        "(" + ", ".join(_literal(text) for text in (table, version, json.dumps(tags))) + ")"
        for table, (version, tags) in found.items()
    )
    spark.sql(f"CREATE VIEW {manifest} AS SELECT * FROM VALUES {rows} AS m(name, version, tags)")
    before: dict[str, tuple[str | None, dict]] = {}
    try:
        for table, (version, tags) in found.items():
            before[table] = published_version(spark, table), stored_tags(spark, table)
            publish(spark, table, version, tags)
    except Exception:
        for table, (version, tags) in before.items():
            publish(spark, table, version, tags)
        spark.sql(f"DROP VIEW {manifest}")
        raise
    spark.sql(f"DROP VIEW {manifest}")


def finish_publishing(spark: SparkSession, schema: str) -> list[str]:
    """Carry out the manifests that a lost driver has left, and give their tables."""
    versions = versions_schema(spark, f"{schema}.x")
    if not spark.catalog.databaseExists(versions):
        return []
    names = []
    for left in spark.sql(f"SHOW VIEWS IN {versions} LIKE 'build__*'").collect():
        manifest = f"{versions}.`{left['viewName']}`"
        for row in spark.table(manifest).collect():
            publish(spark, row["name"], row["version"], json.loads(row["tags"]))
            names.append(row["name"])
        spark.sql(f"DROP VIEW {manifest}")
    return names


def _folder(spark: SparkSession, table: str, root: str | None) -> str:
    root = (root or f"{shared_folder(spark)}/sparkmart/tables").rstrip("/")
    return f"{root}/{table.replace('`', '')}"


def remove_superseded(spark: SparkSession, table: str, root: str | None = None) -> list[str]:
    """Drop the versions of ``table`` that it does not point at, delete their directories, and
    give the directories' paths.

    Only directories that ``store_version`` named, under the same ``root``, are deleted. The
    caller sees to it that no reader or refresh is under way.
    """
    current = published_version(spark, table)
    if current is None:
        return []
    schema, relation = versions_schema(spark, table), _parts(table)[-1]
    folder = _folder(spark, table, root)
    removed = []
    for row in spark.sql(f"SHOW TABLES IN {schema} LIKE {_literal(relation + '__*')}").collect():
        own = re.fullmatch(re.escape(relation.lower()) + "__([0-9a-f]{32})", row["tableName"].lower())
        version = f"{schema}.`{row['tableName']}`"
        if own is None or version.lower() == current.lower():
            continue
        if spark.catalog.getTable(version).tableType == "VIEW":
            spark.sql(f"DROP VIEW {version}")
            continue
        spark.sql(f"DROP TABLE {version}")
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{own[1]}")
        files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        if files.delete(path, True):
            removed.append(path.toString())
    return sorted(removed)


def stored_tags(spark: SparkSession, table: str) -> dict[str, str]:
    """The tags and the description that ``table`` has in the catalog."""
    if not spark.catalog.tableExists(table):
        return {}
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
    return {
        row["key"]: row["value"]
        for row in rows
        if row["key"].startswith("meta.") or row["key"] == "description"
    }


def _set_tags(spark: SparkSession, table: str, tags: Mapping[str, str]) -> None:
    """Give the pointer these tags, and take away those of an earlier build that are not declared."""
    stored = stored_tags(spark, table)
    dropped = [key for key in stored if key not in tags]
    if dropped:
        spark.sql(f"ALTER VIEW {table} UNSET TBLPROPERTIES ({', '.join(map(_literal, dropped))})")
    if any(stored.get(key) != value for key, value in tags.items()):
        spark.sql(f"ALTER VIEW {table} SET TBLPROPERTIES ({_pairs(tags)})")


def _pairs(properties: Mapping[str, str]) -> str:
    return ", ".join(f"{_literal(k)} = {_literal(v)}" for k, v in properties.items())
