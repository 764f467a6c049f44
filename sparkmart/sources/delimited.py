"""Delimited text with a header and a declared schema.

Types are never inferred (inference reads everything once more, and may change
between two runs), and a cell that does not fit its type ends the read instead
of turning into NULL.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.sources.schemas import struct_from_json_schema

# A quote within a quoted cell is written twice, and a backslash is a character like others.
STANDARD_QUOTING = {"quote": '"', "escape": '"', "unescapedQuoteHandling": "RAISE_ERROR"}

# Reader option of a source description -> Spark reader option.
READER_OPTIONS = {
    "sep": "sep",
    "quotechar": "quote",
    "escapechar": "escape",
    "encoding": "encoding",
}


def read_delimited(
    spark: SparkSession, path: str, schema: T.StructType, **options: str
) -> DataFrame:
    """Read headered delimited files strictly under ``schema``.

    Cells may hold line breaks only with ``multiLine="true"``, which makes each file one
    task's work and so is never the default.
    """
    settings = {
        "header": "true",
        "mode": "FAILFAST",
        "enforceSchema": "false",
        **STANDARD_QUOTING,
        **options,
    }
    if len(schema.fields) == 1 and settings.get("multiLine", "false").lower() != "true":
        _refuse_open_quotes(spark, path, settings["quote"])
    return spark.read.options(**settings).schema(schema).csv(path)


def _refuse_open_quotes(spark: SparkSession, path: str, quote: str) -> None:
    """Raise if a quoted cell goes on in the next line.

    With several columns such a line has too few cells and ends the read; with one column
    it would pass as two rows.
    """
    lines = spark.read.text(path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))
    if not lines.where(F.startswith("value", F.lit(quote)) & (quotes % 2 == 1)).isEmpty():
        raise ValueError(f"malformed: a quoted cell of {path} has a line break; set multiLine")


def read_seed(
    spark: SparkSession, path: str, schema: T.StructType | None = None, **options: str
) -> DataFrame:
    """Read a seed file. Without a schema every column stays text, to be cast later."""
    if schema is not None:
        return read_delimited(spark, path, schema, **options)
    settings = {"header": "true", "mode": "FAILFAST", **STANDARD_QUOTING, **options}
    return spark.read.options(**settings).csv(path)


def read_stream(
    spark: SparkSession,
    source: Mapping,
    stream: Mapping,
    *,
    base_folder: str | None = None,
) -> DataFrame:
    """Read one full-refresh stream: a source description plus its stream entry.

    ``source`` holds ``format``, ``url`` and optional ``reader_options`` (a mapping
    or JSON text); ``stream`` holds ``sync_mode`` and the declared ``json_schema``.
    A ``base_folder`` is put before a relative ``url``.
    """
    if source.get("format") != "csv":
        raise ValueError(f"unsupported source format {source.get('format')!r}")
    mode = stream.get("sync_mode", "full_refresh")
    if mode != "full_refresh":
        raise ValueError(f"unsupported sync mode {mode!r}")
    declared = source.get("reader_options") or {}
    if isinstance(declared, str):
        declared = json.loads(declared)
    unknown = sorted(set(declared) - set(READER_OPTIONS))
    if unknown:
        raise ValueError(f"unsupported reader options {unknown}")
    options = {READER_OPTIONS[name]: value for name, value in declared.items()}
    url = source["url"]
    if base_folder and "://" not in url and not url.startswith("/"):
        url = f"{base_folder.rstrip('/')}/{url}"
    schema = struct_from_json_schema(stream["stream"]["json_schema"])
    return read_delimited(spark, url, schema, **options)
