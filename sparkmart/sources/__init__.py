"""Readers and writers: delimited files, raw records, registry documents, tables."""

from sparkmart.sources.delimited import read_delimited, read_seed, read_stream
from sparkmart.sources.documents import (
    explode_documents,
    read_documents,
    to_documents,
    write_documents,
)
from sparkmart.sources.ingest import sync_streams
from sparkmart.sources.large_documents import read_large_document
from sparkmart.sources.quoted import read_quoted
from sparkmart.sources.raw import land_raw, parse_raw, read_raw, with_record
from sparkmart.sources.schemas import struct_from_json_schema
from sparkmart.sources.tables import SourceTable, full_refresh, write_parquet

__all__ = [
    "SourceTable",
    "explode_documents",
    "full_refresh",
    "land_raw",
    "parse_raw",
    "read_delimited",
    "read_documents",
    "read_large_document",
    "read_quoted",
    "read_raw",
    "read_seed",
    "read_stream",
    "struct_from_json_schema",
    "sync_streams",
    "to_documents",
    "with_record",
    "write_documents",
    "write_parquet",
]
