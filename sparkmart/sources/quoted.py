"""Delimited files whose quoted cells hold line breaks, read by many tasks a file.

A line break ends a record when the quotes before it in the file are even in number. Each block of a
file counts its quotes, and a prefix sum over the blocks tells how each one starts. A task then
goes through its blocks line by line as they are scanned, and puts together the records that begin and
end there. Only the two pieces of records at the edges of a block are shuffled, never the text as a whole.
Spark's own CSV parser then reads each record.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.workspace import map_arrow

_PARSER = ("sep", "quote", "escape", "nullValue", "emptyValue", "dateFormat", "timestampFormat")
_BLOCK = ["file", "block", "length"]
_CUT = "no bigint, top bigint, part int, record binary, is_first boolean"
# What a row of the cut holds: a record, the end of one from an earlier block, the begin of one.
_WHOLE, _ENDING, _BEGUN = 0, 1, 2


def _quotes(line: Column, quote: str) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(quote), F.lit("")))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, length, line) of all lines; a block's lines are one task's, and in order."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_block_length").alias("length"),
        F.col("value").alias("line"),
    )


def _blocks(lines: DataFrame, quote: str) -> DataFrame:
    """One row a block: its number ``_no``, that of its file's first block ``_top``, and ``_inside``,
    1 if it starts within quotes."""
    found = lines.groupBy(*_BLOCK).agg(F.sum(_quotes(F.col("line"), quote)).alias("_sum"))
    by_file = Window.partitionBy("file")
    earlier = by_file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    numbered = found.withColumn("_no", F.row_number().over(Window.orderBy("file", "block")))
    return numbered.select(
        *_BLOCK,
        F.col("_no").cast("long").alias("_no"),
        F.min("_no").over(by_file).cast("long").alias("_top"),
        (F.coalesce(F.sum("_sum").over(earlier), F.lit(0)) % 2).cast("long").alias("_inside"),
    )


def _joined(lines: pa.Array, starts: np.ndarray) -> pa.Array:
    """The lines between each two of ``starts`` as one value each."""
    listed = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), lines)
    return pc.binary_join(listed, pa.scalar(b"\n", lines.type))


def _cut(quote: bytes, whole: bool):
    """From lines by block, the whole records, or the pieces at the edges of the blocks."""

    def row(no: int, top: int, part: int, pieces: list[bytes], first: bool) -> pa.RecordBatch:
        values = [[no], [top], [part], [b"\n".join(pieces)], [first]]
        return rows(*values)

    def rows(no, top, part, record, first) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.bool_()]
        arrays = [pa.array(v, k) for v, k in zip((no, top, part, record, first), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, ["no", "top", "part", "record", "is_first"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The block at hand, the quotes so far modulo 2, and the lines of its open record: of one
        # that began here (part _BEGUN) or, until the first begin, earlier (_ENDING).
        no = top = odd = 0
        part, held, is_first = _ENDING, [], False
        for batch in batches:
            numbers = batch.column("_no").to_numpy()
            tops, insides = batch.column("_top").to_numpy(), batch.column("_inside").to_numpy()
            edges = np.flatnonzero(numbers[1:] != numbers[:-1]) + 1
            for begin, end in zip([0, *edges], [*edges, len(numbers)], strict=True):
                if begin == end:
                    continue
                if numbers[begin] != no:
                    if held and not whole:
                        yield row(no, top, part, held, is_first)
                    no, top, odd = int(numbers[begin]), int(tops[begin]), int(insides[begin])
                    part, held, is_first = _ENDING, [], False
                lines = batch.column("line").slice(begin, end - begin)
                counts = pc.count_substring(lines, quote).to_numpy().astype(np.int64)
                after = odd + np.cumsum(counts)
                starts = np.flatnonzero(np.append(odd, after[:-1]) % 2 == 0)
                odd = int(after[-1] % 2)
                ahead = int(starts[0]) if len(starts) else len(lines)
                if ahead:
                    held.append(_joined(lines, np.array([0, ahead]))[0].as_py())
                if not len(starts):
                    continue
                opens = part == _ENDING and no == top
                if held and whole == (part == _BEGUN):
                    yield row(no, top, _WHOLE if whole else part, held, is_first)
                count = len(starts) - 1
                if whole and count:
                    first = np.zeros(count, bool)
                    first[0] = opens
                    yield rows(
                        np.full(count, no), np.full(count, top), np.full(count, _WHOLE), _joined(lines, starts), first
                    )
                last = np.array([starts[-1], len(lines)])
                part, held, is_first = _BEGUN, [_joined(lines, last)[0].as_py()], opens and not count
        if held and not whole:
            yield row(no, top, part, held, is_first)

    return run


def records(lines: DataFrame, quote: str = '"') -> DataFrame:
    """(record, is_first) of all records of ``read_lines``; ``is_first`` is a file's first.

    A quote within a cell is doubled, so it does not change what is even. Empty records are left out.
    """
    # A block that was cut otherwise when the quotes were counted must not pass unseen.
    known = F.when(F.col("_no").isNotNull(), F.col("_no")).otherwise(
        F.raise_error(F.concat(F.lit("the blocks changed while reading "), "file")).cast("long")
    )
    placed = lines.join(F.broadcast(_blocks(lines, quote)), _BLOCK, "left").select(
        known.alias("_no"), "_top", "_inside", F.col("line").cast("binary").alias("line")
    )
    lone = map_arrow(placed, _cut(quote.encode(), True), _CUT).select("record", "is_first")
    order = Window.partitionBy("top").orderBy("no", "part")
    begun = F.last(F.when(F.col("part") == _BEGUN, F.col("no")), ignorenulls=True)
    parts = F.array_sort(F.collect_list(F.struct("no", "part", F.col("record").cast("string").alias("record"))))
    joined = (
        map_arrow(placed, _cut(quote.encode(), False), _CUT)
        .withColumn("_record", begun.over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .groupBy("top", "_record")
        .agg(
            F.array_join(F.transform(parts, lambda part: part["record"]), "\n").alias("record"),
            F.max("is_first").alias("is_first"),
        )
    )
    ended = F.regexp_replace("record", "\r$", "")
    return (
        lone.select(F.col("record").cast("string").alias("record"), "is_first")
        .unionByName(joined.select("record", "is_first"))
        .select(ended.alias("record"), "is_first")
        .where("record <> ''")
    )


def read_quoted(
    spark: SparkSession, path: str, schema: T.StructType, **options: str
) -> DataFrame:
    """Read headered UTF-8 files strictly under ``schema``; quoted cells may hold line breaks.

    As ``read_delimited`` with ``multiLine``, but a file is read by as many tasks as its size
    asks for. The header must name the schema's columns; a record that does not fit ends the read.
    """
    unknown = sorted(set(options) - set(_PARSER))
    if unknown:
        raise ValueError(f"unsupported options {unknown}")
    quote = options.get("quote", '"')
    parser = {
        "mode": "FAILFAST", "quote": quote, "escape": quote, "lineSep": "\n",
        "unescapedQuoteHandling": "RAISE_ERROR", **options,
    }
    if parser["escape"] != quote:
        raise ValueError("a quote within a cell must be doubled")
    found = records(read_lines(spark, path), quote)
    texts = ", ".join(f"c{place} string" for place in range(len(schema.fields)))
    named = F.from_csv("record", texts, parser)
    matches = [
        F.lower(named[f"c{place}"]) == field.name.lower() for place, field in enumerate(schema.fields)
    ]
    header_fits = F.lit(True)
    for match in matches:
        header_fits = header_fits & F.coalesce(match, F.lit(False))
    header = F.when(header_fits, F.lit(False)).otherwise(
        F.raise_error(F.lit(f"malformed: the header is not {schema.names}"))
    )
    rows = found.where(F.when(F.col("is_first"), header).otherwise(F.lit(True)))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return rows.select(F.from_csv("record", columns, parser).alias("_row")).select("_row.*")
