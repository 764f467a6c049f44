"""Line deduplication by a range-partitioned stream of line hashes.

1. Each line of enough characters becomes a row (128-bit hash of its key, document, position).
2. The rows are range-partitioned by (hash, document, largest id first) and sorted by (hash,
   document, position) within a partition. A line that fills a third of the table is so spread
   over several partitions, as the document is part of the range.
3. A partition streams its runs of equal hashes. A run that lies inside the partition is
   decided at once: its first document keeps the line, the others lose it. The first and the
   last run may go on in neighbouring partitions; their rows are passed on undecided, with a summary
   row each. There are at most two summaries per partition, which bounds their broadcast.
4. The lost positions of a document become one compressed keep bitmap. No text is moved.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import SPACES, map_arrow, stored

# A null id sorts below all ids; all rows without id count as one document.
NO_ID = -(2**63)
LOST, OPEN, SUMMARY = 0, 1, 2

_CONTINUATION = bytes(range(0x80, 0xC0))
_LINES = "h1 bigint, h2 bigint, doc_id bigint, text_key bigint, n_lines bigint, position bigint"
_RUNS = f"{_LINES}, state int, n_docs bigint"
_ROWS_PER_BATCH = 20_000


def line_key(line: bytes) -> bytes:
    """The line without white space around it, A-Z in lower case."""
    return line.strip(SPACES).lower()


def _long_enough(key: bytes, least: int) -> bool:
    if len(key) < least or len(key) >= 4 * least:
        return len(key) >= least
    return len(key.translate(None, _CONTINUATION)) >= least


def _hash_lines(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, rows, totals, positions = [], [], [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                lines = (text or b"").split(b"\n")
                for position, line in enumerate(lines):
                    key = line_key(line)
                    if _long_enough(key, least):
                        hashes.append(xxhash.xxh128_digest(key))
                        rows.append(row)
                        totals.append(len(lines))
                        positions.append(position)
            halves = np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(halves[:, 0]),
                    pa.array(halves[:, 1]),
                    batch.column("doc_id").take(at),
                    batch.column("text_key").take(at),
                    pa.array(totals, pa.int64()),
                    pa.array(positions, pa.int64()),
                ],
                ["h1", "h2", "doc_id", "text_key", "n_lines", "position"],
            )

    return run


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def _decided(rows: Iterator[tuple], min_docs: int) -> Iterator[tuple]:
    """Sorted rows of one partition to lost lines, open lines and summaries of edge runs."""
    runs = groupby(rows, key=lambda row: row[:2])
    following = next(runs, None)
    if following is None:
        return
    key, members = following
    total, largest, last = 0, None, None
    for row in members:
        if row[2] != last:
            total, last = total + 1, row[2]
            largest = last if largest is None else largest
        yield (*row, OPEN, None)
    yield (*key, largest, None, None, None, SUMMARY, total)
    following = next(runs, None)
    while following is not None:
        key, members = following
        # The run begins here, so its first document holds the largest id and keeps its
        # lines. The lines of the next documents wait until enough documents are seen.
        waiting: list[tuple] = []
        total, largest, last = 0, None, None
        for row in members:
            if row[2] != last:
                total, last = total + 1, row[2]
                largest = last if largest is None else largest
            if last != largest:
                waiting.append(row)
                if total >= min_docs:
                    yield from ((*held, LOST, None) for held in waiting)
                    waiting = []
        following = next(runs, None)
        if following is None:
            yield from ((*held, OPEN, None) for held in waiting)
            yield (*key, largest, None, None, None, SUMMARY, total)


def _stream_runs(min_docs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _decided(_rows(batches), min_docs)
        while held := list(islice(found, _ROWS_PER_BATCH)):
            columns = list(zip(*held, strict=True))
            kinds = [pa.int64()] * 6 + [pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
                [field.split()[0] for field in _RUNS.split(", ")],
            )

    return run


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed, dropped = [], []
        for total, lost in zip(
            batch.column("n_lines").to_pylist(), batch.column("lost").to_pylist(), strict=True
        ):
            keep = np.ones(total, bool)
            keep[lost] = False
            dropped.append(int(total - keep.sum()))
            packed.append(zlib.compress(np.packbits(keep).tobytes()))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("text_key"),
                batch.column("n_lines"),
                pa.array(dropped, pa.int64()),
                pa.array(packed, pa.binary()),
            ],
            ["doc_id", "text_key", "n_lines", "n_dropped", "keep_bitmap"],
        )


def _text_key(text: str = "text"):
    """Tells rows apart that share an id but not a text."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def keep_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """(doc_id, text_key, n_lines, n_dropped, keep_bitmap) of the documents that lose a line.

    Lines whose key has at least ``min_chars`` code points and occurs in at least ``min_docs``
    documents stay only in the document with the largest id among them, there all of them.
    ``keep_bitmap`` is a zlib-compressed bit per line, first line in the highest bit, 1 for
    kept. Rows that share an id count as one document; rows without id count as one that
    comes after all others. A null text is one empty line. A document without a row here
    keeps every line. Only ``doc_id`` and ``text`` are read.
    """
    source = docs.select("doc_id", "text").select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"),
        F.col("text").cast("binary").alias("text"),
        _text_key().alias("text_key"),
    )
    order = ["h1", "h2", F.desc("doc_id")]
    lines = (
        map_arrow(source, _hash_lines(min_chars), _LINES)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order, "text_key", "position")
    )
    runs = stored(map_arrow(lines, _stream_runs(min_docs), _RUNS), "line-runs")
    edges = (
        runs.where(F.col("state") == SUMMARY)
        .groupBy("h1", "h2")
        .agg(F.sum("n_docs").alias("total"), F.max("doc_id").alias("largest"))
        .where(F.col("total") >= min_docs)
    )
    settled = (
        runs.where(F.col("state") == OPEN)
        .drop("n_docs")
        .join(F.broadcast(edges), ["h1", "h2"])
        .where("doc_id <> largest")
    )
    place = ["doc_id", "text_key", "n_lines"]
    lost = (
        runs.where(F.col("state") == LOST)
        .select(*place, "position")
        .union(settled.select(*place, "position"))
        .groupBy(*place)
        .agg(F.collect_set("position").alias("lost"))
    )
    out = map_arrow(
        lost, _bitmaps, "doc_id bigint, text_key bigint, n_lines bigint, n_dropped bigint, keep_bitmap binary"
    )
    return out.withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")))


def kept_text(text: bytes | None, bitmap: bytes | None) -> tuple[int, int, bytes]:
    """Number of lines, number dropped, and the lines that stay."""
    lines = (text or b"").split(b"\n")
    if bitmap is None:
        return len(lines), 0, text or b""
    keep = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=len(lines))
    left = [line for line, stays in zip(lines, keep.tolist(), strict=True) if stays]
    return len(lines), len(lines) - len(left), b"\n".join(left)


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """All rows and columns of ``docs`` and ``_mark``, the keep bitmap (null: all lines stay)."""
    marks = bitmaps.select(
        F.col("doc_id").alias("_mark_id"),
        F.col("text_key").alias("_mark_key"),
        F.col("keep_bitmap").alias("_mark"),
    )
    return docs.join(
        marks,
        F.col("doc_id").eqNullSafe(F.col("_mark_id")) & (_text_key() == F.col("_mark_key")),
        "left",
    ).drop("_mark_id", "_mark_key")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lines, dropped, digests = [], [], []
        for text, bitmap in zip(
            batch.column("text").to_pylist(), batch.column("_mark").to_pylist(), strict=True
        ):
            total, lost, left = kept_text(text, bitmap)
            lines.append(total)
            dropped.append(lost)
            digests.append(hashlib.sha256(left).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(lines), pa.array(dropped), pa.array(digests)],
            ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
        )


def kept_digests(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) of each row, from its keep bitmap."""
    marked = with_bitmaps(docs.select("doc_id", "text"), keep_bitmaps(docs, min_chars, min_docs))
    return map_arrow(
        marked.select("doc_id", F.col("text").cast("binary").alias("text"), "_mark"),
        _digests,
        "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string",
    )


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for row, bitmap in enumerate(batch.column("_mark").to_pylist()):
            if bitmap is not None:
                texts[row] = kept_text((texts[row] or "").encode(), bitmap)[2].decode()
        at = batch.schema.get_field_index("text")
        yield batch.set_column(at, "text", pa.array(texts, pa.string())).drop_columns(["_mark"])


def without_repeated_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """All rows and columns of ``docs``, without the lines that ``keep_bitmaps`` drops."""
    marked = with_bitmaps(docs, keep_bitmaps(docs, min_chars, min_docs))
    return map_arrow(marked, _kept, docs.schema)
