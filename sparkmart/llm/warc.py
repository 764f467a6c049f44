"""WARC archives with revisit records, and their capture index merged from sorted runs.

1. Payload digests are grouped (small rows, pre-aggregated) to the smallest page id; other pages of
   the digest revisit it. Only the revisits are joined back to the pages.
2. Each task sorts its captures by URL key and time and writes them as gzipped WARC files
   through Spark's text writer: a record is its header block, an empty line and the payload, and the
   writer's line separator is the empty lines that end a record. A file is a sorted run.
3. The files are read back as bytes and parsed by Content-Length. Digest and length of every
   payload are checked against the header; a record that does not fit raises.
4. Index rows are range-partitioned by (URL key, time, page id). Each task gets a slice of every
   run, in the run's order, and merges the slices with a loser tree. Ranges are in order, so
   the whole index is. A URL with very many captures spreads over ranges by time.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Callable, Iterator, Sequence
from datetime import UTC, datetime

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkmart.llm.common import arrow_rows, map_arrow, stored
from sparkmart.workspace import fresh_folder

#: Pages carry no time of capture: page n counts as captured n seconds after this.
FIRST_CAPTURE = 1_600_000_000
RECORDS_PER_FILE = 2_000
RECORDS_PER_BATCH = 500
RECORD_END = "\r\n\r\n"

_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_PARTS = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^#]*)")
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")
_INDEX = (
    "url_key string, captured_at bigint, page_id bigint, payload_bytes bigint, "
    "payload_digest string, record_type string, refers_to bigint, run string, position bigint, "
    "offset bigint, length bigint"
)


def url_key(url: str | None) -> str:
    """Host labels from the right, then path and query: captures of a site sort together."""
    parts = _PARTS.match(url or "")
    if not parts:
        return url or ""
    host = parts[1].lower().removeprefix("www.")
    return ",".join(reversed(host.split("."))) + ")" + (parts[2] or "/")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page_id}/{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, first: int | None) -> str:
    """Header block, empty line and payload; ``first`` is the page that a revisit refers to."""
    digest = payload_digest(payload)
    date = datetime.fromtimestamp(FIRST_CAPTURE + (page_id or 0), UTC)
    fields = [
        ("WARC-Type", "response" if first is None else "revisit"),
        ("WARC-Record-ID", _record_id(page_id, digest)),
        ("WARC-Date", date.strftime("%Y-%m-%dT%H:%M:%SZ")),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("X-Payload-Length", str(len(payload))),
        ("X-Captured-At", str(FIRST_CAPTURE + (page_id or 0))),
        ("Content-Type", "text/html; charset=utf-8"),
    ]
    if url is not None:
        safe = _UNSAFE.sub(lambda found: f"%{ord(found[0]):02X}", url)
        fields.append(("WARC-Target-URI", safe))
    if page_id is not None:
        fields.append(("X-Page-Id", str(page_id)))
    if first is not None:
        fields.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        fields.append(("WARC-Refers-To", _record_id(first, digest)))
        fields.append(("X-Refers-To-Page", str(first)))
    block = payload if first is None else b""
    fields.append(("Content-Length", str(len(block))))
    head = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return f"WARC/1.1\r\n{head}\r\n{block.decode()}"


def records(archive: Iterator[bytes] | io.BufferedIOBase) -> Iterator[tuple[int, int, dict, bytes]]:
    """(offset, length, header fields, block) of each record of an open WARC stream."""
    offset = 0
    while line := archive.readline():
        if line != b"WARC/1.1\r\n":
            raise ValueError(f"no record begins at byte {offset}")
        length, fields = len(line), {}
        while (line := archive.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().rstrip("\r\n").partition(": ")
            fields[name] = value
            length += len(line)
        size = int(fields["Content-Length"])
        block = archive.read(size)
        if len(block) < size or archive.read(4) != RECORD_END.encode():
            raise ValueError(f"the record at byte {offset} is cut off")
        length += 2 + size + 4
        yield offset, length, fields, block
        offset += length


def _write_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(*(column.to_pylist() for column in batch.columns), strict=True)
        lines = [record(page, url, payload or b"", first) for page, url, payload, first in rows]
        yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])


def _whole(text: str | None) -> int | None:
    return None if text is None else int(text)


def _read_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [field.split()[0] for field in _INDEX.split(", ")]
    kinds = [pa.string() if field.endswith("string") else pa.int64() for field in _INDEX.split(", ")]
    for batch in batches:
        for path, content in zip(
            batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True
        ):
            rows = []
            with gzip.open(io.BytesIO(content)) as archive:
                for position, (offset, length, fields, block) in enumerate(records(archive)):
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    size = int(fields["X-Payload-Length"])
                    kind = fields["WARC-Type"]
                    if kind == "response" and (payload_digest(block), len(block)) != (digest, size):
                        raise ValueError(f"{path}: the payload at byte {offset} is damaged")
                    rows.append(
                        (
                            url_key(fields.get("WARC-Target-URI")),
                            int(fields["X-Captured-At"]),
                            _whole(fields.get("X-Page-Id")),
                            size,
                            digest,
                            kind,
                            _whole(fields.get("X-Refers-To-Page")),
                            path,
                            position,
                            offset,
                            length,
                        )
                    )
            columns = list(zip(*rows, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names
            )


def write_archives(pages: DataFrame, folder: str) -> None:
    """One record per row of ``pages(page_id, url, html)`` in gzipped WARC files below ``folder``.

    A null html is an empty payload. Of equal payloads the row with the smallest page id is the
    response and the others revisit it; rows that repeat that id and payload are responses
    too. A row without id revisits the smallest id with its payload; without one it is a response.
    """
    captures = pages.select(
        "page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload")
    ).withColumn("digest", F.sha1("payload"))
    seen = captures.select("page_id", "digest").distinct()
    firsts = seen.groupBy("digest").agg(F.min("page_id").alias("first"))
    revisits = (
        seen.join(firsts, "digest")
        .where("not (page_id <=> first)")
        .select(F.col("page_id").alias("own_id"), F.col("digest").alias("own_digest"), "first")
    )
    typed = captures.join(
        revisits,
        F.col("page_id").eqNullSafe(F.col("own_id")) & (F.col("digest") == F.col("own_digest")),
        "left",
    )
    lines = map_arrow(
        typed.withColumn("url_key", url_key_of(F.col("url")))
        .sortWithinPartitions("url_key", "page_id")
        .select("page_id", "url", "payload", "first"),
        _write_records,
        "value string",
    )
    with arrow_rows(pages.sparkSession, RECORDS_PER_BATCH):
        lines.write.option("lineSep", RECORD_END).option(
            "maxRecordsPerFile", RECORDS_PER_FILE
        ).option("compression", "gzip").text(folder)


def url_key_of(url: Column) -> Column:
    """``url_key`` of the URL as a record has it, its spaces and controls as %XX."""
    odd = r"[\x00-\x20\x7f]"
    letters = F.transform(
        F.split(url, ""),
        lambda letter: F.when(
            letter.rlike(odd), F.concat(F.lit("%"), F.lpad(F.hex(letter), 2, "0"))
        ).otherwise(letter),
    )
    safe = F.when(url.rlike(odd), F.array_join(letters, "")).otherwise(url)
    host, rest = [F.regexp_extract(safe, f"^{_PARTS.pattern}", part) for part in (1, 2)]
    labels = F.split(F.regexp_replace(F.lower(host), "^www[.]", ""), "[.]")
    path = F.when(rest == "", "/").otherwise(rest)
    key = F.concat(F.array_join(F.reverse(labels), ","), F.lit(")"), path)
    return F.coalesce(F.when(safe.rlike(f"^{_PARTS.pattern}"), key).otherwise(safe), F.lit(""))


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """The index rows of all records below ``folder``, each file one sorted run."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder)
    return map_arrow(files.select("path", "content"), _read_records, _INDEX)


class LoserTree:
    """Merges sorted sequences: each inner node remembers the loser of its match, so the next
    smallest item costs one match per level."""

    def __init__(self, runs: Sequence[Sequence], key: Callable):
        self.runs, self.key = runs, key
        self.at = [0] * len(runs)
        self.losers = [-1] * max(1, len(runs))
        for run in range(len(runs)):
            self._play(run)

    def _beats(self, one: int, other: int) -> bool:
        """Whether the head of run ``one`` comes first; ended runs come last, ties by run."""
        if self.at[one] >= len(self.runs[one]):
            return False
        if self.at[other] >= len(self.runs[other]):
            return True
        a = self.key(self.runs[one][self.at[one]])
        b = self.key(self.runs[other][self.at[other]])
        return (a, one) < (b, other)

    def _play(self, run: int) -> None:
        winner, node = run, (run + len(self.runs)) // 2
        while node:
            if self.losers[node] < 0:
                # While the tree is being filled, the first to arrive waits for its rival.
                self.losers[node] = winner
                return
            if self._beats(self.losers[node], winner):
                winner, self.losers[node] = self.losers[node], winner
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator:
        for _ in range(sum(map(len, self.runs))):
            winner = self.losers[0]
            yield self.runs[winner][self.at[winner]]
            self.at[winner] += 1
            self._play(winner)


def _merge_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One range's rows, sorted by run, to the merged order with range number and place."""
    held = [batch for batch in batches if len(batch)]
    if not held:
        return
    rows = pa.Table.from_batches(held)
    keys = list(
        zip(
            rows.column("url_key").to_pylist(),
            rows.column("captured_at").to_pylist(),
            (-1 if page is None else page for page in rows.column("page_id").to_pylist()),
            strict=True,
        )
    )
    runs: list[list[int]] = []
    previous = None
    for place, run in enumerate(rows.column("run").to_pylist()):
        if run != previous:
            runs.append([])
            previous = run
        runs[-1].append(place)
    order = pa.array(list(LoserTree(runs, keys.__getitem__)), pa.int64())
    number = TaskContext.get().partitionId()
    merged = rows.take(order)
    merged = merged.append_column("range", pa.array([number] * len(order), pa.int64()))
    merged = merged.append_column("place", pa.array(range(len(order)), pa.int64()))
    yield from merged.combine_chunks().to_batches()


def merged_index(index: DataFrame) -> DataFrame:
    """The index in global order: ``index_position`` counts from 0 by (url_key, captured_at,
    page_id), a missing page id first."""
    ranged = index.repartitionByRange(
        "url_key", "captured_at", F.coalesce("page_id", F.lit(-1))
    ).sortWithinPartitions("run", "position")
    merged = stored(map_arrow(ranged, _merge_runs, f"{_INDEX}, range bigint, place bigint"), "index")
    # One row per range: the window runs over as many rows as there were tasks.
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        merged.groupBy("range")
        .agg(F.count("*").alias("n"))
        .select("range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    )
    return merged.join(F.broadcast(starts), "range").withColumn(
        "index_position", F.col("start") + F.col("place")
    )


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write the archives, read them back and merge their index: a row per row of ``pages``."""
    spark = pages.sparkSession
    folder = fresh_folder(spark, "llm/warc")
    write_archives(pages, folder)
    return merged_index(read_archives(spark, folder)).select(
        "page_id",
        "payload_bytes",
        "payload_digest",
        "record_type",
        "refers_to",
        "url_key",
        "captured_at",
        "index_position",
    )
