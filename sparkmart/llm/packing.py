"""Best-fit packing planned over a length histogram.

1. Each task tokenises its documents, cuts them into pieces of at most one sequence, and numbers the
   pieces of each length that it has seen. The pieces' places are written once.
2. Spark counts pieces by length: at most ``capacity`` rows. Best-fit decreasing runs over these
   counts: it places whole groups of equal pieces into groups of equally filled sequences,
   so its work and its plan depend on the capacity and not on the corpus.
3. A piece's rank within its length is its number in its task plus the counts of the tasks
   before. It takes the slot that the plan has for that rank, by a join on length and rank.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sparkmart.llm.common import map_arrow, stored

CAPACITY = 2048
END_ID = 0
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

_PIECES = (
    "part int, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
    "local bigint"
)


@lru_cache(maxsize=1)
def _fast(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


@lru_cache(maxsize=1)
def _slow(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


def token_ids(text: str, tokenizer: str = TOKENIZER, ranks: str = RANKS) -> np.ndarray:
    """The text's ids. The same vocabulary as ranks is several times faster; texts that spell
    a special token go to the tokenizer itself, which alone knows it."""
    if "<|" in text:
        return np.array(_slow(tokenizer).encode(text, add_special_tokens=False).ids, np.uint32)
    return _fast(ranks).encode_to_numpy(text, disallowed_special=())


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces; only the first may be shorter than the capacity."""
    first = total % capacity or min(total, capacity)
    starts = [0, *range(first, total, capacity)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], total], strict=True)]


def _cut_pieces(capacity: int, tokenizer: str, ranks: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        for batch in batches:
            rows = []
            for doc_id, text in zip(
                batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True
            ):
                ids = np.append(token_ids(text or "", tokenizer, ranks), END_ID).astype("<u4")
                for piece, (start, length) in enumerate(cut(len(ids), capacity)):
                    check = zlib.crc32(ids[start : start + length].tobytes())
                    rows.append((part, doc_id, piece, start, length, check, seen[length]))
                    seen[length] += 1
            names = [field.split()[0] for field in _PIECES.split(", ")]
            kinds = [pa.int32() if name in ("part", "piece") else pa.int64() for name in names]
            columns = list(zip(*rows, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names
            )

    return run


def plan_slots(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts: (length, rank from, rank to, first sequence, offset).

    Pieces of a length with rank in [from, to) take ``offset`` in consecutive sequences.
    Longest first, a piece goes to the fullest sequence that has room; groups of sequences
    with the same room are filled together. No sequence is opened while another has room.
    """
    rooms: dict[int, list[tuple[int, int]]] = {}
    nonempty = 0
    sequences = 0
    plan = []
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            fitting = nonempty >> length
            if fitting:
                room = length + (fitting & -fitting).bit_length() - 1
                first, size = rooms[room].pop()
                if not rooms[room]:
                    nonempty &= ~(1 << room)
            else:
                room, first = capacity, sequences
                size = -(-left // (capacity // length))
                sequences += size
            each = room // length
            used = min(size, left // each)
            if not used:
                each, used = left, 1
            for step in range(each):
                plan.append((length, rank, rank + used, first, capacity - room + step * length))
                rank += used
            left -= each * used
            for rest, begin, count in (
                (room - each * length, first, used),
                (room, first + used, size - used),
            ):
                if rest and count:
                    rooms.setdefault(rest, []).append((begin, count))
                    nonempty |= 1 << rest
    return plan


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    tokenizer: str = TOKENIZER,
    ranks: str = RANKS,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), a row per piece.

    A null text is empty and has the end id alone. Every row is packed, so a repeated row is
    packed again and a row without id keeps a null id. Only ``doc_id`` and ``text`` are read.
    """
    pieces = stored(
        map_arrow(docs.select("doc_id", "text"), _cut_pieces(capacity, tokenizer, ranks), _PIECES),
        "pieces",
    )
    by_part = pieces.groupBy("part", "length").agg((F.max("local") + 1).alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    bases = by_part.select(
        "part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base")
    )
    histogram = {
        row["length"]: row["n"]
        for row in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()
    }
    plan = docs.sparkSession.createDataFrame(
        plan_slots(histogram, capacity),
        "slot_length bigint, low bigint, high bigint, first bigint, offset bigint",
    )
    ranked = pieces.join(bases, ["part", "length"]).withColumn(
        "rank", F.col("base") + F.col("local")
    )
    return ranked.join(
        F.broadcast(plan),
        (F.col("length") == F.col("slot_length"))
        & (F.col("rank") >= F.col("low"))
        & (F.col("rank") < F.col("high")),
    ).select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("first") + F.col("rank") - F.col("low")).alias("sequence_id"),
        "offset",
    )
