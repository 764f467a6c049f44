"""Benchmark decontamination by greedy string tiling.

The benchmark is the stated query set: it is dealt by hash into blocks of a bounded number of
words, and each block is sent to all tasks and searched in all documents. Within a task:

1. Seeds: the hashes of an item's five-word windows are joined with those of the document. An
   item whose shared seeds span too little of it to reach the threshold is ruled out.
2. Tiling: the longest match of words that neither side has marked yet is found by running
   Karp-Rabin hashes, searching the length by halving, and both sides are marked; again, until no match
   of five words is left. Tiles never overlap, so passages count in any order.
3. An item is found if its tiles cover at least half of its words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm import shingles as S
from sparkmart.llm.common import map_arrow

MIN_TILE = 5
COVERAGE = 0.5
BLOCK_WORDS = 1_000_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_FILTER_BITS = 20


def _powers(base: np.uint64, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    if count:
        out[0] = 1
    return np.multiply.accumulate(out)


class _Running:
    """Karp-Rabin hashes of all windows of a word sequence, at any width, and its marks."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.marked = np.zeros(len(words), bool)
        self.sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(S.mixed(words) * _powers(_BASE, len(words)), out=self.sums[1:])
        self.inverse = _powers(_BASE_INVERSE, len(words))

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of the windows without a marked word."""
        taken = np.concatenate(([0], np.cumsum(self.marked)))
        starts = np.flatnonzero(taken[width:] == taken[: len(taken) - width])
        hashes = (self.sums[starts + width] - self.sums[starts]) * self.inverse[starts]
        return starts, hashes


def _match(item: _Running, text: _Running, width: int) -> tuple[int, int] | None:
    """The first unmarked match of ``width`` words: first in the item, then in the text."""
    item_starts, item_hashes = item.windows(width)
    text_starts, text_hashes = text.windows(width)
    shared = np.isin(item_hashes, text_hashes)
    for spot in np.flatnonzero(shared).tolist():
        i = int(item_starts[spot])
        for j in text_starts[text_hashes == item_hashes[spot]].tolist():
            if np.array_equal(item.words[i : i + width], text.words[j : j + width]):
                return i, j
    return None


def tiles(item: np.ndarray, text: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(item start, text start, length) of each tile, longest first."""
    one, other = _Running(item), _Running(text)
    found = []
    longest = min(len(item), len(text))
    while longest >= least:
        low, high, best = least, longest, None
        while low <= high:
            width = (low + high) // 2
            hit = _match(one, other, width)
            if hit:
                best, low = (*hit, width), width + 1
            else:
                high = width - 1
        if best is None:
            break
        i, j, longest = best
        one.marked[i : i + longest] = True
        other.marked[j : j + longest] = True
        found.append(best)
    return found


@dataclass
class _Block:
    """Some benchmark items with an index of their seeds by width."""

    ids: list[int | None]
    items: list[np.ndarray]
    seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    threshold: float

    @classmethod
    def of(cls, rows: list[tuple[int | None, bytes]], threshold: float) -> _Block:
        ids, items, found = [], [], {}
        for item_id, text in rows:
            words = text.lower().split()
            if words:
                hashes = S.word_hashes(words)
                width = min(MIN_TILE, len(words))
                own = S.windows(hashes, width)
                places = np.stack([np.full(len(own), len(ids)), np.arange(len(own))], axis=1)
                found.setdefault(width, []).append((own, places))
                ids.append(item_id)
                items.append(hashes)
        seeds = {}
        for width, parts in found.items():
            hashes = np.concatenate([part[0] for part in parts])
            places = np.concatenate([part[1] for part in parts])
            order = np.argsort(hashes, kind="stable")
            keys, first = np.unique(hashes[order], return_index=True)
            ends = np.append(first, len(hashes))
            known = np.zeros(1 << _FILTER_BITS, bool)
            known[(keys & np.uint64((1 << _FILTER_BITS) - 1)).astype(np.int64)] = True
            seeds[width] = (keys, ends, places[order], known)
        return cls(ids, items, seeds, threshold)

    def found(self, text: bytes | None) -> list[tuple[int | None, int, int, int]]:
        """(item id, its words, words covered, tiles) of each item found in a text."""
        words = (text or b"").lower().split()
        hashes = S.word_hashes(words)
        out = []
        for width, (keys, ends, places, known) in self.seeds.items():
            if len(hashes) < width:
                continue
            own = S.windows(hashes, width)
            own = own[known[(own & np.uint64((1 << _FILTER_BITS) - 1)).astype(np.int64)]]
            if not len(own):
                continue
            own = np.unique(own)
            at = np.searchsorted(keys, own)
            at[at == len(keys)] = 0
            at = at[keys[at] == own]
            spans: dict[int, list[int]] = {}
            for spot in at.tolist():
                for item, place in places[ends[spot] : ends[spot + 1]].tolist():
                    spans.setdefault(item, []).append(place)
            for item, starts in sorted(spans.items()):
                size = len(self.items[item])
                reach = np.zeros(size, bool)
                for step in range(width):
                    reach[np.array(starts) + step] = True
                if reach.sum() < self.threshold * size:
                    continue
                laid = tiles(self.items[item], hashes, width)
                covered = sum(tile[2] for tile in laid)
                if covered >= self.threshold * size:
                    out.append((self.ids[item], size, covered, len(laid)))
        return out


def _blocks(benchmark: DataFrame, threshold: float, block_words: int) -> Iterator[_Block]:
    """The benchmark, a bounded block at a time."""
    items = benchmark.select("item_id", F.col("text").cast("binary").alias("text")).where(
        "text is not null"
    )
    # A word takes two bytes with its space, so this bounds the words from above.
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, ceil(size / 2 / block_words))
    spot = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    for number in range(count):
        rows = [(row["item_id"], bytes(row["text"])) for row in items.where(spot == number).collect()]
        yield _Block.of(sorted(rows, key=repr), threshold)


def _search(block: _Block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (doc_id, *hit)
                for doc_id, text in zip(
                    batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True
                )
                for hit in block.found(text)
            ]
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, pa.int64()) for column in columns],
                ["doc_id", "item_id", "item_words", "covered_words", "n_tiles"],
            )

    return run


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = COVERAGE,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """(doc_id, item_id, item_words, covered_words, n_tiles, coverage) for each document row and
    benchmark item whose tiles cover at least ``threshold`` of the item.

    Words are split at white space, A-Z in lower case. An item of fewer than five words must occur
    whole; null and word-less items are never found, null texts hold nothing. A repeated row
    of either side is found as often as it stands there. Only the id and text columns are read.
    """
    source = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    out = None
    for block in _blocks(benchmark, threshold, block_words):
        part = map_arrow(
            source,
            _search(block),
            "doc_id bigint, item_id bigint, item_words bigint, covered_words bigint, n_tiles bigint",
        )
        out = part if out is None else out.union(part)
    return out.withColumn("coverage", F.col("covered_words") / F.col("item_words"))


def _without(block: _Block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = [not block.found((t or "").encode()) for t in batch.column("text").to_pylist()]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return run


def without_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = COVERAGE,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """All columns of the rows of ``docs`` in which no benchmark item is found."""
    for block in _blocks(benchmark, threshold, block_words):
        docs = map_arrow(docs, _without(block), docs.schema)
    return docs
