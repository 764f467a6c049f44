"""Periodic runs of words by seeds and extension along diagonals.

A run with smallest period q holds its words again q places later over a stretch of at least
max(12 - q, q) words. So each band of lags has a length of word n-gram that such a stretch must
hold: six words for lags up to 7, and 2**t words for lags from 2**t up to 2**(t + 1). Per band:

1. The n-grams that occur again in their document are indexed. Their numbers are exact: those of
   one length follow from pairs of numbers of the length before; a hash only spares the rest.
2. Occurrences at a lag of the band are seeds. An n-gram lying within a run of at most half its
   length occurs again at every period, so of those only the first of a run, or what meets the
   first of another, is a seed; other pairs lie on diagonals of such seeds, or are multiples of a
   period already found. The other n-grams occur a few times within a lag's reach. So the number of
   seeds follows the number of words and not its square.
3. Seeds are sorted by lag and place. A table of the furthest place covered per lag drops seeds
   on a stretch already extended, and the rest are extended both ways over n-grams, longest first.
4. A stretch that has a shorter period as well is that period's run, known by place and length.

Documents are dealt with a megabyte of text at a time, separated by words found nowhere else. A
longer text is a piece of its own; it takes up to about 200 bytes a word where all of it repeats.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import arrow_rows, map_arrow, stored

LEAST_LENGTH = 12
FIRST_GRAM = 6
PIECE_BYTES = 1 << 20
DOCS_PER_BATCH = 1_000

#: (document ids, number of words of each) -> for each word of all documents, in their order, the
#: place of the word that stands there, or None if every word stays.
Arrange = Callable[[list, np.ndarray], "np.ndarray | None"]

_RESULT = (
    "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, "
    "exponent_milli bigint, runs_sha256 string, collapsed_sha256 string, n_words bigint, "
    "n_dropped bigint"
)
_NAMES = [field.split()[0] for field in _RESULT.split(", ")]


def _numbers(first: np.ndarray, *others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same number for equal tuples, and how often each number occurs."""
    count, number = np.zeros(0, np.int64), first.astype(np.int64)
    for other in others:
        joined = number * (int(other.max(initial=0)) + 1) + other
        _, number, count = np.unique(joined, return_inverse=True, return_counts=True)
    return number, count


class _Grams:
    """The words of some documents in a row, and the repeated n-grams of each document.

    Place 0 and the place after each document hold words of their own. ``levels`` gives for a
    length the number of the n-gram at each place; one not repeated has a negative number of its own.
    """

    def __init__(self, words: np.ndarray, lengths: np.ndarray):
        docs = len(lengths)
        self.first = 1 + np.concatenate(([0], np.cumsum(lengths[:-1] + 1))) if docs else np.zeros(0, np.int64)
        size = 1 + int(lengths.sum()) + docs
        self.doc = np.repeat(np.arange(docs), lengths + 1)
        self.doc = np.concatenate(([0], self.doc)).astype(np.int64)
        self.words = np.full(size, -1, np.int64)
        inside = np.ones(size, bool)
        inside[0] = False
        ends = self.first + lengths
        inside[ends] = False
        self.words[inside] = words
        self.words[ends] = -2 - np.arange(docs)
        room = np.zeros(size, np.int64)
        room[1:] = ends[self.doc[1:]] - np.arange(1, size)
        self.levels: dict[int, np.ndarray] = {}
        self._index(room, int(lengths.max(initial=0)))

    def _index(self, room: np.ndarray, longest: int) -> None:
        places = self._maybe_repeated(room)
        grams = [self.words[places + step] for step in range(FIRST_GRAM)]
        found = self._level(places, _numbers(self.doc[places], *grams))
        self.levels[FIRST_GRAM] = found
        size, shift = FIRST_GRAM, 8 - FIRST_GRAM
        while size + shift <= longest:
            places = np.flatnonzero(found[: len(found) - shift] >= 0)
            places = places[found[places + shift] >= 0]
            if not len(places):
                break
            found = self._level(places, _numbers(found[places], found[places + shift]))
            size += shift
            shift = size
            self.levels[size] = found

    def _maybe_repeated(self, room: np.ndarray) -> np.ndarray:
        """Places whose n-gram shares a hash bucket with another of any document here."""
        places = np.flatnonzero(room >= FIRST_GRAM)
        if not len(places):
            return places
        factor = np.uint64(0x9E3779B97F4A7C15)
        mixed = self.doc[places].astype(np.uint64)
        for step in range(FIRST_GRAM):
            mixed = (mixed ^ (mixed >> np.uint64(29))) * factor
            mixed += self.words[places + step].astype(np.uint64)
        mixed = (mixed ^ (mixed >> np.uint64(32))) * factor
        bits = min(26, max(10, int(len(places) * 8).bit_length()))
        bucket = (mixed >> np.uint64(64 - bits)).astype(np.int64)
        return places[np.bincount(bucket, minlength=1 << bits)[bucket] > 1]

    def _level(self, places: np.ndarray, numbered: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        number, count = numbered
        level = -1 - np.arange(len(self.words), dtype=np.int32)
        if len(places):
            again = count[number] > 1
            level[places[again]] = number[again]
        return level

    def ahead(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """How many words are the same from two places on."""
        same = np.zeros(len(left), np.int64)
        for size, level in [*sorted(self.levels.items(), reverse=True), (1, self.words)]:
            open_ = np.arange(len(left))
            while len(open_):
                at = same[open_]
                open_ = open_[level[left[open_] + at] == level[right[open_] + at]]
                same[open_] += size
        return same

    def before(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """How many words are the same just before two places, ``left`` before ``right``."""
        same = np.zeros(len(left), np.int64)
        for size, level in [*sorted(self.levels.items(), reverse=True), (1, self.words)]:
            open_ = np.arange(len(left))
            while len(open_):
                at = left[open_] - same[open_] - size
                open_ = open_[at >= 0]
                at = left[open_] - same[open_] - size
                open_ = open_[level[at] == level[right[open_] - same[open_] - size]]
                same[open_] += size
        return same


def _ranges(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each range its number, repeated, and the places it holds."""
    sizes = np.maximum(high - low, 0)
    owner = np.repeat(np.arange(len(low)), sizes)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[owner]
    return owner, place


def _seeds(
    level: np.ndarray, size: int, lags: tuple[int, int], runs: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag) of the occurrence pairs that must be extended, by lag and place."""
    places = np.flatnonzero(level >= 0)
    low, high = lags
    wide = len(level) + high
    key = np.sort(level[places].astype(np.int64) * wide + places)
    places = key % wide
    active = np.ones(len(places), bool)
    inner = runs[(runs[:, 2] * 2 <= size) & (runs[:, 1] >= size)]
    if len(inner):
        depth = np.zeros(len(level) + 1, np.int64)
        np.add.at(depth, inner[:, 0] + 1, 1)
        np.add.at(depth, inner[:, 0] + inner[:, 1] - size + 1, -1)
        first = np.zeros(len(level), bool)
        first[inner[:, 0]] = True
        active = (np.cumsum(depth)[places] == 0) | first[places]
    own, at = key[active], places[active]
    owner, other = _ranges(np.searchsorted(key, own + low), np.searchsorted(key, own + high))
    start, lag = at[owner], places[other] - at[owner]
    if len(inner):
        reach = np.minimum(at, high - 1)
        owner, other = _ranges(
            np.searchsorted(key, own - reach), np.searchsorted(key, own - low, side="right")
        )
        back = places[other]
        start = np.concatenate((start, back))
        lag = np.concatenate((lag, at[owner] - back))
    seeds = np.unique(lag * len(level) + start)
    return seeds % len(level), seeds // len(level)


def _extended(grams: _Grams, start: np.ndarray, lag: np.ndarray, least: int) -> np.ndarray:
    """(start, length, period) of the maximal stretches through the seeds that are long enough."""
    wide = len(grams.words)
    if not len(start):
        return np.zeros((0, 3), np.int64)
    follows = np.zeros(len(start), bool)
    follows[1:] = (lag[1:] == lag[:-1]) & (start[1:] == start[:-1] + 1)
    start, lag = start[~follows], lag[~follows]
    ahead = grams.ahead(start, start + lag)
    furthest = np.maximum.accumulate(lag * wide + start + ahead)
    fresh = np.ones(len(start), bool)
    fresh[1:] = lag[1:] * wide + start[1:] >= furthest[:-1]
    start, lag, ahead = start[fresh], lag[fresh], ahead[fresh]
    before = grams.before(start, start + lag)
    runs = np.stack((start - before, before + ahead + lag, lag), axis=1)
    return runs[runs[:, 1] >= np.maximum(least, 2 * lag)]


def find_runs(
    words: np.ndarray, lengths: np.ndarray, least: int = LEAST_LENGTH
) -> tuple[np.ndarray, np.ndarray]:
    """All runs of documents given as word numbers in a row: (document, start, length, period) rows
    by document, start and period, and for each word whether a run drops it. ``least`` is at least 12."""
    if least < LEAST_LENGTH:
        raise ValueError(f"runs have {LEAST_LENGTH} words or more")
    grams = _Grams(words, lengths)
    runs = np.zeros((0, 3), np.int64)
    for size, level in grams.levels.items():
        lags = (1, 8) if size == FIRST_GRAM else (size, 2 * size)
        found = np.concatenate((runs, _extended(grams, *_seeds(level, size, lags, runs), least)))
        found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
        fresh = np.ones(len(found), bool)
        fresh[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
        runs = found[fresh]
    depth = np.zeros(len(grams.words) + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    inside = np.ones(len(grams.words), bool)
    inside[0] = False
    inside[grams.first + lengths] = False
    dropped = (np.cumsum(depth)[:-1] > 0)[inside]
    doc = grams.doc[runs[:, 0]]
    runs = np.column_stack((doc, runs[:, 0] - grams.first[doc], runs[:, 1], runs[:, 2]))
    return runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))], dropped


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in a row, and the number of each text's words."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat = split.flatten()
    held = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    ends = np.concatenate(([0], np.cumsum(held)))
    offsets = split.offsets.to_numpy()
    return flat.filter(pa.array(held)), np.diff(ends[offsets - offsets[0]])


def _digest(buffer) -> str:
    return hashlib.sha256(buffer).hexdigest()


def _piece(ids: list, texts: pa.Array, arrange: Arrange | None, least: int) -> pa.RecordBatch:
    words, lengths = split_words(texts)
    moved = arrange(ids, lengths) if arrange else None
    if moved is not None:
        words = words.take(pa.array(moved))
    numbers = words.dictionary_encode().indices.to_numpy().astype(np.int64)
    runs, dropped = find_runs(numbers, lengths, least)
    ends = np.cumsum(lengths)
    kept = np.concatenate(([0], np.cumsum(~dropped)))
    offsets = kept[np.concatenate(([0], ends))]
    lists = pa.ListArray.from_arrays(
        pa.array(offsets, pa.int32()), words.filter(pa.array(~dropped)).cast(pa.binary())
    )
    collapsed = [_digest(text.as_buffer()) for text in pc.binary_join(lists, b" ")]
    of_doc = np.searchsorted(runs[:, 0], np.arange(len(ids) + 1))
    rows = []
    for doc, (low, high) in enumerate(zip(of_doc, of_doc[1:])):
        own = runs[low:high, 1:]
        listed = "".join(f"{start},{length},{period}\n" for start, length, period in own.tolist())
        best = [None] * 4
        if len(own):
            start, length, period = own[np.lexsort((own[:, 2], own[:, 0], -own[:, 1]))[0]].tolist()
            best = [start, length, period, 1000 * length // period]
        n = int(lengths[doc])
        left = int(offsets[doc + 1] - offsets[doc])
        rows.append((ids[doc], len(own), *best, _digest(listed.encode()), collapsed[doc], n, n - left))
    kinds = [pa.string() if name.endswith("sha256") else pa.int64() for name in _NAMES]
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], _NAMES
    )


def _pieces(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about a piece's bytes each; a larger text is alone or last."""
    low = total = 0
    for row, size in enumerate(sizes.tolist()):
        total += size
        if total >= PIECE_BYTES:
            yield low, row + 1
            low, total = row + 1, 0
    if low < len(sizes):
        yield low, len(sizes)


def periodic_runs(
    docs: DataFrame, least: int = LEAST_LENGTH, arrange: Arrange | None = None
) -> DataFrame:
    """A row per row of ``docs(doc_id, text)``: its runs and the text without their repeats.

    Words are `[^\\x20\\x09-\\x0D]+`, numbered from 0. A run is a stretch of at least ``least`` (12 or
    more) words and two periods that no neighbouring word extends. ``start``, ``length``, ``period``
    and ``exponent_milli`` are those of the longest run, the first of equals and of those the one
    with the smallest period; null without a run. ``runs_sha256`` is taken of all runs,
    ``collapsed_sha256`` of the words that stay, joined by one space. ``arrange`` may put other words
    of a document in a word's place before.

    A null or empty text has no words and no run; a null id stays null; repeated rows give a row
    each; an empty table gives none; other columns are ignored. No rows are shuffled, so a hot
    source or a group of copies costs what its texts cost.
    """

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
            for low, high in _pieces(sizes):
                yield _piece(ids[low:high], texts.slice(low, high - low), arrange, least)

    with arrow_rows(docs.sparkSession, DOCS_PER_BATCH):
        return stored(
            map_arrow(docs.select(F.col("doc_id").cast("bigint"), "text"), batches, _RESULT), "runs"
        )


def planted(ids: list, lengths: np.ndarray) -> np.ndarray:
    """Periodic words in every tenth document: for h = crc32 of the id as text, g = h // 10 and
    h % 10 = 0, word i from a = g % n on becomes word a + (i - a) % p, p = 1 + (n - a) // (3 + g % 8)."""
    places = np.arange(int(lengths.sum()))
    begin = 0
    for doc_id, n in zip(ids, lengths.tolist(), strict=True):
        g, rest = divmod(zlib.crc32(b"" if doc_id is None else str(doc_id).encode()), 10)
        if rest == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            places[begin + a : begin + n] = begin + a + np.arange(n - a) % p
        begin += n
    return places
