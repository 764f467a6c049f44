"""A hashed maximum-entropy language model with class-factored softmax.

A token's probability given its history h has three factors::

    P(class | h) * P(member | class, h) * P(word | member)

A class has 16 members, and there are 16 classes. The most frequent words are members of their
own; every other word, known or not, falls to a member by its last letters, and shares it by smoothed
training counts (one further place stands for all unknown words of the member). The first
two factors are softmaxes over hashed features of h: the word before, the two words before, and two
skip features (the word two and three places back), with a bias each.

1. One pass turns the texts into blocks of local word numbers and one row per block and word.
2. A window by word gives each of these rows the word's training count; a word has one row per
   block, so no word has more than a small share of the rows.
3. Training: tasks run minibatch gradient steps over all training tokens of their blocks and return what
   they changed; changes are averaged in Spark and go into the next round. The weights
   have a fixed size whatever the corpus.
4. Scoring: a block meets its words' counts in a cogroup and is scored in numpy batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm.common import arrow_rows, id_remainder, map_arrow, ship_code, stored
from sparkmart.llm.shingles import mixed

CLASSES = MEMBERS = 16
CELLS = CLASSES * MEMBERS
HEAD = 128
TABLE = 1 << 16
BLOCK_TOKENS = 2_200_000
BATCH_TOKENS = 16_384
ROUNDS = 2
TRAIN_TASKS = 1_024
RATE = 0.1
# The end of a text as a token; no word can hold a line break.
END = b"\n"
FOLDS, HELD_FOLD = 7, 2

_CHUNKS = 64
_ONES = np.ones(MEMBERS, np.float32)
_SEEDS = [np.uint64(n) for n in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_BLOCKS = (
    "block bigint, doc_ids array<bigint>, held array<boolean>, ends array<int>, tokens binary, "
    "hashes binary, cells binary, local int, word binary, cell int, n bigint"
)


def _hashes(words: list[bytes]) -> np.ndarray:
    """Hashes of words that are all different, so none is kept for later."""
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


class _LocalNumbers(dict):
    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def spelled_cells(words: list[bytes]) -> np.ndarray:
    """The member that a word outside the head belongs to, by its last three bytes."""
    tails = _hashes([word[-3:] for word in words])
    return (HEAD + mixed(tails) % np.uint64(CELLS - HEAD)).astype(np.uint8)


def _packed(tokens: np.ndarray) -> bytes:
    """Numbers below 2**24 or not, by byte planes: the high ones are nearly all zero."""
    planes = tokens.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int32)


class _BlockBuilder:
    def __init__(self, number: int):
        self.number = number
        self.numbers = _LocalNumbers()
        self.doc_ids, self.held, self.parts, self.ends = [], [], [], [0]

    def add(self, doc_id: int | None, held: bool, words: list[bytes]) -> None:
        words.append(END)
        found = map(self.numbers.__getitem__, words)
        self.parts.append(np.fromiter(found, np.int32, len(words)))
        self.doc_ids.append(doc_id)
        self.held.append(held)
        self.ends.append(self.ends[-1] + len(words))

    def batches(self) -> Iterator[pa.RecordBatch]:
        words = list(self.numbers)
        tokens = np.concatenate(self.parts)
        learn = np.repeat(~np.array(self.held, bool), np.diff(self.ends))
        counts = np.bincount(tokens[learn], minlength=len(words))
        cells = spelled_cells(words)
        names = [field.split()[0] for field in _BLOCKS.split(", ")]
        schema = pa.schema(
            zip(
                names,
                [
                    pa.int64(),
                    pa.list_(pa.int64()),
                    pa.list_(pa.bool_()),
                    pa.list_(pa.int32()),
                    pa.binary(),
                    pa.binary(),
                    pa.binary(),
                    pa.int32(),
                    pa.binary(),
                    pa.int32(),
                    pa.int64(),
                ],
                strict=True,
            )
        )
        whole = [
            [self.number],
            [self.doc_ids],
            [self.held],
            [self.ends],
            [_packed(tokens)],
            [_hashes(words).tobytes()],
            [cells.tobytes()],
            [None],
            [None],
            [None],
            [None],
        ]
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, f.type) for v, f in zip(whole, schema, strict=True)], schema=schema
        )
        step = 100_000
        for start in range(0, len(words), step):
            some = words[start : start + step]
            rows = pa.nulls(len(some))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(some), self.number)),
                    *(rows.cast(schema.field(place).type) for place in range(1, 7)),
                    pa.array(np.arange(start, start + len(some), dtype=np.int32)),
                    pa.array(some, pa.binary()),
                    pa.array(cells[start : start + len(some)].astype(np.int32)),
                    pa.array(counts[start : start + len(some)]),
                ],
                schema=schema,
            )


def _build_blocks(block_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        builder = _BlockBuilder(number)
        for batch in batches:
            # Texts leave the batch one by one, so that they are not held twice.
            for doc_id, text, held in zip(
                batch.column("doc_id").to_pylist(),
                batch.column("text"),
                batch.column("held").to_pylist(),
                strict=True,
            ):
                builder.add(doc_id, held, (text.as_py() or b"").lower().split())
                if builder.ends[-1] >= block_tokens:
                    yield from builder.batches()
                    number += 1
                    builder = _BlockBuilder(number)
                    pa.default_memory_pool().release_unused()
        if builder.doc_ids:
            yield from builder.batches()

    return run


@dataclass
class _Block:
    """A block as numpy arrays, with the members that the model gives its words."""

    tokens: np.ndarray
    ends: np.ndarray
    held: np.ndarray
    hashes: np.ndarray
    cells: np.ndarray

    @classmethod
    def of(cls, row: dict, heads: np.ndarray) -> _Block:
        hashes = np.frombuffer(row["hashes"], np.uint64)
        cells = np.frombuffer(row["cells"], np.uint8).copy()
        if len(heads):
            order = np.argsort(heads)
            spot = np.minimum(np.searchsorted(heads[order], hashes), len(heads) - 1)
            hit = heads[order][spot] == hashes
            cells[hit] = order[spot[hit]]
        return cls(
            _unpacked(row["tokens"]),
            np.array(row["ends"], np.int64),
            np.array(row["held"], bool),
            hashes,
            cells.astype(np.int64),
        )

    def features(self, start: int, stop: int) -> np.ndarray:
        """(4, n): table rows of the history features of tokens start to stop."""
        reach = max(0, start - 3)
        words = self.hashes[self.tokens[reach:stop]]
        place = np.arange(start, stop)
        since = place - self.ends[np.searchsorted(self.ends, place, "right") - 1]

        def back(distance: int) -> np.ndarray:
            shifted = np.zeros(stop - start, np.uint64)
            source = np.arange(start - reach - distance, stop - reach - distance)
            inside = since >= distance
            shifted[inside] = words[source[inside]]
            return shifted

        one, two, three = back(1), back(2), back(3)
        kinds = (
            one * _SEEDS[0] + np.uint64(1),
            one * _SEEDS[0] + two * _SEEDS[1] + np.uint64(2),
            two * _SEEDS[1] + np.uint64(3),
            three * _SEEDS[2] + np.uint64(4),
        )
        return np.stack([(mixed(kind) >> np.uint64(48)).astype(np.uint16) for kind in kinds])


class _Weights:
    """Both softmaxes: table rows of 16 weights, and the biases."""

    def __init__(self, flat: np.ndarray | None = None):
        shapes = [(TABLE, CLASSES), (TABLE, MEMBERS), (1, CLASSES), (CLASSES, MEMBERS)]
        sizes = [a * b for a, b in shapes]
        self.flat = np.zeros(sum(sizes), np.float32) if flat is None else flat.copy()
        parts = np.split(self.flat, np.cumsum(sizes)[:-1])
        self.upper, self.lower, self.upper_bias, self.lower_bias = (
            part.reshape(shape) for part, shape in zip(parts, shapes, strict=True)
        )

    @staticmethod
    def lower_rows(features: np.ndarray, classes: np.ndarray) -> np.ndarray:
        # 16-bit numbers wrap around, as the table has 2**16 rows.
        return features + ((classes + 1) * 40_503).astype(np.uint16)

    @staticmethod
    def _softmax(sums: np.ndarray) -> np.ndarray:
        np.clip(sums, -40, 40, out=sums)
        np.exp(sums, out=sums)
        sums /= (sums @ _ONES)[:, None]
        return sums

    def chances(self, features: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, ...]:
        """The two softmaxes, and the table rows that the lower one used."""
        classes = cells // MEMBERS
        upper = np.take(self.upper, features[0], axis=0)
        for kind in features[1:]:
            upper += np.take(self.upper, kind, axis=0)
        upper += self.upper_bias
        rows = self.lower_rows(features, classes)
        lower = np.take(self.lower_bias, classes, axis=0)
        for kind in rows:
            lower += np.take(self.lower, kind, axis=0)
        return self._softmax(upper), self._softmax(lower), rows

    def log10(self, features: np.ndarray, cells: np.ndarray) -> np.ndarray:
        upper, lower, _ = self.chances(features, cells)
        at = np.arange(len(cells))
        return np.log10(upper[at, cells // MEMBERS]) + np.log10(lower[at, cells % MEMBERS])


def _grouped(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows (16-bit, so that sorting is by radix) and the sums of their values."""
    order = np.argsort(rows, kind="stable")
    ordered = np.take(rows, order)
    last = np.flatnonzero(np.append(ordered[1:] != ordered[:-1], True))
    # Two neighbouring values as one complex number: the same sums in half the additions.
    pairs = np.take(values, order, axis=0).view(np.complex64)
    running = np.take(np.cumsum(pairs, axis=0), last, axis=0)
    running[1:] -= running[:-1].copy()
    return ordered[last], running.view(np.float32)


class _Trainer:
    """Minibatch gradient steps with a rate per weight (AdaGrad)."""

    def __init__(self, start: np.ndarray):
        self.weights = _Weights(start)
        self.squares = _Weights()

    def _move(self, part: str, rows: np.ndarray, gradient: np.ndarray) -> None:
        squares, weights = getattr(self.squares, part), getattr(self.weights, part)
        total = np.take(squares, rows, axis=0)
        total += gradient * gradient
        squares[rows] = total
        total += np.float32(1e-6)
        np.sqrt(total, out=total)
        gradient *= np.float32(RATE)
        gradient /= total
        weights[rows] = np.take(weights, rows, axis=0) - gradient

    def step(self, features: np.ndarray, cells: np.ndarray) -> None:
        upper, lower, rows = self.weights.chances(features, cells)
        at = np.arange(len(cells))
        classes = cells // MEMBERS
        upper[at, classes] -= 1
        lower[at, cells % MEMBERS] -= 1
        # The mean over a minibatch would starve rare features; the root keeps steps bounded.
        scale = np.float32(1 / np.sqrt(len(cells)))
        upper *= scale
        lower *= scale
        for own, below in zip(features, rows, strict=True):
            self._move("upper", *_grouped(own, upper))
            self._move("lower", *_grouped(below, lower))
        self._move("upper_bias", np.zeros(1, np.int64), upper.sum(axis=0, keepdims=True))
        self._move("lower_bias", *_grouped(classes.astype(np.uint16), lower))


def _train_blocks(start: np.ndarray, heads: np.ndarray):
    """Per task: what training on its blocks changed, in chunks, with a mark for touched weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, seen = _Trainer(start), 0
        for batch in batches:
            for place in range(len(batch)):
                block = _Block.of(batch.slice(place, 1).to_pylist()[0], heads)
                learn = np.repeat(~block.held, np.diff(block.ends))
                for begin in range(0, len(block.tokens), BATCH_TOKENS):
                    stop = min(begin + BATCH_TOKENS, len(block.tokens))
                    use = learn[begin:stop]
                    if use.any():
                        features = block.features(begin, stop)[:, use]
                        trainer.step(features, block.cells[block.tokens[begin:stop][use]])
                        seen += int(use.sum())
        if not seen:
            return
        change = np.array_split(trainer.weights.flat - start, _CHUNKS)
        touched = np.array_split(trainer.squares.flat > 0, _CHUNKS)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(_CHUNKS), pa.int32()),
                pa.array([part.astype(np.float16).tobytes() for part in change], pa.binary()),
                pa.array([np.packbits(part).tobytes() for part in touched], pa.binary()),
            ],
            ["chunk", "change", "touched"],
        )

    return run


def _average(key: tuple[pa.Scalar, ...], parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The mean change of each weight over the tasks that touched it, a part at a time."""
    total = times = None
    for batch in parts:
        for change, touched in zip(
            batch.column("change").to_pylist(), batch.column("touched").to_pylist(), strict=True
        ):
            one = np.frombuffer(change, np.float16).astype(np.float64)
            mark = np.unpackbits(np.frombuffer(touched, np.uint8), count=len(one))
            total = one if total is None else total + one
            times = mark.astype(np.int64) if times is None else times + mark
    mean = (total / np.maximum(times, 1)).astype(np.float32)
    yield pa.RecordBatch.from_arrays(
        [pa.array([key[0].as_py()], pa.int32()), pa.array([mean.tobytes()], pa.binary())],
        ["chunk", "change"],
    )


def _train(blocks: DataFrame, heads: np.ndarray) -> np.ndarray:
    weights = _Weights().flat
    for number in range(ROUNDS):
        own = blocks.where(F.pmod(F.xxhash64("block"), F.lit(ROUNDS)) == number)
        changes = map_arrow(
            own.coalesce(TRAIN_TASKS), _train_blocks(weights, heads), "chunk int, change binary, touched binary"
        )
        rows = changes.groupBy("chunk").applyInArrow(_average, "chunk int, change binary").collect()
        if rows:
            rows.sort(key=lambda row: row["chunk"])
            parts = [np.frombuffer(row["change"], np.float32) for row in rows]
            weights = weights + np.concatenate(parts)
    return weights


def _score_block(weights: np.ndarray, heads: np.ndarray, inner: np.ndarray):
    model = _Weights(weights)

    def run(blocks: pa.Table, counts: pa.Table) -> pa.Table:
        row = blocks.to_pylist()[0]
        block = _Block.of(row, heads)
        known = np.zeros(len(block.hashes), np.int64)
        known[counts.column("local").to_numpy()] = counts.column("total").to_numpy()
        base = np.log10(known + 1.0)
        word = base - inner[block.cells]
        starts = block.ends[:-1]
        model_log = np.empty(len(block.tokens))
        for begin in range(0, len(block.tokens), BATCH_TOKENS):
            stop = min(begin + BATCH_TOKENS, len(block.tokens))
            cells = block.cells[block.tokens[begin:stop]]
            model_log[begin:stop] = model.log10(block.features(begin, stop), cells)
        model_log += word[block.tokens]
        seen = (known > 0)[block.tokens].astype(np.int64)
        return pa.table(
            {
                "doc_id": pa.array(row["doc_ids"], pa.int64()),
                "held_out": pa.array(row["held"], pa.bool_()),
                "n_tokens": np.diff(block.ends),
                "n_known": np.add.reduceat(seen, starts),
                "base_sum": np.add.reduceat(base[block.tokens], starts),
                "score": np.add.reduceat(model_log, starts),
            }
        )

    return run


def score_documents(docs: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of
    ``docs(doc_id, text)``.

    Tokens are the text's words, A-Z in lower case, and one end; a null or empty text is its end alone.
    Rows whose crc32 remainder modulo 7 is 2 are held out of all counts and training; a null
    id counts as the empty text. Repeated rows count and are scored as often as they stand
    there. Without any training row both scores follow from a vocabulary of nothing.
    """
    ship_code(docs.sparkSession)
    source = docs.select(
        "doc_id",
        F.col("text").cast("binary").alias("text"),
        (id_remainder("doc_id", FOLDS) == HELD_FOLD).alias("held"),
    )
    with arrow_rows(docs.sparkSession, 1_000):
        built = stored(map_arrow(source, _build_blocks(block_tokens), _BLOCKS), "lm-blocks")
    blocks = built.where("word is null").select(
        "block", "doc_ids", "held", "ends", "tokens", "hashes", "cells"
    )
    by_word = Window.partitionBy("word").orderBy("block")
    everywhere = by_word.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    words = built.where("word is not null").select("block", "local", "word", "cell", "n")
    counts = stored(
        words.select(
            "block",
            "local",
            F.sum("n").over(everywhere).alias("total"),
            (F.row_number().over(by_word) == 1).alias("first"),
            "cell",
        ),
        "lm-counts",
    )
    known = counts.where("first and total > 0")
    totals = {
        row["cell"]: (row["n"], row["v"])
        for row in known.groupBy("cell").agg(F.sum("total").alias("n"), F.count("*").alias("v")).collect()
    }
    train_tokens = sum(n for n, _ in totals.values())
    vocabulary = sum(v for _, v in totals.values())
    top = known.orderBy(F.desc("total"), "block", "local").limit(HEAD).collect()
    spots = docs.sparkSession.createDataFrame(
        [(row["block"], row["local"], place) for place, row in enumerate(top)],
        "block bigint, local int, place int",
    )
    found = words.select("block", "local", "word").join(F.broadcast(spots), ["block", "local"])
    heads = np.zeros(len(top), np.uint64)
    for row in found.select("place", "word").collect():
        heads[row["place"]] = _hashes([bytes(row["word"])])[0]
    inner_n, inner_v = np.zeros(CELLS), np.zeros(CELLS)
    for cell, (n, v) in totals.items():
        inner_n[cell], inner_v[cell] = n, v
    for place, row in enumerate(top):
        inner_n[row["cell"]] -= row["total"]
        inner_v[row["cell"]] -= 1
        inner_n[place], inner_v[place] = row["total"], 1
    inner = np.log10(inner_n + inner_v + 1)

    weights = _train(blocks, heads)
    scored = (
        blocks.groupBy("block")
        .cogroup(counts.select("block", "local", "total").groupBy("block"))
        .applyInArrow(
            _score_block(weights, heads, inner),
            "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_sum double, "
            "score double",
        )
    )
    norm = float(np.log10(train_tokens + vocabulary + 1))
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(train_tokens).cast("bigint").alias("train_tokens"),
        (F.col("base_sum") - F.col("n_tokens") * norm).alias("base_score"),
        "score",
    )
