"""Toxicity: a linear classifier over character n-grams, scaled by naive Bayes log-count ratios.

1. Every labelled text gives the set of its hashed n-grams of 3 to 6 characters (lower case, white space
   runs as one space). Spark counts, per bucket, the toxic and the other documents that have it.
2. r = log ((p + a) / |p|) - log ((q + a) / |q|) is the bucket's log-count ratio (Wang and
   Manning), and every bucket that was seen is a feature of value r where a text has it.
3. Logistic regression with an absolute penalty, which falls with the root of the number of rows, by
   accelerated proximal steps: tasks sum the gradient over their rows, the driver moves one vector. A
   bucket whose slope at the start is below the penalty would stay at zero there, so the steps
   carry the others only; no bucket is left out for its rank or number.
4. A second model without one fold runs along in the same steps. Its sums on that fold fit slope and
   offset of a logistic calibration, which the model of all folds then takes over.
5. Scoring looks up r times the weight for each n-gram of the whole text, once per bucket.

The classifier is fitted on at most ``max_rows`` labelled documents; every document is scored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import arrow_rows, id_remainder, labelled_sample, map_arrow, stored

MAX_ROWS = 50_000
SIZES = (3, 4, 5, 6)
BUCKETS = 1 << 20
SMOOTHING = 1.0
CALIBRATION_FOLD = 4
# Over the root of the number of rows: the weight of the absolute penalty.
PENALTY = 0.056
STEPS = 30
SETTLED = 1e-5
# Passes that estimate the largest curvature, and the margin on what they find.
CURVE_PASSES = 5
CURVE_MARGIN = 1.2
FIT_TASKS = 8
# Features that one packed row holds, give or take a document.
PACKED = 250_000
# The calibration's histogram of sums, from -SPAN to SPAN.
BINS = 4096
SPAN = 40.0
TOXIC_FROM = 0.5
# A longer text is hashed in slices that overlap by less than an n-gram.
SLICE = 250_000

_SPACES = re.compile(r"\s+")
_FACTOR = np.uint64(0x100000001B3)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _ngram_buckets(text: str | None) -> Iterator[np.ndarray]:
    """The buckets of a text's n-grams, with repeats, in arrays of bounded size."""
    flat = _SPACES.sub(" ", f" {text or ''} ").lower()
    line = np.frombuffer(flat.encode("utf-32-le", "replace"), np.uint32)
    for start in range(0, len(line), SLICE - max(SIZES) + 1):
        codes = line[start : start + SLICE].astype(np.uint64)
        rolled = codes
        for size in range(2, max(SIZES) + 1):
            if len(codes) < size:
                break
            rolled = rolled[:-1] * _FACTOR
            rolled += codes[size - 1 :]
            if size in SIZES:
                yield ((rolled * _GOLDEN) >> np.uint64(44)).view(np.int64)


def present(text: str | None, wanted: np.ndarray) -> np.ndarray:
    """The wanted buckets that a text has, each once."""
    found = [buckets[wanted[buckets]] for buckets in _ngram_buckets(text)]
    return np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with each bucket in this task, weighted by label: of all folds, and of those
    that the calibration does not use."""
    here = np.zeros(BUCKETS, bool)
    counts = np.zeros((4, BUCKETS))
    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in ("text", "y", "fold")]
        for text, y, fold in zip(*columns, strict=True):
            for buckets in _ngram_buckets(text):
                here[buckets] = True
            seen = np.flatnonzero(here)
            here[seen] = False
            counts[0, seen] += y
            counts[1, seen] += 1 - y
            if fold != CALIBRATION_FOLD:
                counts[2, seen] += y
                counts[3, seen] += 1 - y
    seen = np.flatnonzero(counts[0] + counts[1])
    yield pa.RecordBatch.from_arrays(
        [pa.array(seen), *(pa.array(row[seen]) for row in counts)], ["bucket", *_COUNTS]
    )


_COUNTS = ["p", "q", "fitted_p", "fitted_q"]


def _feature_rows(index: np.ndarray):
    """Labelled documents as the numbers of their features, several packed in one row.

    The numbers rise within a document, so a row keeps the steps between them: one byte each,
    and those that need more beside them.
    """
    wanted = index >= 0

    def packed(found: list[np.ndarray], y: list[float], held: list[bool]) -> pa.RecordBatch:
        steps = np.diff(np.concatenate(found), prepend=0)
        short = (steps >= 0) & (steps < _LONG_STEP)
        parts = (
            np.where(short, steps, _LONG_STEP).astype(np.uint8),
            steps[~short].astype(np.int32),
            np.array([len(one) for one in found], np.int32),
            np.array(y, np.float64),
            np.array(held, np.bool_),
        )
        arrays = [pa.array([part.tobytes()], pa.binary()) for part in parts]
        return pa.RecordBatch.from_arrays(arrays, ["short", "long", "sizes", "y", "held"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, labels, held, total = [], [], [], 0
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("text", "y", "fold")]
            for text, y, fold in zip(*columns, strict=True):
                found.append(index[present(text, wanted)])
                labels.append(y)
                held.append(fold == CALIBRATION_FOLD)
                total += len(found[-1])
                if total >= PACKED or len(found) >= PACKED:
                    yield packed(found, labels, held)
                    found, labels, held, total = [], [], [], 0
        if found:
            yield packed(found, labels, held)

    return run


_PACKED_ROW = "short binary, long binary, sizes binary, y binary, held binary"
_LONG_STEP = 255


def _unpacked(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
    """Per packed row: feature numbers, the document of each, labels, and which rows are held."""
    kinds = (np.uint8, np.int32, np.int32, np.float64, np.bool_)
    for row in zip(*(column for column in batch.columns), strict=True):
        short, long, sizes, y, held = (
            np.frombuffer(part.as_buffer(), kind) for part, kind in zip(row, kinds, strict=True)
        )
        steps = short.astype(np.int64)
        steps[short == _LONG_STEP] = long
        yield np.cumsum(steps), np.repeat(np.arange(len(y)), sizes), y, held


def _pass(values: np.ndarray, states: np.ndarray, curve: bool):
    """Per task: the sums over its rows of feature times miss, for both models. With ``curve``,
    of feature times the row's own sum, which is one step of a power iteration."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(states.shape)
        scaled = values * states[:, :-1]
        for batch in batches:
            for f, owner, y, held in _unpacked(batch):
                for model in range(2):
                    value = np.bincount(owner, scaled[model][f], len(y)) + states[model, -1]
                    miss = value if curve else _sigmoid(value) - y
                    if model:
                        miss = np.where(held, 0.0, miss)
                    sums[model, :-1] += np.bincount(f, miss[owner], values.shape[1])
                    sums[model, -1] += miss.sum()
        sums[:, :-1] *= values
        yield pa.RecordBatch.from_arrays([pa.array([sums.tobytes()], pa.binary())], ["sums"])

    return run


def _held_sums(values: np.ndarray, state: np.ndarray):
    """Per task: rows and labels of the calibration fold by bins of their sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, BINS))
        for batch in batches:
            for f, owner, y, held in _unpacked(batch):
                value = np.bincount(owner, (values * state[:-1])[f], len(y)) + state[-1]
                place = ((value[held] + SPAN) / (2 * SPAN) * BINS).clip(0, BINS - 1).astype(np.int64)
                sums += np.bincount(place, minlength=BINS), np.bincount(place, y[held], BINS)
        yield pa.RecordBatch.from_arrays([pa.array([sums.tobytes()], pa.binary())], ["sums"])

    return run


def _summed(rows: DataFrame, function, shape: tuple[int, int]) -> np.ndarray:
    total = np.zeros(shape)
    with arrow_rows(rows.sparkSession, 8):
        parts = map_arrow(rows, function, "sums binary").collect()
    for part in parts:
        total += np.frombuffer(part["sums"]).reshape(shape)
    return total


def log_ratios(p: np.ndarray, q: np.ndarray, toxic: float, other: float) -> np.ndarray:
    """Log-count ratios by bucket from the counts of toxic and other texts; 0 if unseen."""
    a = SMOOTHING
    ratio = np.log((p + a) / (toxic + 2 * a)) - np.log((q + a) / (other + 2 * a))
    return np.where(p + q > 0, ratio, 0.0)


def calibration(sums: np.ndarray, rows: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve from sums to labels, drawn to 1 and 0 by a normal
    prior of unit width, so few or separable rows keep it near them; the slope is positive."""
    slope, offset = 1.0, 0.0
    for _ in range(100):
        chance = _sigmoid(slope * sums + offset)
        miss, spread = rows * chance - labels, rows * chance * (1 - chance)
        gradient = np.array([miss @ sums + slope - 1, miss.sum() + offset])
        cross = spread @ sums
        bend = np.array([[spread @ sums**2 + 1, cross], [cross, spread.sum() + 1]])
        move = np.linalg.solve(bend, gradient)
        move /= max(1.0, np.abs(move).max())
        slope, offset = slope - move[0], offset - move[1]
        if np.abs(move).max() < 1e-9:
            break
    return max(slope, 0.1), offset


def _sigmoid(value: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(value, -40, 40)))


@dataclass
class ToxicityModel:
    """Weight times ratio by bucket (0: no feature) and the bias; 4 MB whatever the corpus."""

    weights: np.ndarray
    bias: float

    def score(self, texts: list[str | None]) -> np.ndarray:
        wanted = self.weights != 0
        sums = [float(self.weights[present(text, wanted)].sum()) for text in texts]
        return _sigmoid(self.bias + np.array(sums, float))


def fit_toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> ToxicityModel:
    """The classifier, from documents whose crc32 remainder is not 0 modulo 5.

    Without usable labels of both kinds no feature is left and every document gets the
    share of toxic labels as its score (0 without any label).
    """
    sample = stored(
        labelled_sample(docs, labels, "toxic", max_rows).select("text", "y", "fold"),
        "toxicity-sample",
    )
    fitted = F.col("fold") != CALIBRATION_FOLD
    total, toxic, fitted_total, fitted_toxic = sample.select(
        F.count("*"),
        F.coalesce(F.sum("y"), F.lit(0.0)),
        F.count(F.when(fitted, 1)),
        F.coalesce(F.sum(F.when(fitted, F.col("y"))), F.lit(0.0)),
    ).first()
    share = min(max(toxic / total, 1e-6), 1 - 1e-6) if total else 1e-6
    bias, weights = float(np.log(share / (1 - share))), np.zeros(BUCKETS, np.float32)
    if not 0 < toxic < total:
        return ToxicityModel(weights, bias)
    # One row per bucket, whatever the corpus.
    found = (
        map_arrow(sample, _count, "bucket bigint, " + ", ".join(f"{name} double" for name in _COUNTS))
        .groupBy("bucket")
        .agg(*(F.sum(name).alias(name) for name in _COUNTS))
        .toArrow()
    )
    counts = np.zeros((4, BUCKETS))
    counts[:, found.column("bucket").to_numpy()] = [found.column(name).to_numpy() for name in _COUNTS]
    # Without both kinds among the fitted folds the second model is the first, and no fold calibrates.
    calibrated = 0 < fitted_toxic < fitted_total < total
    if not calibrated:
        counts[2:], fitted_total, fitted_toxic = counts[:2], total, toxic
    sizes = np.array([[float(total)], [float(fitted_total)]])
    shares = np.array([[toxic], [fitted_toxic]]) / sizes
    penalty = PENALTY / np.sqrt(sizes)
    ratios = np.stack(
        [
            log_ratios(*counts[:2], toxic, total - toxic),
            log_ratios(*counts[2:], fitted_toxic, fitted_total - fitted_toxic),
        ]
    )
    slopes = ratios * (shares * (counts[0::2] + counts[1::2]) - counts[0::2]) / sizes
    active = np.flatnonzero((np.abs(slopes) > penalty).any(axis=0))
    if not len(active):
        return ToxicityModel(weights, bias)
    index = np.full(BUCKETS, -1, np.int64)
    index[active] = np.arange(len(active))
    ratios = ratios[:, active]
    # The steps go in units in which frequent and rare buckets bend the loss alike to half the
    # power; weights and penalties change with them, so the optimum stays.
    seen = (counts[0::2] + counts[1::2])[:, active] / sizes
    unit = np.sqrt(np.abs(ratios) * np.sqrt(seen))
    unit[unit == 0] = 1.0
    values = ratios / unit
    rows = stored(map_arrow(sample, _feature_rows(index), _PACKED_ROW), "toxicity-features").coalesce(
        FIT_TASKS
    )
    states = _descended(rows, values, sizes, penalty / unit, np.log(shares / (1 - shares)))
    slope, offset = 1.0, 0.0
    if calibrated:
        held = _summed(rows, _held_sums(values[1], states[1]), (2, BINS))
        centres = (np.arange(BINS) + 0.5) / BINS * 2 * SPAN - SPAN
        slope, offset = calibration(centres, *held)
    weights[active] = slope * values[0] * states[0, :-1]
    return ToxicityModel(weights, float(slope * states[0, -1] + offset))


def _descended(
    rows: DataFrame, values: np.ndarray, sizes: np.ndarray, penalty: np.ndarray, bias: np.ndarray
) -> np.ndarray:
    """Weights and bias of both models after STEPS accelerated proximal steps, or fewer if settled.

    Each step is one job whose tasks send one vector each; their order is that of the partitions,
    so a run on the same files gives the same numbers.
    """
    shape = (2, values.shape[1] + 1)
    states = np.ones(shape)
    for _ in range(CURVE_PASSES):
        states = _summed(rows, _pass(values, states, True), shape)
        curve = np.linalg.norm(states, axis=1, keepdims=True)
        states /= curve
    pace = 4 * sizes / (CURVE_MARGIN * curve)
    shrink = np.hstack([penalty * pace, np.zeros((2, 1))])
    here = np.zeros(shape)
    here[:, -1:] = bias
    ahead, weight = here.copy(), 1.0
    for _ in range(STEPS):
        moved = ahead - pace * _summed(rows, _pass(values, ahead, False), shape) / sizes
        there = np.sign(moved) * np.maximum(np.abs(moved) - shrink, 0)
        next_weight = (1 + np.sqrt(1 + 4 * weight**2)) / 2
        ahead = there + (weight - 1) / next_weight * (there - here)
        settled = np.abs(there - here).max() < SETTLED
        here, weight = there, next_weight
        if settled:
            break
    return here


def _scored(model: ToxicityModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.score(batch.column("text").to_pylist())
            yield batch.drop_columns(["text"]).append_column("score", pa.array(scores))

    return run


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs``.

    Null texts score as the empty one. A null id counts as held out, as does every id whose
    crc32 remainder modulo 5 is 0. Only ``doc_id`` and ``text`` are read.
    """
    model = fit_toxicity(docs, labels)
    scored = map_arrow(docs.select("doc_id", "text"), _scored(model), "doc_id bigint, score double")
    return scored.select(
        "doc_id",
        (id_remainder("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
    )
