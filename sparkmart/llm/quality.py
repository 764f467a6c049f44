"""Quality classifier: random Fourier features, summed normal equations, isotonic calibration.

A text becomes about two dozen statistics (``text_statistics``). A Gaussian kernel over their
standardised values is approximated by cosines of random projections (Rahimi and Recht). The
ridge weights solve normal equations that each partition sums over its rows, so that only
one small matrix per task reaches the driver. A fold that the ridge fit did not see calibrates the
scores: they are counted in narrow bins by Spark, and pool-adjacent-violators runs over the bins.

The classifier is fitted on at most ``max_rows`` labelled documents; every document is scored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import free_name, id_remainder, labelled_sample, map_arrow, stored

MAX_ROWS = 50_000
FEATURES = 256
WIDTH = 2.5
RIDGE = 1e-3
FIT_TASKS = 8
CALIBRATION_FOLD = 1
BINS = 1_000
KEEP_FROM = 0.3

_STOPS = tuple(".!?:;,\"')]}»”…")
_UPPER, _LOWER, _DIGIT = (np.zeros(256, bool) for _ in range(3))
_UPPER[65:91] = _LOWER[97:123] = _DIGIT[48:58] = True
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_PLAIN = np.isin(np.arange(256), list(b".,;:!?'\"()-"))
_MARKS = ~(_UPPER | _LOWER | _DIGIT | _SPACE | _PLAIN) & (np.arange(256) < 128)


def text_statistics(text: str | None) -> list[float]:
    """Statistics of a whole text; the empty text has zeros."""
    text = text or ""
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    counts = np.bincount(data, minlength=256).astype(float)
    n_bytes = max(1.0, counts.sum())
    words = text.split()
    n_words = max(1, len(words))
    lines = [line for line in text.split("\n") if line.strip()]
    n_lines = max(1, len(lines))
    frequent = Counter(words)
    top = frequent.most_common(1)[0][1] if words else 0
    letters = max(1.0, counts[_UPPER].sum() + counts[_LOWER].sum())
    present = counts[counts > 0] / n_bytes
    lengths = np.fromiter(map(len, words), float, len(words)) if words else np.zeros(1)
    triples = len(set(zip(words, words[1:], words[2:], strict=False)))
    return [
        float(np.log1p(len(text))),
        float(np.log1p(len(words))),
        float(lengths.mean()),
        float(lengths.std()),
        float((lengths <= 3).mean()),
        float((lengths > 20).mean()),
        float(counts[_UPPER].sum() / letters),
        float(counts[_DIGIT].sum() / n_bytes),
        float(counts[_SPACE].sum() / n_bytes),
        float(counts[_MARKS].sum() / n_words),
        float(counts[33] / n_words),
        float(counts[63] / n_words),
        float(counts[124] / n_words),
        float((counts[46] + counts[44]) / n_words),
        float(counts[128:].sum() / n_bytes),
        float(-(present * np.log(present)).sum()) if words else 0.0,
        len(frequent) / n_words,
        top / n_words,
        triples / max(1, n_words - 2),
        sum(word.isupper() for word in words) / n_words,
        sum(not word.isalpha() for word in words) / n_words,
        float(np.log1p(n_lines)),
        float(np.log1p(n_words / n_lines)),
        1 - len(set(lines)) / n_lines,
        sum(line.rstrip().endswith(_STOPS) for line in lines) / n_lines,
        sum(len(line) < 30 for line in lines) / n_lines,
    ]


N_STATISTICS = len(text_statistics(""))


def _statistics(texts: list[str | None]) -> np.ndarray:
    return np.array([text_statistics(text) for text in texts], float).reshape(-1, N_STATISTICS)


@dataclass
class QualityModel:
    """What scoring needs: a few hundred kilobytes, whatever the corpus."""

    mean: np.ndarray
    scale: np.ndarray
    projection: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    knots: tuple[np.ndarray, np.ndarray] | None = None

    def design(self, statistics: np.ndarray) -> np.ndarray:
        standard = np.clip((statistics - self.mean) / self.scale, -6, 6)
        waves = np.cos(standard @ self.projection + self.phase) * np.sqrt(2 / len(self.phase))
        return np.hstack([np.ones((len(standard), 1)), standard, waves])

    def raw(self, statistics: np.ndarray) -> np.ndarray:
        return self.design(statistics) @ self.weights

    def score(self, texts: list[str | None]) -> np.ndarray:
        found = self.raw(_statistics(texts))
        if self.knots is not None:
            found = np.interp(found, *self.knots)
        return np.clip(found, 0.0, 1.0)


def _sample_statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = _statistics(batch.column("text").to_pylist())
        ends = np.arange(len(found) + 1, dtype=np.int32) * N_STATISTICS
        values = pa.ListArray.from_arrays(pa.array(ends), pa.array(found.ravel()))
        yield pa.RecordBatch.from_arrays(
            [values, batch.column("y"), batch.column("fold")], ["x", "y", "fold"]
        )


def _read(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, N_STATISTICS)
    return x, batch.column("y").to_numpy(zero_copy_only=False)


def _partial_sums(model: QualityModel):
    """One row per partition: the sums of z z' and z y over its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 1 + N_STATISTICS + len(model.phase)
        gram, right, rows = np.zeros((size, size)), np.zeros(size), 0
        for batch in batches:
            x, y = _read(batch)
            z = model.design(x)
            gram += z.T @ z
            right += z.T @ y
            rows += len(y)
        if rows:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([gram.tobytes()], pa.binary()),
                    pa.array([right.tobytes()], pa.binary()),
                    pa.array([rows], pa.int64()),
                ],
                ["gram", "right", "n"],
            )

    return run


def _binned(model: QualityModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = _read(batch)
            spot = np.clip((model.raw(x) + 0.5) / 2 * BINS, 0, BINS - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(spot), pa.array(y)], ["bin", "y"])

    return run


def isotonic(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: the closest rising sequence in weighted squares."""
    blocks: list[list[float]] = []
    for v, w in zip(value.tolist(), weight.tolist(), strict=True):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, n2 = blocks.pop()
            v1, w1, n1 = blocks[-1]
            blocks[-1] = [(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2]
    return np.concatenate([np.full(int(n), v) for v, _, n in blocks])


def fit_quality(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> QualityModel:
    """The classifier, from documents whose crc32 remainder is not 0 modulo 5.

    Without any usable label every document scores 1 (nothing is known against it).
    """
    sample = labelled_sample(docs, labels, "quality", max_rows)
    rows = stored(
        map_arrow(
            sample.select("text", "y", "fold"), _sample_statistics, "x array<double>, y double, fold bigint"
        ),
        "quality-sample",
    )
    columns = [F.col("x")[i] for i in range(N_STATISTICS)]
    summary = rows.select(
        F.count("*"), F.avg("y"), *(F.avg(c) for c in columns), *(F.stddev_pop(c) for c in columns)
    ).first()
    draw = np.random.default_rng(4)
    projection = draw.normal(size=(N_STATISTICS, FEATURES)) / (WIDTH * np.sqrt(N_STATISTICS))
    phase = draw.uniform(0, 2 * np.pi, FEATURES)
    size = 1 + N_STATISTICS + FEATURES
    if not summary[0]:
        weights = np.zeros(size)
        weights[0] = 1.0
        zeros = np.zeros(N_STATISTICS)
        return QualityModel(zeros, zeros + 1, projection, phase, weights)
    mean = np.array(summary[2 : 2 + N_STATISTICS], float)
    scale = np.array(summary[2 + N_STATISTICS :], float)
    model = QualityModel(
        mean, np.where(scale > 1e-9, scale, 1.0), projection, phase, np.zeros(size)
    )
    fitted = rows.where(F.col("fold") != CALIBRATION_FOLD)
    gram, right, n = np.zeros((size, size)), np.zeros(size), 0
    for part in map_arrow(
        fitted.coalesce(FIT_TASKS), _partial_sums(model), "gram binary, right binary, n bigint"
    ).collect():
        gram += np.frombuffer(part["gram"]).reshape(size, size)
        right += np.frombuffer(part["right"])
        n += part["n"]
    penalty = np.full(size, RIDGE * max(1, n))
    penalty[0] = 1e-9
    model.weights = np.linalg.solve(gram + np.diag(penalty), right)
    held = rows.where(F.col("fold") == CALIBRATION_FOLD)
    bins = (
        map_arrow(held, _binned(model), "bin bigint, y double")
        .groupBy("bin")
        .agg(F.count("*").alias("n"), F.avg("y").alias("y"))
        .orderBy("bin")
        .collect()
    )
    if len(bins) > 1:
        centres = np.array([(row["bin"] + 0.5) / BINS * 2 - 0.5 for row in bins])
        rising = isotonic(
            np.array([row["y"] for row in bins]), np.array([float(row["n"]) for row in bins])
        )
        model.knots = (centres, rising)
    return model


def _scored(model: QualityModel, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.score(batch.column("text").to_pylist())
            yield batch.append_column(name, pa.array(scores, pa.float64()))

    return run


def with_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """All rows and columns of ``docs`` and ``score`` (0 to 1) of the whole text; a null text
    scores as the empty one. Where ``docs`` has a column ``score`` itself, which stays, the new one
    is ``score_1`` or the next name that is free. Repeated rows score alike; no rows give none."""
    name = free_name(docs, "score")
    schema = docs.select("*", F.lit(0.0).alias(name)).schema
    return map_arrow(docs, _scored(model, name), schema)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs``; a null id counts as
    held out, as does every id whose crc32 remainder modulo 5 is 0."""
    scored = with_quality(docs.select("doc_id", "text"), fit_quality(docs, labels))
    return scored.select(
        "doc_id",
        (id_remainder("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= KEEP_FROM).cast("int").alias("predicted"),
    )
