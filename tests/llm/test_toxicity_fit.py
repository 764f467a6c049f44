"""The fitted toxicity classifier against a dense fit over every bucket, without Spark."""

import random
import zlib

import duckdb
import numpy as np
import pytest
from sparkmart.llm import queries, toxicity


def _corpus():
    draw = random.Random(5)
    plain = [f"word{n}" for n in range(40)]
    bad = ["vilest", "grumpus", "snarlet"]
    rows = []
    for doc_id in range(1, 161):
        toxic = int(doc_id % 4 == 0)
        words = draw.choices(plain, k=30)
        if toxic:
            words[draw.randrange(30)] = draw.choice(bad)
        rows.append((doc_id, " ".join(words), toxic))
    return rows


def _dense_fit(x, y):
    """Proximal steps over all buckets that were seen, to the end."""
    ratio = toxicity.log_ratios(y @ x, (1 - y) @ x, y.sum(), (1 - y).sum())
    values = x * ratio
    n, share = len(y), y.mean()
    penalty = toxicity.PENALTY / np.sqrt(n)
    pace = 4 * n / (np.linalg.norm(np.hstack([values, np.ones((n, 1))]), 2) ** 2)
    weights, bias = np.zeros(x.shape[1]), np.log(share / (1 - share))
    ahead, ahead_bias, t = weights, bias, 1.0
    for _ in range(3_000):
        miss = (1 / (1 + np.exp(-(values @ ahead + ahead_bias))) - y) / n
        moved = ahead - pace * (miss @ values)
        new = np.sign(moved) * np.maximum(np.abs(moved) - pace * penalty, 0)
        new_bias = ahead_bias - pace * miss.sum()
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t_new * (new - weights)
        ahead_bias = new_bias + (t - 1) / t_new * (new_bias - bias)
        weights, bias, t = new, new_bias, t_new
    return ratio * weights, bias


def test_fit_equals_a_dense_fit(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "STEPS", 100)
    monkeypatch.setattr(toxicity, "PACKED", 5_000)
    rows = _corpus()
    docs = spark.createDataFrame([(i, text) for i, text, _ in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame(
        [(i, 1, toxic) for i, _, toxic in rows], "doc_id bigint, quality int, toxic int"
    )
    model = toxicity.fit_toxicity(docs, labels)
    texts = [text for _, text, _ in rows]
    every = np.ones(toxicity.BUCKETS, bool)
    found = [toxicity.present(text, every) for text in texts]
    seen = np.unique(np.concatenate(found))
    x = np.array([np.isin(seen, one, assume_unique=True) for one in found], float)
    y = np.array([toxic for _, _, toxic in rows], float)
    fold = np.array([zlib.crc32(str(i).encode()) % 5 for i, _, _ in rows])
    learned, fitted = fold != 0, (fold != 0) & (fold != toxicity.CALIBRATION_FOLD)
    held = fold == toxicity.CALIBRATION_FOLD
    weights, bias = _dense_fit(x[fitted], y[fitted])
    slope, offset = toxicity.calibration(x[held] @ weights + bias, np.ones(held.sum()), y[held])
    weights, bias = _dense_fit(x[learned], y[learned])
    wanted = 1 / (1 + np.exp(-(slope * (x @ weights + bias) + offset)))
    assert model.score(texts) == pytest.approx(wanted, abs=0.03)
    assert ((model.score(texts) >= 0.5) == (y > 0)).mean() > 0.95


def test_calibration_finds_a_planted_curve_and_bears_few_rows():
    sums = np.linspace(-4, 4, 400)
    rows = np.full(400, 50.0)
    slope, offset = toxicity.calibration(sums, rows, rows / (1 + np.exp(-(1.7 * sums + 0.6))))
    assert (slope, offset) == pytest.approx((1.7, 0.6), abs=0.02)
    assert toxicity.calibration(np.zeros(2), np.zeros(2), np.zeros(2)) == (1.0, 0.0)
    slope, offset = toxicity.calibration(np.array([-9.0, 9.0]), np.ones(2), np.array([0.0, 1.0]))
    assert 0.5 < slope < 2 and abs(offset) < 0.5


def test_rows_without_both_kinds_give_the_share(spark):
    docs = spark.createDataFrame([(n, f"text {n}") for n in range(20)], "doc_id bigint, text string")
    for toxic in (0, 1):
        labels = spark.createDataFrame(
            [(n, 1, toxic) for n in range(20)], "doc_id bigint, quality int, toxic int"
        )
        scores = {row["score"] for row in toxicity.score_documents(docs, labels).collect()}
        assert len(scores) == 1 and abs(scores.pop() - toxic) < 1e-5


def test_held_out_recall(spark):
    sf_dir = "/root/testdata/sf0.01"
    toxic = dict(duckdb.sql(f"select doc_id, toxic from '{sf_dir}/labels.parquet'").fetchall())
    held = [r for r in queries.QUERIES["op2_toxicity"](spark, sf_dir).collect() if r["held_out"]]
    known = [(toxic[r["doc_id"]], r["predicted"]) for r in held if r["doc_id"] in toxic]
    assert sum(t and p for t, p in known) >= 4
    assert sum(p and not t for t, p in known) <= 1
