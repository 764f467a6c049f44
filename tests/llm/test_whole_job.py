"""What a cut of the work would leave out: each test fails if a part of the job is skipped."""

import numpy as np
from sparkmart.llm import language_model, queries, sharding


def test_a_step_moves_all_feature_kinds():
    features = np.array([[1], [20_000], [30_000], [50_000]], np.uint16)
    trainer = language_model._Trainer(language_model._Weights().flat)
    trainer.step(features, np.array([35]))
    rows = trainer.weights.lower_rows(features, np.array([35 // language_model.MEMBERS]))
    for own, below in zip(features, rows, strict=True):
        assert trainer.weights.upper[own].any()
        assert trainer.weights.lower[below].any()


def test_grouped_sums_by_row():
    draw = np.random.default_rng(4)
    rows = draw.integers(0, 50, 900).astype(np.uint16)
    values = draw.random((900, language_model.MEMBERS), np.float32)
    found, sums = language_model._grouped(rows, values)
    assert found.tolist() == sorted(set(rows.tolist()))
    for row, own in zip(found, sums, strict=True):
        assert np.allclose(own, values[rows == row].sum(axis=0), atol=1e-3)


def test_sharding_writes_whole_rows(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(sharding, "fresh_folder", lambda *_: f"file://{tmp_path}/out", raising=False)
    found = queries.op7_sharding(spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    written = spark.read.parquet(f"file://{tmp_path}/out")
    assert written.select(docs.columns).exceptAll(docs).count() == 0
    assert written.count() == docs.count() == len(found)
    assert {p.name for p in (tmp_path / "out").glob("shard=*")} == {f"shard={r['shard']}" for r in found}
