"""Columns of the caller that have the operators' names stay, and the new ones are named apart."""

from sparkmart.llm.quality import fit_quality, with_quality
from sparkmart.llm.sharding import SHARDS, place, write_shards


def test_shards_beside_a_column_of_that_name(spark, odd_docs, no_docs):
    named = odd_docs.withColumnsRenamed({"score": "shard", "key": "Shard_Slot"})
    for sharded in (place(named, "doc_id"), write_shards(named, "doc_id")):
        assert sharded.columns == [*named.columns, "shard_slot_1", "shard_1"]
        rows = sharded.collect()
        assert len(rows) == named.count()
        assert {row["shard"] for row in rows} == {"x"} and {row["shard_1"] for row in rows} <= set(SHARDS)
    assert write_shards(no_docs, "doc_id").count() == 0


def test_written_shards_keep_odd_rows(spark, odd_docs, rows):
    sharded = write_shards(odd_docs, "doc_id")
    assert rows(sharded.drop("shard_slot", "shard")) == rows(odd_docs)


def test_scores_beside_a_column_of_that_name(spark, odd_docs, labels):
    scored = with_quality(odd_docs, fit_quality(odd_docs, labels))
    assert scored.columns == [*odd_docs.columns, "score_1"]
    rows = scored.collect()
    assert len(rows) == odd_docs.count()
    assert all(row["score"] == "x" and 0 <= row["score_1"] <= 1 for row in rows)
