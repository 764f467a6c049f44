"""Source mixing: targets by hand, copies by their bounds, odd rows."""

import collections
import re

import pytest
from pyspark.sql import functions as F
from sparkmart.llm.mixing import mixed, plan_mix, targets, word_count

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shared(sizes, weights=(5, 2, 1), most=3):
    """Targets by sharing again what is over until none is above its bound."""
    weight = {s: weights[k % len(weights)] for k, s in enumerate(sorted(sizes))}
    target = {s: sum(sizes.values()) * weight[s] / sum(weight.values()) for s in sizes}
    while over := {s for s in sizes if target[s] > most * sizes[s] * (1 + 1e-12)}:
        excess = sum(target[s] - most * sizes[s] for s in over)
        target |= {s: most * sizes[s] for s in over}
        free = [s for s in sizes if target[s] < most * sizes[s]]
        for s in free:
            target[s] += excess * weight[s] / sum(weight[f] for f in free)
    return target


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 100, "b": 100, "c": 100},
        {"a": 1, "b": 1000, "c": 20, "d": 0, "e": 7},
        {f"s{n:02d}": (n * 7919) % 1000 for n in range(40)},
        {"a": 0, "b": 0},
        {"only": 12},
    ],
)
def test_targets(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source_key string, source_size bigint")
    found = {row["source_key"]: row["target"] for row in targets(frame).collect()}
    assert found == pytest.approx(shared(sizes))


def test_words_are_counted_as_the_pattern_finds_them(spark):
    texts = [None, "", " \t\n ", "a", " a", "a ", "a b", "\x0ba\x0cb\r\nc ", "x y z\x1cq", "xxx x"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    found = [row[0] for row in frame.select(word_count(F.col("text"))).collect()]
    assert found == [len(WORD.findall(t or "")) for t in texts]


def big_plan(spark):
    source = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7))
    source = F.when(F.col("id") % 50 == 0, F.lit(None)).otherwise(source)
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"),
        source.alias("source"),
        F.repeat(F.lit("word "), (F.col("id") * 37 % 101).cast("int")).alias("text"),
        F.lit(1).alias("_range"),
        F.lit(2).alias("expected"),
    )
    return docs, plan_mix(docs, keep=["doc_id", "source"])


def test_sources_come_near_their_targets(spark):
    docs, plan = big_plan(spark)
    rows = plan.collect()
    assert len(rows) == docs.count()
    taken, target, longest = collections.Counter(), {}, collections.Counter()
    for row in rows:
        expected = row["target"] / row["source_size"]
        assert int(expected) <= row["copies"] <= int(expected) + (expected > int(expected))
        taken[row["source"]] += row["copies"] * row["size"]
        target[row["source"]] = row["target"]
        longest[row["source"]] = max(longest[row["source"]], row["size"])
    assert all(abs(taken[s] - target[s]) <= longest[s] for s in target)
    assert sum(target.values()) == pytest.approx(sum(row["size"] for row in rows))


def test_a_run_again_and_another_partitioning_agree(spark):
    docs, plan = big_plan(spark)
    again = plan_mix(docs.repartition(13), keep=["doc_id", "source"])
    assert sorted(plan.collect(), key=lambda r: r["doc_id"]) == sorted(
        again.collect(), key=lambda r: r["doc_id"]
    )
    other = plan_mix(docs, keep=["doc_id", "source"], seed=2)
    assert plan.select("doc_id", "copies").exceptAll(other.select("doc_id", "copies")).count() > 0


def test_rows_are_emitted_once_a_copy(spark):
    _, plan = big_plan(spark)
    emitted = mixed(plan)
    assert emitted.count() == plan.agg(F.sum("copies")).first()[0]
    assert emitted.where("copies = 0").count() == 0


def test_odd_rows(spark, odd_docs, no_docs):
    rows = plan_mix(odd_docs, keep=odd_docs.columns).collect()
    assert len(rows) == odd_docs.count()
    assert rows[0].asDict().keys() >= {"doc_id", "text", "score", "key", "copies"}
    for row in rows:
        assert row["size"] == len(WORD.findall(row["text"] or ""))
        assert row["copies"] <= 3 and row["target"] <= 3 * row["source_size"]
        if row["source"] is None:
            assert (row["target"], row["copies"]) == (0.0, 0)
    assert plan_mix(no_docs).collect() == []
    with pytest.raises(ValueError, match="size"):
        plan_mix(odd_docs.withColumn("size", F.lit(1)), keep=["size"])


def test_no_python_and_no_single_task(spark, plan_of):
    _, plan = big_plan(spark)
    text = plan_of(plan)
    assert "Python" not in text and "Arrow" not in text and "SinglePartition" not in text
