"""Registered queries against SQL twins, or brute force, over whole tables."""

import base64
import collections
import hashlib
import math
import re
import zlib

import __spark_entry__ as driver
import corpus_pipeline
import duckdb
import numpy as np
import oracle
import public_tokenizers
import pytest
from sparkmart.llm import decontamination, queries
from tokenizers import Tokenizer

FITTED = ("op2_toxicity", "op3_lm_scoring", "op4_quality_classifier", "op6_quality_rules")


def read(sf_dir, table):
    return duckdb.sql(f"select * from '{sf_dir}/{table}.parquet'").fetchall()


def words(text):
    return (text or "").encode().lower().split()


def test_all_are_registered():
    numbers = {re.match(r"op(\d+)_", name)[1] for name in queries.QUERIES}
    assert numbers == {str(n) for n in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_twin(spark, sf_dir, duck, name):
    assert oracle.differences(queries.QUERIES[name](spark, sf_dir), duck, queries.ORACLES[name]) is None


@pytest.mark.parametrize("name", ["op2_toxicity", "op4_quality_classifier"])
def test_classifiers_on_held_out_rows(spark, name):
    sf_dir = "/root/testdata/sf0.01"
    rows = queries.QUERIES[name](spark, sf_dir).collect()
    assert len(rows) == len(read(sf_dir, "documents"))
    assert all(row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0) for row in rows)
    limit, place = (0.5, 2) if name == "op2_toxicity" else (0.3, 1)
    assert all(row["predicted"] == int(row["score"] >= limit) for row in rows)
    truth = {row[0]: row[place] for row in read(sf_dir, "labels")}
    held = [row for row in rows if row["held_out"] and row["doc_id"] in truth]
    right = sum(row["predicted"] == truth[row["doc_id"]] for row in held)
    assert right / len(held) > 0.9


def test_language_model_counts_and_gain(spark, sf_dir):
    docs = {row[0]: [*words(row[1]), b"\n"] for row in read(sf_dir, "documents")}
    held = {i for i in docs if zlib.crc32(str(i).encode()) % 7 == 2}
    count = collections.Counter(w for i, ws in docs.items() if i not in held for w in ws)
    norm = math.log10(sum(count.values()) + len(count) + 1)
    rows = queries.QUERIES["op3_lm_scoring"](spark, sf_dir).collect()
    assert {row["doc_id"] for row in rows} == set(docs)
    for row in rows:
        own = docs[row["doc_id"]]
        assert row["held_out"] == (row["doc_id"] in held)
        assert (row["n_tokens"], row["n_known"]) == (len(own), sum(count[w] > 0 for w in own))
        assert row["train_tokens"] == sum(count.values())
        base = sum(math.log10(count[w] + 1) - norm for w in own)
        assert row["base_score"] == pytest.approx(base, rel=1e-9)
        assert row["score"] < 0
    unseen = [row for row in rows if row["held_out"]]
    assert sum(row["score"] for row in unseen) > sum(row["base_score"] for row in unseen)


def test_packing_round_trip(spark, sf_dir):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = queries.QUERIES["op5_best_fit_packing"](spark, sf_dir).collect()
    pieces = collections.defaultdict(list)
    for row in rows:
        pieces[row["doc_id"]].append(row)
    total = 0
    for doc_id, text, *_ in read(sf_dir, "documents"):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        data = np.array(ids, "<u4")
        own = sorted(pieces[doc_id], key=lambda row: row["piece"])
        assert [row["piece"] for row in own] == list(range(len(own)))
        assert sum(row["length"] for row in own) == len(ids)
        assert all(row["length"] == 2048 for row in own[1:])
        for row in own:
            part = data[row["start"] : row["start"] + row["length"]]
            assert zlib.crc32(part.tobytes()) == row["ids_crc32"]
        total += len(ids)
    filled = collections.defaultdict(int)
    for row in sorted(rows, key=lambda row: (row["sequence_id"], row["offset"])):
        assert filled[row["sequence_id"]] == row["offset"]
        filled[row["sequence_id"]] += row["length"]
    assert max(filled.values()) <= 2048
    assert len(filled) <= math.ceil(1.02 * total / 2048)


def test_quality_rules_base_counts(spark, sf_dir):
    rows = {r["doc_id"]: r for r in queries.QUERIES["op6_quality_rules"](spark, sf_dir).collect()}
    for doc_id, text, *_ in read(sf_dir, "documents"):
        own = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
        spans = collections.defaultdict(list)
        for start in range(len(own) - 7):
            spans[tuple(own[start : start + 8])].append(start)
        covered = {s + k for at in spans.values() if len(at) > 1 for s in at for k in range(8)}
        row = rows[doc_id]
        assert (row["n_words"], row["word_chars"]) == (len(own), sum(map(len, own)))
        assert row["n_symbols"] == len(re.findall(r"[#*$%&|<>]", text or ""))
        assert row["n_dup_lines"] == len(lines) - len(set(lines))
        assert row["n_repeat_words"] == len(covered)
        assert row["base_failed"] == (len(own) < 20 or 100 * len(covered) > 30 * len(own))
        assert not (row["kept"] and row["base_failed"])
    sound = [row for row in rows.values() if not row["base_failed"]]
    assert sum(row["kept"] for row in sound) > 0.8 * len(sound)


def brute_coverage(item, text, least=5):
    """Greedy string tiling by trying every pair of places."""
    free_item, free_text, covered = [True] * len(item), [True] * len(text), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(text)):
                k = 0
                while (
                    i + k < len(item) and j + k < len(text) and free_item[i + k]
                    and free_text[j + k] and item[i + k] == text[j + k]
                ):
                    k += 1
                best = max(best, (k, -i, -j))
        k, i, j = best[0], -best[1], -best[2]
        if k < min(least, len(item)):
            return covered
        for step in range(k):
            free_item[i + step] = free_text[j + step] = False
        covered += k


def test_decontamination_by_brute_force(spark, sf_dir):
    items = {row[0]: words(row[1]) for row in read(sf_dir, "benchmark")}
    grams = collections.defaultdict(set)
    for item_id, item in items.items():
        for start in range(max(1, len(item) - 4)):
            grams[tuple(item[start : start + 5])].add(item_id)
    expected = set()
    for doc_id, text, *_ in read(sf_dir, "documents"):
        own = words(text)
        near = set().union(*(grams.get(tuple(own[k : k + 5]), ()) for k in range(len(own))))
        for item_id in near:
            covered = brute_coverage(items[item_id], own)
            if covered >= 0.5 * len(items[item_id]):
                expected.add((doc_id, item_id, covered))
    found = queries.QUERIES["op10_decontamination"](spark, sf_dir).collect()
    assert {(r["doc_id"], r["item_id"], r["covered_words"]) for r in found} == expected


def test_reordered_passages_are_covered():
    def numbered(*spans):
        return np.array([n for a, b in spans for n in range(a, b)], np.uint64)

    text = numbered((900, 905), (30, 60), (500, 510), (0, 30))
    assert sorted(decontamination.tiles(numbered((0, 60)), text, 5)) == [(0, 45, 30), (30, 5, 30)]


def test_pipeline_keeps_what_its_stages_decide(spark, sf_dir):
    docs = corpus_pipeline.table(spark, sf_dir, "documents")
    seen = {None: {row["doc_id"]: row["text"] for row in docs.collect()}}
    for name, stage in corpus_pipeline.STAGES:
        before = list(seen.values())[-1]
        docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), f"test-{name}")
        if name == "best_fit_packing":
            assert {row["doc_id"] for row in docs.collect()} == set(before)
            continue
        assert docs.columns == corpus_pipeline.DOCUMENT_COLUMNS
        after = {row["doc_id"]: row["text"] for row in docs.collect()}
        assert set(after) <= set(before) and len(after) == docs.count()
        if name == "line_dedup":
            assert set(after) == set(before) and after != before
        else:
            assert all(after[i] == before[i] for i in after) and len(after) < len(before)
        seen[name] = after


def test_base32_of_the_empty_payload():
    from sparkmart.llm.warc import payload_digest

    assert payload_digest(b"") == base64.b32encode(hashlib.sha1(b"").digest()).decode()
