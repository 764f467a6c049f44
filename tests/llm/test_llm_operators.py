"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

import gzip
import hashlib
import io
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from sparkmart.llm import (
    decontamination,
    language_model,
    line_dedup,
    near_duplicates,
    packing,
    quality,
    quality_rules,
    sharding,
    shingles,
    toxicity,
    warc,
)
from sparkmart.llm.components import components
from tokenizers import Tokenizer


def test_odd_documents_keep_their_rows(odd_docs, labels):
    n = odd_docs.count()
    for frame in (
        toxicity.score_documents(odd_docs, labels),
        quality.score_documents(odd_docs, labels),
        language_model.score_documents(odd_docs),
        quality_rules.apply_rules(odd_docs),
        line_dedup.kept_digests(odd_docs),
        near_duplicates.near_duplicates(odd_docs),
        sharding.place(odd_docs, "doc_id"),
    ):
        rows = frame.collect()
        assert len(rows) == n
        assert sum(row["doc_id"] is None for row in rows) == 1


def test_empty_tables(no_docs, labels, spark):
    benchmark = spark.createDataFrame([], "item_id bigint, text string")
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    for frame in (
        toxicity.score_documents(no_docs, labels.limit(0)),
        quality.score_documents(no_docs, labels.limit(0)),
        language_model.score_documents(no_docs),
        quality_rules.apply_rules(no_docs),
        line_dedup.kept_digests(no_docs),
        near_duplicates.near_duplicates(no_docs),
        sharding.place(no_docs, "doc_id"),
        packing.pack(no_docs),
        decontamination.contaminated(no_docs, benchmark),
        warc.archive_pages(pages),
    ):
        assert frame.count() == 0


def test_scores_without_labels(odd_docs, labels):
    none = labels.limit(0)
    assert {r["score"] for r in quality.score_documents(odd_docs, none).collect()} == {1.0}
    assert {r["predicted"] for r in toxicity.score_documents(odd_docs, none).collect()} == {0}


def test_near_duplicates_of_odd_rows(odd_docs):
    rows = near_duplicates.near_duplicates(odd_docs).collect()
    by_id = {row["doc_id"]: row for row in rows}
    assert [by_id[n]["n_shingles"] for n in (1, 2, 3, 4, 5)] == [0, 0, 0, 1, 1]
    assert [by_id[n]["component_id"] for n in (1, 2, 3, 5, 6)] == [1, 2, 3, 5, 5]
    assert by_id[None]["component_id"] is None and by_id[None]["kept"]


def test_near_duplicates_lose_no_link(spark):
    """Variants of a template whose links a star around the smallest id would miss."""
    draw = random.Random(5)
    template = [f"w{draw.randrange(10**6)}" for _ in range(120)]
    texts = []
    for _ in range(150):
        copy = list(template)
        for place in draw.sample(range(120), draw.choice([1, 2, 3, 5])):
            copy[place] = f"x{draw.randrange(10**6)}"
        texts.append(" ".join(copy))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    sets = [shingles.shingle_set(text.encode()) for text in texts]
    root = list(range(len(texts)))

    def find(node):
        while root[node] != node:
            node = root[node]
        return node

    for a in range(len(texts)):
        for b in range(a):
            shared = shingles.overlap(sets[a], sets[b])
            if 100 * shared >= 75 * (len(sets[a]) + len(sets[b]) - shared):
                one, other = sorted((find(a), find(b)))
                root[other] = one
    found = near_duplicates.near_duplicates(docs).collect()
    assert {row["doc_id"]: row["component_id"] for row in found} == {n: find(n) for n in range(150)}


def test_blocks_meet_every_pair(spark, monkeypatch):
    """Buckets above the block size: each pair from different components meets in a block."""
    monkeypatch.setattr(near_duplicates, "BLOCK", 4)
    rows = [(7, n, n // 10 if n < 20 else n, 5, [0] * 32) for n in range(30)]
    members = spark.createDataFrame(
        rows, "bucket bigint, doc_id bigint, component bigint, n_shingles bigint, keys array<bigint>"
    )
    blocks = {}
    for row in near_duplicates._blocks(members).collect():
        blocks.setdefault((row["p"], row["q"]), []).append(row)
    met = set()
    for (p, q), own in blocks.items():
        for a in own:
            met |= {(a["doc_id"], b["doc_id"]) for b in own if p == q or a["part"] != b["part"]}
    component = {row[1]: row[2] for row in rows}
    assert all((a, b) in met for a in component for b in component if component[a] != component[b])


def test_components_of_chains_and_hubs(spark):
    links = [(n, n + 1) for n in range(100, 140)] + [(5, n) for n in range(6, 60)] + [(9, 9), (2, 5)]
    found = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    label = {row["id"]: row["component"] for row in found}
    assert {label[n] for n in range(100, 141)} == {100}
    assert {label[n] for n in (2, *range(5, 60))} == {2}


@pytest.mark.parametrize("partitions", ["1", "3", "40"])
def test_line_dedup_over_many_ranges(spark, partitions):
    """A line in all documents spans ranges; brute force agrees whatever their number."""
    draw = random.Random(3)
    hot, pool = "a line that stands in every document", [f"shared line number {n:05d}" for n in range(40)]
    docs = []
    for doc_id in range(120):
        lines = [hot, *draw.choices(pool, k=6), f"own line of document {doc_id:05d}", "short", ""]
        draw.shuffle(lines)
        docs.append((doc_id, "\n".join(lines + [f"  {hot.upper()} \t"])))
    holders = {}
    for doc_id, text in docs:
        for line in text.split("\n"):
            key = line.strip(" \t").lower()
            if len(key) >= 20:
                holders.setdefault(key, set()).add(doc_id)
    expected = {}
    for doc_id, text in docs:
        keys = [line.strip(" \t").lower() for line in text.split("\n")]
        left = [
            line
            for line, key in zip(text.split("\n"), keys, strict=True)
            if len(holders.get(key, ())) < 3 or max(holders[key]) == doc_id
        ]
        expected[doc_id] = hashlib.sha256("\n".join(left).encode()).hexdigest()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = spark.createDataFrame(docs, "doc_id bigint, text string")
        found = {row["doc_id"]: row["kept_sha256"] for row in line_dedup.kept_digests(frame).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found == expected


def test_line_dedup_keeps_other_columns(odd_docs):
    out = line_dedup.without_repeated_lines(odd_docs)
    assert out.columns == odd_docs.columns and out.count() == odd_docs.count()
    texts = {row["doc_id"]: row["text"] for row in out.collect()}
    assert texts[15].count("\n") == 1 and texts[10].startswith("unlike") and texts[1] is None


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 99), max_size=30), max_size=8))
def test_loser_tree_merges_like_sorted(runs):
    runs = [sorted(run) for run in runs]
    assert list(warc.LoserTree(runs, lambda item: item)) == sorted(sum(runs, []))


def test_warc_records_round_trip():
    payloads = [b"", b"x\r\n\r\n", b"WARC/1.1\r\nWARC-Type: fake\r\n\r\n", "é".encode() * 999]
    stream = "".join(
        warc.record(n, "http://a.b/c d\r\nX: y", payload, None) + warc.RECORD_END
        for n, payload in enumerate(payloads)
    ).encode()
    read = list(warc.records(io.BytesIO(stream)))
    assert [block for *_, block in read] == payloads
    assert all(stream[offset:].startswith(b"WARC/1.1") for offset, *_ in read)
    with pytest.raises(ValueError, match="cut off"):
        list(warc.records(io.BytesIO(stream[:-3])))


def test_archives_of_odd_pages(spark, tmp_path):
    rows = [
        (4, "http://www.X.org/b", "same"),
        (2, None, "same"),
        (2, None, "same"),
        (None, "no url", "same"),
        (None, "http://x.org", "alone\r\n\r\n"),
        (7, "http://x.org/a?b#c", None),
        (9, "http://x.org/z", ""),
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = warc.archive_pages(pages.withColumn("digest", F.lit("clash"))).collect()
    got = sorted(
        ((r["page_id"] or 0, r["payload_bytes"], r["record_type"], r["refers_to"] or 0) for r in found)
    )
    assert got == [
        (0, 4, "revisit", 2),
        (0, 9, "response", 0),
        (2, 4, "response", 0),
        (2, 4, "response", 0),
        (4, 4, "revisit", 2),
        (7, 0, "response", 0),
        (9, 0, "revisit", 7),
    ]
    assert sorted(r["index_position"] for r in found) == list(range(7))
    assert warc.url_key("http://www.X.org/b") == "org,x)/b"
    warc.write_archives(pages, f"file://{tmp_path}/out")
    files = list((tmp_path / "out").glob("*.gz"))
    total = sum(len(list(warc.records(io.BytesIO(gzip.decompress(f.read_bytes()))))) for f in files)
    assert total == len(rows)


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 300), max_size=20))
def test_plan_fills_sequences_once(counts):
    cells, ranks = set(), {}
    for length, low, high, first, offset in packing.plan_slots(counts, 64):
        assert ranks.get(length, 0) == low
        ranks[length] = high
        for sequence in range(first, first + high - low):
            own = {(sequence, place) for place in range(offset, offset + length)}
            assert offset + length <= 64 and not own & cells
            cells |= own
    assert ranks == counts
    sequences = {sequence for sequence, _ in cells}
    # No sequence is opened while another has room, so all but one are more than half full.
    assert len(sequences) <= 2 * sum(n * c for n, c in counts.items()) / 64 + 1


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=60))
def test_token_ids_equal_the_tokenizer(text):
    slow = packing._slow(packing.TOKENIZER)
    for one in (text, f"{text}<|endoftext|> a　  b\n\n c٣Ⅷ's{text}"):
        assert packing.token_ids(one).tolist() == slow.encode(one, add_special_tokens=False).ids
    assert isinstance(slow, Tokenizer)


def test_cut():
    assert packing.cut(2048, 2048) == [(0, 2048)]
    assert packing.cut(2049, 2048) == [(0, 1), (1, 2048)]
    assert packing.cut(5, 2048) == [(0, 5)]


def test_decontamination_in_blocks_and_odd_items(spark, odd_docs):
    items = spark.createDataFrame(
        [(1, None), (2, " "), (3, "ONE two"), (4, "unlike the others 11 77 143"), (None, "one two"), (3, "ONE two")],
        "item_id bigint, text string",
    )
    found = {
        blocks: sorted(
            (row["doc_id"], row["item_id"] or 0)
            for row in decontamination.contaminated(odd_docs, items, block_words=blocks).collect()
        )
        for blocks in (3, 1_000)
    }
    assert found[3] == found[1_000]
    assert set(found[3]) == {(5, 3), (6, 3), (5, 0), (6, 0), (11, 4)}
    assert found[3].count((5, 3)) == 2
    left = decontamination.without_benchmark(odd_docs, items)
    assert left.columns == odd_docs.columns and left.count() == odd_docs.count() - 3


def test_long_texts_are_scored_whole():
    model = quality_rules.NgramModel.estimate(np.array([0, 41, 1000, 64_000]), np.array([1, 2, 3, 4]))
    text = "ab cd. " * 300_000
    whole = model.mean_log10([text, "ab"])
    assert np.isfinite(whole).all()
    marked = "x" * 400_000 + "rarest"
    wanted = np.zeros(toxicity.BUCKETS, bool)
    wanted[np.concatenate(list(toxicity._ngram_buckets("rarest")))] = True
    assert len(toxicity.present(marked, wanted)) >= 10


def test_kneser_ney_sums_to_one():
    draw = np.random.default_rng(2)
    line = np.append(np.zeros(3, int), draw.choice([1, 10, 11, 12, 30], 4_000, p=[0.3, 0.3, 0.2, 0.1, 0.1]))
    numbers = sum(line[k : len(line) - 3 + k] * 40 ** (3 - k) for k in range(4))
    grams, counts = np.unique(numbers, return_counts=True)
    model = quality_rules.NgramModel.estimate(grams, counts)
    for context in (0, 10 * 1600 + 11 * 40 + 1, 39 * 1600 + 38 * 40 + 37):
        chances = 10 ** model.log10(context * 40 + np.arange(40))
        assert chances.sum() == pytest.approx(1, abs=1e-6)


def test_isotonic_is_the_closest_rising_fit():
    assert quality.isotonic(np.array([1.0, 3, 2, 4]), np.ones(4)).tolist() == [1, 2.5, 2.5, 4]


def test_signatures_estimate_similarity():
    draw = np.random.default_rng(1)
    pool = draw.integers(0, 2**63, 3_000).astype(np.uint64)
    a, b = np.unique(pool[:2_000]), np.unique(pool[500:2_500])
    agree = np.mean(
        [
            (
                shingles.signature(np.sort(shingles.mixed(a ^ np.uint64(s))))
                == shingles.signature(np.sort(shingles.mixed(b ^ np.uint64(s))))
            ).mean()
            for s in range(40)
        ]
    )
    assert agree == pytest.approx(0.6, abs=0.03)


def test_shards_are_even_and_steady():
    owners = sharding.fill()
    sizes = np.bincount(owners)
    assert sizes.max() - sizes.min() <= 1
    fewer = sharding.fill(sharding.SHARDS[:-1])
    moved = sum(a != b for a, b in zip(owners, fewer, strict=True) if a != len(sharding.SHARDS) - 1)
    assert moved < 0.1 * len(owners)
    with pytest.raises(ValueError, match="prime"):
        sharding.fill(slots=4_096)


def test_sharding_is_native(spark, plan_of):
    plan = plan_of(sharding.place(spark.range(9), "id"))
    assert "BroadcastHashJoin" in plan
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Exchange hashpartitioning"))
