"""Periodic runs against every lag tried in turn."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sparkmart.llm import queries
from sparkmart.llm.periodic_runs import find_runs, periodic_runs, planted

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def runs_of(words, least=12):
    """(start, length, period) of all runs; of equal stretches the smallest period."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((start, length, q) for (start, length), q in found.items())


def sorted_runs(words):
    return sorted(runs_of(words), key=lambda run: (run[0], run[2]))


def expected(words):
    runs = sorted_runs(words)
    gone = {k for start, length, q in runs for k in range(start + q, start + length)}
    best = min(runs, key=lambda run: (-run[1], run[0], run[2]), default=None)
    listed = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
    kept = " ".join(word for k, word in enumerate(words) if k not in gone)
    return (
        len(runs),
        *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4),
        hashlib.sha256(listed.encode()).hexdigest(),
        hashlib.sha256(kept.encode()).hexdigest(),
    )


FIELDS = "n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()


def found_in(docs):
    lengths = np.array([len(doc) for doc in docs], np.int64)
    runs, dropped = find_runs(np.array([w for doc in docs for w in doc], np.int64), lengths)
    listed = [[tuple(run[1:]) for run in runs.tolist() if run[0] == k] for k in range(len(docs))]
    return listed, np.split(dropped, np.cumsum(lengths)[:-1])


blocks = st.lists(st.integers(0, 2), min_size=1, max_size=9)
repeated = st.tuples(blocks, st.integers(1, 9)).map(lambda x: x[0] * x[1])
documents = st.lists(st.one_of(repeated, st.lists(st.integers(0, 1), max_size=40)), max_size=8).map(
    lambda parts: [word for part in parts for word in part]
)


@settings(max_examples=300, deadline=None)
@given(st.lists(documents, min_size=1, max_size=5))
def test_runs_by_brute_force(docs):
    listed, dropped = found_in(docs)
    for doc, own, gone in zip(docs, listed, dropped, strict=True):
        assert own == sorted_runs(doc)
        cover = {k for start, length, q in own for k in range(start + q, start + length)}
        assert set(np.flatnonzero(gone).tolist()) == cover


def test_runs_within_runs_of_short_period():
    rng = random.Random(5)
    docs = []
    for _ in range(60):
        inner = [rng.randrange(2) for _ in range(rng.randrange(1, 4))]
        cut = [inner * rng.randrange(3, 14) for _ in range(3)]
        block = [w for part in cut for w in part[: rng.randrange(1, len(part) + 1)]]
        docs.append(block * rng.randrange(2, 4) + inner)
    listed, _ = found_in(docs)
    assert listed == [sorted_runs(doc) for doc in docs]


def test_a_long_text_of_one_word_has_few_seeds():
    listed, _ = found_in([[0] * 200_000, [0, 1, 2] * 50_000])
    assert listed == [[(0, 200_000, 1)], [(0, 150_000, 3)]]


def test_planted_words():
    ids, lengths = [None, *range(400)], np.array([7 + k % 30 for k in range(401)])
    places = planted(ids, lengths)
    begin = 0
    for doc_id, n in zip(ids, lengths.tolist(), strict=True):
        h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
        own = list(range(n))
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            own = [i if i < a else a + (i - a) % p for i in range(n)]
        assert (places[begin : begin + n] - begin).tolist() == own
        begin += n


def test_query_by_brute_force(spark, sf_dir):
    rows = {r["doc_id"]: r for r in queries.op13_periodic_runs(spark, sf_dir).collect()}
    texts = duckdb.sql(f"select doc_id, text from '{sf_dir}/documents.parquet'").fetchall()
    assert len(rows) == len(texts)
    for doc_id, text in texts:
        words = WORD.findall(text or "")
        if len(words) <= 1500:
            moved = planted([doc_id], np.array([len(words)])).tolist()
            words = [words[k] for k in moved]
            assert tuple(rows[doc_id][name] for name in FIELDS) == expected(words)
    assert sum(row["n_runs"] > 0 for row in rows.values()) >= 0.05 * len(rows)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = periodic_runs(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {row["doc_id"]: row for row in rows}
    empty = hashlib.sha256(b"").hexdigest()
    for doc_id in (1, 2, 3):
        row = by_id[doc_id]
        assert (row["n_runs"], row["start"], row["runs_sha256"]) == (0, None, empty)
        assert (row["collapsed_sha256"], row["n_words"]) == (empty, 0)
    assert [(r["start"], r["length"], r["period"]) for r in rows if r["doc_id"] == 4] == [(0, 30_000, 1)] * 2
    assert by_id[4]["collapsed_sha256"] == hashlib.sha256(b"word").hexdigest()
    assert by_id[None]["n_runs"] == 1
    assert by_id[5]["collapsed_sha256"] == by_id[6]["collapsed_sha256"]
    assert periodic_runs(no_docs).collect() == []


def test_words_part_at_ascii_spaces_only(spark):
    text = "a\x0bb\x1cc\x85d e　f \x00 g"
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    row = periodic_runs(docs).first()
    words = WORD.findall(text)
    assert row["n_words"] == len(words)
    assert row["collapsed_sha256"] == hashlib.sha256(" ".join(words).encode()).hexdigest()


def test_too_short_runs_are_refused():
    with pytest.raises(ValueError):
        find_runs(np.zeros(4, np.int64), np.array([4]), least=11)
