import pytest

LONG = "word " * 30_000
DOC_SCHEMA = "text string, doc_id bigint, lang string, source string, n_chars bigint, score string, key string"


@pytest.fixture
def odd_docs(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, ties, clashing names."""
    line = "the same long line of words in many documents"
    rows = [
        (None, 1, "en", "s", 0),
        ("", 2, None, None, None),
        (" \t\n ", 3, "en", "s", 4),
        (LONG, 4, "en", "s", len(LONG)),
        (LONG, 4, "en", "s", len(LONG)),
        ("one two", 5, "de", "s", 7),
        ("one two", 6, "de", "s", 7),
        ("a text without id " * 3, None, "en", "s", 54),
        *((f"{line}\nunlike the others {n} {n * 7} {n * 13}", n, "fr", "s", 60) for n in range(10, 16)),
    ]
    return spark.createDataFrame([(t, i, a, b, c, "x", "y") for t, i, a, b, c in rows], DOC_SCHEMA)


@pytest.fixture
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture
def labels(spark):
    return spark.createDataFrame(
        [(n, n % 2, (n + 1) % 2) for n in range(1, 16)] + [(1, None, None), (None, 1, 1), (10, 1, 0)],
        "doc_id bigint, quality int, toxic int",
    )
