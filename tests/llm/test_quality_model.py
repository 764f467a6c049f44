"""The rules' language model sees characters as they stand, and all of them."""

import math
import random

import numpy as np
import pytest
from sparkmart.llm import quality_rules


@pytest.fixture
def docs(spark):
    dealer = random.Random(4)
    letters = ["abc de.", "абвг д", "中文字 本", "😀😁 🎉x", "AB12 \n", "\x00￿ z"]
    texts = ["".join(dealer.choice(dealer.choice(letters)) for _ in range(dealer.randrange(1, 300))) for _ in range(80)]
    rows = [(k, text, "en") for k, text in enumerate([*texts, "", None])]
    rows.append((3, "a copy of an id", None))
    return rows, spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(5)


def perplexities(frame):
    return sorted(((r["doc_id"], r["perplexity"]) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("head", [0, 40, 1 << 20])
def test_perplexity_of_all_characters(docs, monkeypatch, head):
    """Whatever part of the model is broadcast, as the model held whole."""
    monkeypatch.setattr(quality_rules, "HEAD", head)
    monkeypatch.setattr(quality_rules, "COUNTED", 50)
    rows, frame = docs
    texts = [text for _, text, _ in rows]
    grams, counts = np.unique(
        np.concatenate([numbers for numbers, _ in quality_rules._slices(texts)]), return_counts=True
    )
    model = quality_rules.NgramModel.estimate(grams, counts, quality_rules.UNITS)
    means = model.mean_log10(texts)
    expected = sorted(
        ((row[0], None if math.isnan(mean) else 10**-mean) for row, mean in zip(rows, means, strict=True)), key=repr
    )
    found = perplexities(quality_rules.apply_rules(frame))
    assert len(found) == len(expected)
    for (own, value), (other, wanted) in zip(found, expected, strict=True):
        assert own == other and value == (None if wanted is None else pytest.approx(wanted, rel=1e-6))


def test_other_scripts_capitals_and_digits_are_told_apart(spark):
    """Code points from 128 up, capitals and digits were folded to a few symbols, so each pair had one
    perplexity."""
    common = [(k, "привет мир ABC 123 " * 9, "ru") for k in range(20)]
    pairs = [("привет", "".join(chr(ord(c) + 4) for c in "привет")), ("ABC", "QXZ"), ("123", "907")]
    odd = [(100 + k, (text + " ") * 9, "ru") for k, text in enumerate(text for pair in pairs for text in pair)]
    frame = spark.createDataFrame(common + odd, "doc_id bigint, text string, lang string")
    found = dict(perplexities(quality_rules.apply_rules(frame)))
    for k in (100, 102, 104):
        assert found[k] != pytest.approx(found[k + 1], rel=1e-3)
