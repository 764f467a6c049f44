"""Quality rules: base counts, and n-gram perplexity bands per language.

The language model is over the characters as they stand: a text is its units of UTF-16, so any code point
is whole (one unit, or two beyond 16 bits), and a four-gram is a number of 64 bits.

1. Spark counts the four-grams of all whole texts, pre-aggregated per task.
2. Modified Kneser-Ney (Chen and Goodman): three discounts per order from counts of counts, lower
   orders from continuation counts, interpolated. Spark derives the orders from the counted four-grams,
   so no task holds all of them.
3. One pass scores all whole texts and takes the base counts. The most frequent four-grams, at most
   2**20, are broadcast as a sorted array of numbers beside one of losses. The others of a text are
   listed beside its row and joined with the rest of the model, so every character counts.
4. Per language, quartiles of log perplexity over all documents give a lower and an upper band;
   a document outside is rejected. Rare languages share one band.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm.common import map_arrow, stored
from sparkmart.llm.shingles import windows, word_hashes

ORDER = 4
UNIT_BITS = 16
UNITS = 1 << UNIT_BITS
# Four-grams that are broadcast, the most frequent ones; and those that a task counts at once.
HEAD = 1 << 20
COUNTED = 1 << 22
# Losses are multiples of this, so that their sums do not depend on the order of rows.
GRAIN = 2.0**-30
SPREAD = 5.0
MIN_WORDS = 20
MAX_REPEATED = 30
REPEAT_WIDTH = 8
LANGUAGE_DOCS = 100
MOST_LANGUAGES = 10_000
# Characters that are worked on together; a longer text is scored in pieces with context.
SLICE = 1_000_000

_CONTINUATION = bytes(range(0x80, 0xC0))
_SYMBOL_BYTES = b"#*$%&|<>"


# The text's edge: a high surrogate, which never stands before this or a text's first unit.
_EDGE = 0xD800


def symbols(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-16-le", "replace"), "<u2").astype(np.uint64)


def _slices(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(four-gram that ends there, owner) for every unit, in arrays of bounded size."""
    edge = np.full(ORDER - 1, _EDGE, np.uint64)
    held, owners, size = [], [], 0

    def grams() -> tuple[np.ndarray, np.ndarray]:
        line, owner = np.concatenate(held), np.concatenate(owners)
        count = len(line) - ORDER + 1
        number = np.zeros(count, np.uint64)
        for step in range(ORDER):
            number = (number << np.uint64(UNIT_BITS)) | line[step : step + count]
        real = owner[ORDER - 1 :] >= 0
        return number[real], owner[ORDER - 1 :][real]

    for place, text in enumerate(texts):
        line = symbols(text or "")
        before = edge
        for start in range(0, len(line), SLICE):
            part = line[start : start + SLICE]
            if size and size + len(part) > SLICE:
                yield grams()
                held, owners, size = [], [], 0
            held += [before, part]
            owners += [np.full(ORDER - 1, -1), np.full(len(part), place)]
            size += len(part)
            before = part[-(ORDER - 1) :] if len(part) >= ORDER - 1 else edge
    if held:
        yield grams()


def _characters(numbers: np.ndarray, owner: np.ndarray, count: int) -> np.ndarray:
    """Characters per owner: units that are not the second half of one."""
    return np.bincount(owner[numbers & np.uint64(0xFC00) != 0xDC00], minlength=count)


def _merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    grams = np.concatenate([np.zeros(0, np.uint64), *(part[0] for part in held)])
    times = np.concatenate([np.zeros(0, np.int64), *(part[1] for part in held)])
    order = np.argsort(grams, kind="stable")
    grams, times = grams[order], times[order]
    starts = np.flatnonzero(np.append(True, grams[1:] != grams[:-1])[: len(grams)])
    return grams[starts], np.add.reduceat(times, starts) if len(starts) else times


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def rows() -> pa.RecordBatch:
        grams, times = held[0]
        return pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(times)], ["gram", "n"])

    for batch in batches:
        for numbers, _ in _slices(batch.column("text").to_pylist()):
            held.append(np.unique(numbers, return_counts=True))
            size += len(held[-1][0])
            if size > COUNTED:
                held = [_merged(held)]
                size = len(held[0][0])
                if size > COUNTED // 2:
                    yield rows()
                    held, size = [], 0
    held = [_merged(held)]
    yield rows()


def _discounts_of(n: list[float]) -> np.ndarray:
    """What to take off a count of 0, 1, 2 and 3 or more, from how many are 1, 2, 3 and 4."""
    if min(n) == 0:
        return np.array([0.0, 0.5, 0.75, 0.9])
    y = n[0] / (n[0] + 2 * n[1])
    found = [k + 1 - (k + 2) * y * n[k + 1] / n[k] if k < 3 else 0 for k in range(3)]
    limits = [0.95, 1.95, 2.95]
    return np.array([0.0, *(min(max(d, 0.05), m) for d, m in zip(found, limits, strict=True))])


def _discounts(counts: np.ndarray) -> np.ndarray:
    return _discounts_of([float((counts == k).sum()) for k in range(1, 5)])


@dataclass
class NgramModel:
    """The model held whole, over an alphabet of ``size`` symbols; it also scores texts that it has not
    counted. By order n: sorted n-gram numbers with log10 probabilities, sorted contexts with log10
    backoff weights; ``base`` has the log10 probability of each symbol without context."""

    grams: dict[int, tuple[np.ndarray, np.ndarray]]
    contexts: dict[int, tuple[np.ndarray, np.ndarray]]
    base: np.ndarray

    @property
    def size(self) -> int:
        return len(self.base)

    @classmethod
    def estimate(cls, numbers: np.ndarray, counts: np.ndarray, size: int = 40) -> NgramModel:
        tables = {ORDER: (numbers.astype(np.uint64), counts.astype(np.float64))}
        for order in range(ORDER - 1, 0, -1):
            shorter, preceded = np.unique(tables[order + 1][0] % size**order, return_counts=True)
            tables[order] = (shorter, preceded.astype(np.float64))
        keys, values = tables[1]
        lower = np.full(size, 1.0 / size)
        if len(keys):
            off = _discounts(values)[np.minimum(values, 3).astype(int)]
            lower *= off.sum() / values.sum()
            lower[keys] += (values - off) / values.sum()
        base, grams, contexts = np.log10(lower), {}, {}
        below = (np.arange(size, dtype=np.uint64), lower)
        for order in range(2, ORDER + 1):
            keys, values = tables[order]
            off = _discounts(values)[np.minimum(values, 3).astype(int)]
            context, place = np.unique(keys // size, return_inverse=True)
            mass = np.bincount(place, values, len(context))
            left = np.bincount(place, off, len(context)) / np.where(mass > 0, mass, 1)
            shorter = below[1][np.searchsorted(below[0], keys % size ** (order - 1))]
            chance = (values - off) / mass[place] + left[place] * shorter
            grams[order] = (keys, np.log10(chance))
            contexts[order] = (context, np.log10(left))
            below = (keys, chance)
        return cls(grams, contexts, base)

    def log10(self, numbers: np.ndarray) -> np.ndarray:
        """log10 probability of the last symbol of each four-gram after the first three."""
        numbers = numbers.astype(np.uint64)
        out = np.zeros(len(numbers))
        open_at = np.arange(len(numbers))
        for order in range(ORDER, 1, -1):
            if not len(open_at):
                return out
            wanted = numbers[open_at] % self.size**order if order < ORDER else numbers
            keys, values = self.grams[order]
            spot = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
            hit = keys[spot] == wanted if len(keys) else np.zeros(len(wanted), bool)
            out[open_at[hit]] += values[spot[hit]]
            open_at, wanted = open_at[~hit], wanted[~hit] // self.size
            keys, values = self.contexts[order]
            if len(keys) and len(open_at):
                spot = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                out[open_at] += np.where(keys[spot] == wanted, values[spot], 0.0)
        out[open_at] += self.base[numbers[open_at] % self.size]
        return out

    def mean_log10(self, texts: list[str | None]) -> np.ndarray:
        """Per text the mean log10 probability of a character; nan without characters."""
        total, sizes = np.zeros(len(texts)), np.zeros(len(texts))
        for numbers, owner in _slices(texts):
            total += np.bincount(owner, self.log10(numbers), len(texts))
            sizes += _characters(numbers, owner, len(texts))
        return np.where(sizes > 0, total / np.maximum(sizes, 1), np.nan)


def train(docs: DataFrame) -> DataFrame:
    """(gram, n, level, loss) of all four-grams of all whole texts: how often they occur, the binary digits
    of that, and minus the log10 probability of the last unit after the first three."""
    counted = stored(
        map_arrow(docs.select("text"), _count, "gram bigint, n bigint")
        .groupBy("gram")
        .agg(F.sum("n").alias("n")),
        "grams",
    )
    tables = {ORDER: counted}
    for order in range(ORDER - 1, 0, -1):
        suffix = F.col("gram").bitwiseAND(F.lit((1 << UNIT_BITS * order) - 1))
        shorter = tables[order + 1].groupBy(suffix.alias("gram")).agg(F.count("*").alias("n"))
        tables[order] = stored(shorter, "grams") if order > 1 else shorter
    chance = None
    for order in range(1, ORDER + 1):
        own = tables[order]
        few = own.agg(*(F.coalesce(F.sum((F.col("n") == k).cast("double")), F.lit(0.0)) for k in range(1, 5)))
        discounts = [F.lit(float(d)) for d in _discounts_of(list(few.first()))]
        off = F.when(F.col("n") == 1, discounts[1]).when(F.col("n") == 2, discounts[2]).otherwise(discounts[3])
        context = Window.partitionBy(F.shiftrightunsigned("gram", UNIT_BITS))
        kinds = [F.col("n") == 1, F.col("n") == 2, F.col("n") > 2]
        taken = [F.sum(kind.cast("long")).over(context) * d for kind, d in zip(kinds, discounts[1:], strict=True)]
        weighed = own.select(
            "gram",
            "n",
            ((F.col("n") - off) / F.sum("n").over(context)).alias("_own"),
            ((taken[0] + taken[1] + taken[2]) / F.sum("n").over(context)).alias("_left"),
            F.col("gram").bitwiseAND(F.lit((1 << UNIT_BITS * (order - 1)) - 1)).alias("_suffix"),
        )
        if chance is None:
            shorter, joined = F.lit(1.0 / UNITS), weighed
        else:
            shorter, joined = F.col("_shorter"), weighed.join(chance, "_suffix")
        chance = joined.select(
            F.col("gram").alias("_suffix"), "n", (F.col("_own") + F.col("_left") * shorter).alias("_shorter")
        )
        if order < ORDER:
            chance = chance.drop("n")
    loss = F.rint(-F.log10("_shorter") / GRAIN) * GRAIN
    level = F.length(F.bin("n"))
    return stored(
        chance.select(F.col("_suffix").alias("gram"), "n", level.alias("level"), loss.alias("loss")), "model"
    )


def split(model: DataFrame) -> tuple[tuple[np.ndarray, np.ndarray], DataFrame | None]:
    """The most frequent grams, at most ``HEAD``, as arrays sorted by gram; and the rest, if any."""
    levels = sorted(map(tuple, model.groupBy("level").count().collect()), reverse=True)
    least, kept = 65, 0
    for level, count in levels:
        if kept + count > HEAD:
            break
        least, kept = level, kept + count
    found = model.where(F.col("level") >= least).select("gram", "loss").toArrow()
    grams = found["gram"].to_numpy().view(np.uint64)
    order = np.argsort(grams)
    rest = model.where(F.col("level") < least) if least > min(levels, default=(65,))[0] else None
    return (grams[order], found["loss"].to_numpy()[order]), rest


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    data = (text or "").encode("utf-8", "replace")
    words = data.split()
    lines = [line for line in data.split(b"\n") if line.split(None, 1)]
    repeated = 0
    if len(words) > REPEAT_WIDTH:
        _, place, times = np.unique(
            windows(word_hashes(words), REPEAT_WIDTH), return_inverse=True, return_counts=True
        )
        if len(times) < len(place):
            edges = np.zeros(len(words) + 1, np.int64)
            starts = np.flatnonzero(times[place] > 1)
            edges[starts] += 1
            edges[starts + REPEAT_WIDTH] -= 1
            repeated = int((np.cumsum(edges) > 0).sum())
    return (
        len(words),
        len(b"".join(words).translate(None, _CONTINUATION)),
        len(data) - len(data.translate(None, _SYMBOL_BYTES)),
        len(lines) - len(set(lines)),
        repeated,
    )


_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _losses(texts: list[str | None], grams: np.ndarray, losses: np.ndarray):
    """Per text the characters and the loss by known grams; and the other grams, as a list per text."""
    count = len(texts)
    total, sizes = np.zeros(count), np.zeros(count, np.int64)
    others, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for numbers, owner in _slices(texts):
        sizes += _characters(numbers, owner, count)
        if len(grams):
            spot = np.minimum(np.searchsorted(grams, numbers), len(grams) - 1)
            known = grams[spot] == numbers
            total += np.bincount(owner, np.where(known, losses[spot], 0.0), count)
            numbers, owner = numbers[~known], owner[~known]
        others.append(numbers)
        owners.append(owner)
    # Texts come in order, so the owners rise.
    ends = np.searchsorted(np.concatenate(owners), np.arange(count + 1))
    listed = pa.ListArray.from_arrays(
        pa.array(ends, pa.int32()), pa.array(np.concatenate(others).view(np.int64))
    )
    return sizes, total, listed


def _measure(grams: np.ndarray, losses: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            found = np.array([base_counts(text) for text in texts], np.int64).reshape(-1, 5)
            sizes, total, others = _losses(texts, grams, losses)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("lang"),
                    *(pa.array(found[:, place]) for place in range(5)),
                    pa.array(sizes),
                    pa.array(total),
                    others,
                ],
                ["doc_id", "lang", *_COUNTS, "size", "loss", "others"],
            )

    return run


def _band() -> list:
    quartiles = F.percentile_approx("log_perplexity", [0.25, 0.75], 10_000).alias("q")
    usual = F.percentile_approx("n_words", 0.5, 10_000).alias("usual")
    return [F.count("*").alias("n"), quartiles, usual]


def apply_rules(docs: DataFrame, spread: float = SPREAD) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    perplexity) for each row of ``docs(doc_id, text, lang)``.

    ``base_failed``: fewer than 20 words, or over 30 % of them in repeated eight-word windows.
    ``kept``: not failed, and log perplexity within ``spread`` interquartile ranges of its
    language's quartiles; a text shorter than its language's median gets a band wider by the root of
    the ratio, as its mean varies more. Quartiles are taken over documents that did not fail. A null language
    and languages of fewer than 100 documents (or beyond the 10,000 most frequent) share the band of
    all documents. Null and empty texts have no words, fail, and have a null perplexity.
    """
    source = docs.select("doc_id", "text", F.coalesce("lang", F.lit("")).alias("lang"))
    (grams, losses), rest = split(train(source))
    schema = (
        "doc_id bigint, lang string, n_words bigint, word_chars bigint, n_symbols bigint, "
        "n_dup_lines bigint, n_repeat_words bigint, size bigint, loss double, others array<bigint>"
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")
    )
    measured = stored(
        map_arrow(source, _measure(grams, losses), schema)
        .withColumn("base_failed", failed)
        .withColumn("row", F.monotonically_increasing_id()),
        "measured",
    )
    # The loss is over the characters of a text, none of which is left out; no characters, no perplexity.
    whole = F.col("loss")
    if rest is not None:
        more = (
            measured.select("row", F.explode("others").alias("gram"))
            .join(rest.select("gram", F.col("loss").alias("_loss")), "gram")
            .groupBy("row")
            .agg(F.sum("_loss").alias("_more"))
        )
        measured, whole = measured.join(more, "row", "left"), whole + F.coalesce("_more", F.lit(0.0))
    measured = measured.select(
        "doc_id",
        "lang",
        *_COUNTS,
        "base_failed",
        F.when(F.col("size") > 0, whole / F.col("size")).alias("log_perplexity"),
    )
    if rest is not None:
        measured = stored(measured, "scored")
    sound = measured.where("not base_failed")
    shared = sound.agg(*_band()).first()
    bands = (
        sound.groupBy("lang")
        .agg(*_band())
        .where((F.col("n") >= LANGUAGE_DOCS) & (F.col("lang") != ""))
        .orderBy(F.desc("n"), "lang")
        .limit(MOST_LANGUAGES)
        .select(F.col("lang").alias("band_lang"), F.col("q")[0].alias("q1"), F.col("q")[1].alias("q3"), "usual")
    )
    low, high = shared["q"] if shared["q"] else (0.0, 0.0)
    q1, q3 = F.coalesce("q1", F.lit(low)), F.coalesce("q3", F.lit(high))
    usual = F.coalesce("usual", F.lit(shared["usual"] or 1))
    width = spread * (q3 - q1) * F.sqrt(F.greatest(F.lit(1.0), usual / F.greatest("n_words", F.lit(1))))
    within = F.col("log_perplexity").between(q1 - width, q3 + width)
    return measured.join(
        F.broadcast(bands), F.col("lang") == F.col("band_lang"), "left"
    ).select(
        "doc_id",
        *_COUNTS,
        "base_failed",
        (~F.col("base_failed") & F.coalesce(within, F.lit(False))).alias("kept"),
        F.pow(F.lit(10.0), "log_perplexity").alias("perplexity"),
    )
