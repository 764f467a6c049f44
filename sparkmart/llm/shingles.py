"""Word shingles, their sets and one-permutation signatures (numpy, inside tasks)."""

from __future__ import annotations

import numpy as np
import xxhash

WIDTH = 5
BANDS = 32
ROWS = 4
BINS = BANDS * ROWS

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


class WordHashes(dict):
    """64-bit hashes of words, kept up to a bound and then forgotten."""

    def __init__(self, most: int = 400_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_words = WordHashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_words.__getitem__, words), dtype=np.uint64, count=len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective mix, so that every bit of a hash depends on all bits."""
    values = values ^ (values >> np.uint64(30))
    values = values * _MIX[0]
    values ^= values >> np.uint64(27)
    values *= _MIX[1]
    return values ^ (values >> np.uint64(31))


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """One hash for each window of ``width`` neighbours."""
    count = len(hashes) - width + 1
    rolled = hashes[:count].copy()
    for step in range(1, width):
        rolled *= _FACTOR
        rolled += hashes[step : step + count]
    return mixed(rolled)


def shingle_set(text: bytes | None) -> np.ndarray:
    """Sorted distinct hashes of the five-word shingles of a lower-cased (A-Z) text.

    Fewer than five words make one shingle, no word makes none.
    """
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = word_hashes(words)
    return np.unique(windows(hashes, min(WIDTH, len(hashes))) + np.uint64(min(WIDTH, len(hashes))))


def _probes() -> np.ndarray:
    """For each bin the random order in which it looks for a filled bin to borrow from."""
    order = np.random.default_rng(20170).random((BINS, BINS)).argsort(axis=1)
    return order.astype(np.int64)


_PROBES = _probes()


def signature(shingles: np.ndarray) -> np.ndarray:
    """One permutation hashing: the smallest hash of each of BINS equal ranges; an empty bin
    takes the value of the first filled bin in its own fixed random order."""
    bins = ((shingles >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64)
    filled, first = np.unique(bins, return_index=True)
    out = np.zeros(BINS, np.uint64)
    out[filled] = shingles[first]
    if len(filled) < BINS:
        has = np.zeros(BINS, bool)
        has[filled] = True
        empty = np.flatnonzero(~has)
        probes = _PROBES[empty]
        out[empty] = out[probes[np.arange(len(empty)), has[probes].argmax(axis=1)]]
    return out


def band_keys(signed: np.ndarray) -> np.ndarray:
    """One bucket key per band, as int64: the low 16 bits of its ROWS minima side by side.

    The same numbers, seen as uint16, serve to estimate similarities.
    """
    return signed.astype(np.uint16).view(np.int64)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """How many values two sorted distinct arrays share."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return int((b[at] == a).sum())
