"""Vector codes by product quantization, the nearest entry found by slices and masks.

A vector is cut into equal parts, each with a codebook of its own. To find a point's nearest entry,
every dimension keeps the entries' coordinates sorted, and at each place a uint64 mask of the
entries before it. The distance to any one entry is an initial radius: the nearest entry lies within
it in every dimension. Per dimension two binary searches give a slice of the sorted coordinates,
its mask is the exclusive or of the two places' masks, and the masks of all dimensions, ANDed, leave
the entries within the box: candidates among which the nearest is found by exact distances.

Codebooks are fitted in rounds over all vectors. A task sums its points by entry, Spark adds up the
tasks' sums, and the driver gets a row per part, entry and place, so its share is a matter of
parameters. All numbers are integers, so results do not depend on the order of rows or tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import map_arrow, stored
from sparkmart.operators.lookups import lookup

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
MOST_ENTRIES = 64
#: Integer components must be below this, so that distances and sums are exact in 64 bits.
LIMIT = 1 << 28

_VECTORS = "vec_id bigint, label string, components binary"


def _integers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = batch.column("vector")
        offsets = vectors.offsets.to_numpy().astype(np.int64)
        numbers = pc.fill_null(vectors.values, np.nan).to_numpy(zero_copy_only=False)
        finite = np.isfinite(numbers)
        bad = np.concatenate(([0], np.cumsum(~finite)))
        sound = bad[offsets[1:]] == bad[offsets[:-1]]
        sound &= vectors.is_valid().to_numpy(zero_copy_only=False)
        scaled = np.floor(np.where(finite, numbers, 0.0) * SCALE)
        if (np.abs(scaled) >= LIMIT).any():
            raise ValueError(f"a component is {LIMIT // SCALE} or more, too large for exact sums")
        held = pa.Array.from_buffers(
            pa.binary(),
            len(vectors),
            [
                None,
                pa.py_buffer((offsets * 4).astype(np.int32).tobytes()),
                pa.py_buffer(scaled.astype("<i4").tobytes()),
            ],
        )
        rows = [batch.column("vec_id"), batch.column("label"), held]
        yield pa.RecordBatch.from_arrays(rows, ["vec_id", "label", "components"]).filter(
            pa.array(sound)
        )


class SlicedEntries:
    """The entries of one codebook, ready for search by slices and masks."""

    def __init__(self, entries: np.ndarray):
        if not 0 < len(entries) <= MOST_ENTRIES:
            raise ValueError(f"a codebook has 1 to {MOST_ENTRIES} entries")
        self.entries = entries
        self.order = np.argsort(entries, axis=0, kind="stable").T
        self.sorted = np.take_along_axis(entries, self.order.T, axis=0).T
        bits = np.left_shift(np.uint64(1), self.order.astype(np.uint64))
        none = np.zeros((len(bits), 1), np.uint64)
        self.masks = np.concatenate((none, np.bitwise_or.accumulate(bits, axis=1)), axis=1)
        spread = self.sorted[:, -1] - self.sorted[:, 0] if len(self.sorted) else np.zeros(0)
        self.widest = int(np.argmax(spread)) if len(spread) else None

    def _radius(self, points: np.ndarray) -> np.ndarray:
        """A whole number not below the distance to the nearest entry: that to the entry next to
        the point in the dimension in which the entries lie widest apart."""
        if self.widest is None:
            return np.zeros(len(points), np.int64)
        place = np.searchsorted(self.sorted[self.widest], points[:, self.widest])
        near = self.order[self.widest][np.minimum(place, len(self.entries) - 1)]
        apart = ((points - self.entries[near]) ** 2).sum(axis=1)
        return np.ceil(np.sqrt(apart)).astype(np.int64) + 1

    def candidates(self, points: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """For each point the mask of the entries within ``radius`` of it in every dimension."""
        held = np.full(len(points), ~np.uint64(0))
        for dimension, (coordinates, masks) in enumerate(zip(self.sorted, self.masks, strict=True)):
            own = points[:, dimension]
            low = np.searchsorted(coordinates, own - radius, side="left")
            high = np.searchsorted(coordinates, own + radius, side="right")
            held &= masks[low] ^ masks[high]
        return held

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance of each point's nearest entry, the lower one of equals."""
        held = self.candidates(points, self._radius(points))
        best = np.full(len(points), np.iinfo(np.int64).max)
        entry = np.zeros(len(points), np.int64)
        for number, coordinates in enumerate(self.entries):
            rows = np.flatnonzero((held >> np.uint64(number)) & np.uint64(1))
            apart = ((points[rows] - coordinates) ** 2).sum(axis=1)
            closer = apart < best[rows]
            best[rows[closer]] = apart[closer]
            entry[rows[closer]] = number
        return entry, best


def _points(components: pa.Array, codebooks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which rows have the codebooks' number of components, and those rows' parts."""
    parts, _, width = codebooks.shape
    fit = pc.equal(pc.binary_length(components), 4 * parts * width).to_numpy(zero_copy_only=False)
    joined = b"".join(components.filter(pa.array(fit)).to_pylist())
    points = np.frombuffer(joined, "<i4").astype(np.int64)
    return fit, points.reshape(int(fit.sum()), parts, width)


def _sums(vectors: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """Count and sum of the points of each entry, by place within the part."""
    parts, entries, width = codebooks.shape

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searched = [SlicedEntries(book) for book in codebooks]
        total = np.zeros((parts, entries, width), np.int64)
        count = np.zeros((parts, entries), np.int64)
        for batch in rows:
            _, points = _points(batch.column("components"), codebooks)
            for part, book in enumerate(searched):
                entry, _ = book.nearest(points[:, part])
                np.add.at(total[part], entry, points[:, part])
                count[part] += np.bincount(entry, minlength=entries)
        used = np.argwhere(np.repeat(count[:, :, None], width, axis=2))
        part, entry, place = used.T
        yield pa.RecordBatch.from_arrays(
            [pa.array(c) for c in (part, entry, place, count[part, entry], total[part, entry, place])],
            ["part", "entry", "place", "n", "total"],
        )

    schema = "part bigint, entry bigint, place bigint, n bigint, total bigint"
    return (
        map_arrow(vectors.select("components"), batches, schema)
        .groupBy("part", "entry", "place")
        .agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    )


def integer_vectors(df: DataFrame, vector: str = "embedding", label: str = "label") -> DataFrame:
    """``df(vec_id, vector, label)`` with whole components, floor(4096 * x), written to a table.

    Rows whose vector is null or holds a null or a component that is not finite are left out.
    """
    rows = df.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col(label).cast("string").alias("label"),
        F.col(vector).cast("array<double>").alias("vector"),
    )
    return stored(map_arrow(rows, _integers, _VECTORS), "vectors")


def fit_codebooks(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> np.ndarray:
    """Codebooks (part, entry, place), fitted on all rows of ``integer_vectors``.

    They start as the vectors with the smallest ids (a null id comes last, ties by content) and have as
    many entries as there are vectors, at most ``entries``. The number of components is that of the
    first vector that ``parts`` divides; without one the codebooks are empty.
    """
    whole = vectors.where(F.octet_length("components") % (4 * parts) == 0)
    by_id = [F.col("vec_id").asc_nulls_last(), "components"]
    first = whole.where(F.octet_length("components") > 0).orderBy(*by_id).first()
    if first is None:
        return np.zeros((parts, 0, 0), np.int64)
    size = len(first["components"])
    alike = whole.where(F.octet_length("components") == size)
    start = [row["components"] for row in alike.orderBy(*by_id).limit(entries).collect()]
    books = np.frombuffer(b"".join(bytes(row) for row in start), "<i4").astype(np.int64)
    codebooks = books.reshape(len(start), parts, -1).swapaxes(0, 1).copy()
    for _ in range(rounds):
        moved = codebooks.copy()
        for row in _sums(alike, codebooks).collect():
            moved[row["part"], row["entry"], row["place"]] = row["total"] // row["n"]
        if (moved == codebooks).all():
            break
        codebooks = moved
    return codebooks


def assign_codes(vectors: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error) of all rows of ``integer_vectors``, written to a table.

    A vector whose number of components is not the codebooks' has a null code and error.
    """
    hexes = np.array([f"{number:02x}" for number in range(MOST_ENTRIES)])

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searched = [SlicedEntries(book) for book in codebooks if len(book)]
        for batch in rows:
            fit, points = _points(batch.column("components"), codebooks)
            fit &= bool(searched)
            code = np.full(len(fit), None, object)
            error = np.zeros(len(fit), np.int64)
            if fit.any():
                found = [book.nearest(points[:, part]) for part, book in enumerate(searched)]
                code[fit] = ["".join(row) for row in hexes[np.stack([f[0] for f in found], axis=1)]]
                error[fit] = sum(f[1] for f in found)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    batch.column("label"),
                    pa.array(code, pa.string()),
                    pa.array(error, pa.int64(), mask=~fit),
                ],
                ["vec_id", "label", "code", "error"],
            )

    schema = "vec_id bigint, label string, code string, error bigint"
    return stored(map_arrow(vectors, batches, schema), "codes")


def digest(codebooks: np.ndarray) -> str:
    """sha256 of all components as decimal text, by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def vector_codes(
    df: DataFrame,
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """A row per sound vector: vec_id, code (two hex digits a part), error (the squared distances
    of its parts), label_error (the sum of errors of its label; null labels are one) and the digest
    of the codebooks.

    Vectors that are null or hold nulls, NaN or infinities are left out. Vectors of another length
    than the first, or of a length that ``parts`` does not divide, have no code: null code and
    error. Equal entries go by the lower number; repeated rows give a row each and count each; an
    empty table gives no rows; other columns are ignored. Components of 2**16 or more raise.
    """
    vectors = integer_vectors(df, vector, label)
    codebooks = fit_codebooks(vectors, parts, entries, rounds)
    coded = assign_codes(vectors, codebooks).select(
        "*",
        F.coalesce("label", F.lit("")).alias("label_text"),
        F.col("label").isNull().alias("label_missing"),
    )
    key = {"label_text": "label_text", "label_missing": "label_missing"}
    sums = coded.groupBy(*key).agg(F.sum("error").alias("summed"))
    return lookup(coded, sums, key, {"label_error": "summed"}).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(codebooks)).alias("codebooks_sha256")
    )
