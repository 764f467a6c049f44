"""Vector codes: exact search by masks, codebooks and odd rows by brute force."""

import numpy as np
import pytest
from sparkmart.llm.vector_codes import SlicedEntries, digest, fit_codebooks, integer_vectors, vector_codes

SCHEMA = "vec_id bigint, embedding array<float>, label int, code string, part int, entry int, n int"


def brute(points, entries):
    apart = ((points[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
    return apart.argmin(axis=1), apart.min(axis=1)


@pytest.mark.parametrize("entries", [1, 2, 16, 64])
def test_search_equals_trying_all(entries):
    rng = np.random.default_rng(entries)
    for scale in (2, 50, 4096, 1 << 27):
        books = rng.integers(-scale, scale, (entries, 8))
        points = np.concatenate((rng.integers(-scale, scale, (500, 8)), books, books + 1))
        searched = SlicedEntries(books)
        found, apart = searched.nearest(points)
        expected, least = brute(points, books)
        assert (found == expected).all() and (apart == least).all()


def test_masks_hold_just_the_box():
    books = np.array([[0, 0], [3, 0], [0, 3], [9, 9]])
    held = SlicedEntries(books).candidates(np.array([[0, 0], [9, 9]]), np.array([3, 0]))
    assert held.tolist() == [0b0111, 0b1000]


def test_equal_entries_go_by_the_lower_number():
    found, _ = SlicedEntries(np.array([[5], [1], [1], [5]])).nearest(np.array([[1], [3], [5]]))
    assert found.tolist() == [1, 0, 0]


def by_hand(vectors, parts, entries, rounds):
    """(codes, errors, codebooks) of integer vectors in order of their ids."""
    points = np.array(vectors).reshape(len(vectors), parts, -1)
    books = points[:entries].swapaxes(0, 1).copy()
    for turn in range(rounds + 1):
        near = [brute(points[:, part], books[part]) for part in range(parts)]
        if turn == rounds:
            break
        for part, (entry, _) in enumerate(near):
            for number in set(entry.tolist()):
                own = points[entry == number, part]
                books[part, number] = [sum(c) // len(own) for c in own.T.tolist()]
    codes = ["".join(f"{e:02x}" for e in row) for row in np.stack([n[0] for n in near], 1).tolist()]
    return codes, sum(n[1] for n in near).tolist(), books


def test_codes_by_brute_force(spark):
    rng = np.random.default_rng(3)
    values = rng.normal(size=(300, 16)).astype(np.float32)
    values[50:200] = values[50]
    rows = [(n, values[n].tolist(), n % 3 if n % 4 else None, "x", 0, 0, 0) for n in range(300)]
    found = vector_codes(spark.createDataFrame(rows, SCHEMA).repartition(7)).orderBy("vec_id").collect()
    whole = np.floor(values.astype(np.float64) * 4096).astype(np.int64)
    codes, errors, books = by_hand(whole, 8, 16, 6)
    assert [row["code"] for row in found] == codes
    assert [row["error"] for row in found] == errors
    assert {row["codebooks_sha256"] for row in found} == {digest(books)}
    sums = {}
    for row, error in zip(rows, errors):
        sums[row[2]] = sums.get(row[2], 0) + error
    assert [row["label_error"] for row in found] == [sums[row[2]] for row in rows]


def test_odd_rows(spark):
    sound, other = [0.5, -0.25] * 4, [0.1] * 8
    rows = [
        (1, None, 1),
        (2, [], 1),
        (3, [0.0] * 7 + [None], 1),
        (4, [0.0] * 7 + [float("nan")], 1),
        (5, [0.0] * 7 + [float("-inf")], 1),
        (6, sound, None),
        (6, sound, None),
        (7, other, 2),
        (8, [1.0] * 16, 2),
        (9, [1.0] * 3, 2),
        (None, sound, 2),
    ]
    df = spark.createDataFrame([(*row, "x", 0, 0, 0) for row in rows], SCHEMA)
    found = sorted(vector_codes(df, entries=2).collect(), key=lambda r: (r["vec_id"] is None, r["vec_id"]))
    assert [row["vec_id"] for row in found] == [2, 6, 6, 7, 8, 9, None]
    by_id = {row["vec_id"]: row for row in found}
    assert all(by_id[n]["code"] is None and by_id[n]["error"] is None for n in (2, 8, 9))
    # Two equal entries: all go to the first, which moves off; the second stays and is nearer then.
    assert by_id[6]["code"] == "01" * 8 == by_id[None]["code"] and by_id[7]["code"] == "00" * 8
    assert by_id[6]["label_error"] == 2 * by_id[6]["error"]
    assert by_id[7]["label_error"] == by_id[7]["error"] + by_id[None]["error"]
    assert vector_codes(df.limit(0)).collect() == []
    with pytest.raises(Exception, match="too large"):
        vector_codes(spark.createDataFrame([(1, [1e30] * 8, 1, "x", 0, 0, 0)], SCHEMA)).collect()


def test_codebooks_have_as_many_entries_as_vectors(spark):
    rows = [(n, [float(n)] * 8, 0, "x", 0, 0, 0) for n in range(5)]
    vectors = integer_vectors(spark.createDataFrame(rows, SCHEMA))
    assert fit_codebooks(vectors).shape == (8, 5, 1)
    assert fit_codebooks(vectors, parts=4, entries=3, rounds=1).shape == (4, 3, 2)
