"""The stored registry: changes rewrite the buckets they touch, in one step, or not at all."""

import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.operators import ConflictError, RegistryStore
from sparkmart.operators import registry_store
from sparkmart.sources import read_documents, write_documents

SCHEMA = (
    T.StructType()
    .add("name", T.StringType())
    .add("size", T.IntegerType())
    .add("tags", T.MapType(T.StringType(), T.IntegerType()))
    .add("note", T.StringType())
)
ARRIVING = "name string, at int, size int, note string"


@pytest.fixture
def store(spark, tmp_path):
    return RegistryStore.create(spark, str(tmp_path / "registry"), SCHEMA, "name", buckets=8)


def rows(spark, data):
    return spark.createDataFrame(data, ARRIVING)


def state(store):
    return {row["name"]: (row["size"], row["note"]) for row in store.read().collect()}


def test_changes_against_a_loop(spark, store):
    dealer, expected, at = random.Random(4), {}, 0
    for _ in range(4):
        inserts = [(f"k{dealer.randrange(40)}", at + n, dealer.randrange(9), "in") for n in range(20)]
        updates = [(f"k{dealer.randrange(60)}", at + n, None, f"u{n}") for n in range(10)]
        at += 20
        refused, unknown = store.merge(
            rows(spark, inserts), ["at"], rows(spark, updates), ["note", "size"], ["at"]
        )
        turned_away = []
        for name, place, size, note in inserts:
            if name in expected:
                turned_away.append((name, place))
            else:
                expected[name] = (size, note)
        lost = [(name, place) for name, place, *_ in updates if name not in expected]
        for name, _, size, note in updates:
            if name in expected:
                expected[name] = (size, note)
        assert state(store) == expected
        assert sorted((r["name"], r["at"]) for r in refused.collect()) == sorted(turned_away)
        assert sorted((r["name"], r["at"]) for r in unknown.collect()) == sorted(lost)
    assert store.read().schema == SCHEMA and store.read().count() == len(expected)


def test_untouched_buckets_keep_their_files(spark, store):
    store.merge(rows(spark, [(f"k{n}", 1, n, None) for n in range(100)]), ["at"])
    before, files = store.manifest(), set(store.read().inputFiles())
    assert len(before.changes) == 8
    store.merge(updates=rows(spark, [("k5", 1, -1, "new")]), columns=["size"])
    after = store.manifest()
    changed = {b for b in after.changes if after.changes[b] != before.changes[b]}
    assert len(changed) == 1 and after.number == before.number + 1
    assert len(files & set(store.read().inputFiles())) == 7
    assert state(store)["k5"] == (-1, None)


def test_readers_under_way_keep_their_rows(spark, store):
    store.merge(rows(spark, [("a", 1, 1, "x")]), ["at"])
    seen = store.read()
    store.merge(updates=rows(spark, [("a", 1, 2, "y")]), columns=["size", "note"])
    assert [tuple(r)[1] for r in seen.collect()] == [1]
    assert state(store) == {"a": (2, "y")}


def test_a_failed_change_leaves_all_as_it_was(spark, store, monkeypatch):
    store.merge(rows(spark, [("a", 1, 1, "x")]), ["at"])
    broken = rows(spark, [("b", 1, 1, "x")]).withColumn("note", F.expr("raise_error('no')"))
    with pytest.raises(Exception, match="no"):
        store.merge(broken, ["at"])
    monkeypatch.setattr(registry_store._Files, "put", lambda *_: False)
    with pytest.raises(ConflictError):
        store.merge(rows(spark, [("b", 1, 1, "x")]), ["at"])
    monkeypatch.undo()
    assert state(store) == {"a": (1, "x")}
    assert store.merge(rows(spark, [("b", 1, 1, "x")]), ["at"])[0].count() == 0
    assert set(state(store)) == {"a", "b"}


def test_the_second_of_two_changes_is_refused(spark, store):
    other = RegistryStore(spark, store.path)
    old = other.manifest()
    store.merge(rows(spark, [("a", 1, 1, "x")]), ["at"])
    other.manifest = lambda: old
    with pytest.raises(ConflictError):
        other.merge(rows(spark, [("b", 1, 1, "x")]), ["at"])
    assert set(state(store)) == {"a"}


def test_odd_rows(spark, store):
    assert store.read().count() == 0 and store.read().schema == SCHEMA
    refused, _ = store.merge(rows(spark, [(None, 1, 1, "n"), ("", 1, 2, None), ("", 1, 2, None)]), ["at"])
    assert refused.count() == 2 and state(store) == {"": (2, None)}
    number = store.manifest().number
    refused, unknown = store.merge(rows(spark, [(None, 1, 1, "n")]), ["at"], rows(spark, []), ["size"], ["at"])
    assert (refused.count(), unknown.count(), store.manifest().number) == (1, 0, number)
    with pytest.raises(ValueError):
        RegistryStore.create(spark, store.path + "2", SCHEMA, "nothing")
    with pytest.raises(ConflictError):
        RegistryStore.create(spark, store.path, SCHEMA, "name")
    with pytest.raises(LookupError):
        RegistryStore(spark, store.path + "3").read()


def test_keys_are_read_from_their_buckets(spark, store):
    store.merge(rows(spark, [(f"k{n}", 1, n, None) for n in range(50)]), ["at"])
    found = store.read_keys(["k3", "k3", "nobody", None])
    assert [row["size"] for row in found.collect()] == [3]
    assert len(found.inputFiles()) <= 2


def test_superseded_changes_are_removed(spark, store):
    for size in range(3):
        store.merge(rows(spark, [("a", 1, size, "x")]), ["at"])
        store.merge(updates=rows(spark, [("a", 1, size, "x")]), columns=["size"])
    # Six changes; the last holds the only bucket.
    assert len(store.remove_superseded()) == 5
    assert store.remove_superseded() == [] and state(store) == {"a": (2, "x")}
    assert len([n for n in os.listdir(f"{store.path}/manifests") if n.endswith(".json")]) == 1


def test_documents_in_and_out(spark, store, tmp_path):
    schema = T.StructType.fromDDL("name string, size int, note string")
    write_documents(spark.createDataFrame([("a", 1, "x"), ("b", 2, None)], schema), str(tmp_path / "in"))
    store.merge(read_documents(spark, str(tmp_path / "in"), schema), ["name"])
    write_documents(store.read(), str(tmp_path / "out"))
    back = read_documents(spark, str(tmp_path / "out"), SCHEMA)
    assert {r["name"]: (r["size"], r["note"]) for r in back.collect()} == {"a": (1, "x"), "b": (2, None)}


def test_no_change_sorts_its_batch(spark, sf_dir, plan_of):
    from sparkmart import workload

    for name in ("registry_insert_absent", "registry_update"):
        result = workload.queries()[name](spark, sf_dir)
        result.collect()
        assert "SortAggregate" not in plan_of(result, "simple")
