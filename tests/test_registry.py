import random
from collections import Counter

import pytest

from sparkmart.operators import insert_absent, list_keys, new_records, update_columns, validate
from sparkmart.operators.registry import with_reasons
from sparkmart.sources.documents import FLAGS

RECORD = "name string, domain string, description string, admin_emails array<string>"
GOOD = ("sales_1", "sales", "ten chars!", ["a.b+c@d-e.org"])


def record(**changes):
    values = dict(zip(("name", "domain", "description", "admin_emails"), GOOD))
    return tuple((values | changes).values())


@pytest.mark.parametrize(
    "changes, reasons",
    [
        ({}, []),
        ({"name": "Sales"}, ["name"]),
        ({"name": "sales\n"}, ["name"]),
        ({"name": ""}, ["name"]),
        ({"name": None}, ["name"]),
        ({"domain": "a-b"}, ["domain"]),
        ({"description": "x" * 9}, ["description"]),
        ({"description": "é" * 200}, []),
        ({"description": "x" * 201}, ["description"]),
        ({"description": None}, ["description"]),
        ({"admin_emails": []}, ["admin_emails_empty"]),
        ({"admin_emails": None}, ["admin_emails_empty", "admin_emails"]),
        ({"admin_emails": ["a@b.org", None]}, ["admin_emails"]),
        ({"admin_emails": ["a@b.org", "a@b"]}, ["admin_emails"]),
        ({"admin_emails": ["a@b.org\n"]}, ["admin_emails"]),
        ({"admin_emails": ["a@b.c"]}, ["admin_emails"]),
        ({"name": "A", "domain": None, "description": ""}, ["domain", "name", "description"]),
    ],
)
def test_validation(spark, changes, reasons):
    df = spark.createDataFrame([record(**changes)], RECORD)
    assert with_reasons(df).first().reasons == reasons
    valid, rejected = validate(df)
    assert valid.columns == df.columns
    assert (valid.count(), rejected.count()) == ((1, 0) if not reasons else (0, 1))


def test_new_records_have_false_flags(spark):
    df = spark.sql(f"SELECT 'a' AS name, true AS {FLAGS[0]}, cast(null AS boolean) AS {FLAGS[1]}")
    row = new_records(df).first()
    assert row[FLAGS[0]] is True
    assert [row[flag] for flag in FLAGS[1:]] == [False] * 5


def test_insert_absent_against_a_loop(spark):
    dealer = random.Random(3)
    base = [(f"k{i}",) for i in range(0, 30, 3)]
    keys = ["hot"] * 100 + [f"k{dealer.randrange(30)}" for _ in range(200)]
    dealer.shuffle(keys)
    batch = [(key, arrival, dealer.choice(["x", None])) for arrival, key in enumerate(keys)]
    taken, accepted, rejected = {key for (key,) in base}, [], []
    for row in batch:
        (rejected if row[0] in taken else accepted).append(row)
        taken.add(row[0])
    got = insert_absent(
        spark.createDataFrame(base, "name string"),
        spark.createDataFrame(batch, "name string, arrival int, note string").repartition(7),
        "name",
        ["arrival"],
    )
    assert Counter(tuple(r) for r in got[0].collect()) == Counter(accepted)
    assert Counter(tuple(r) for r in got[1].collect()) == Counter(rejected)
    assert got[0].columns == got[1].columns == ["name", "arrival", "note"]


@pytest.mark.parametrize("copies_per_task", [1, 7, 100_000])
def test_whole_copies_are_inserted_once(spark, copies_per_task):
    batch = [("a", 1, ["x"])] * 50 + [("a", 2, None)] * 20 + [("b", 1, [])] + [(None, 1, ["y"])] * 8
    new = spark.createDataFrame(batch, "name string, arrival int, tags array<string>")
    accepted, rejected = insert_absent(
        spark.createDataFrame([("c",)], "name string"), new, "name", ["arrival"], copies_per_task
    )

    def counted(df):
        return Counter((name, arrival, str(tags)) for name, arrival, tags in df.collect())

    assert counted(accepted) == {
        ("a", 1, "['x']"): 1,
        ("b", 1, "[]"): 1,
    }
    assert counted(rejected) == {
        ("a", 1, "['x']"): 49,
        ("a", 2, "None"): 20,
        (None, 1, "['y']"): 8,
    }


def test_rows_come_back_as_they_were(spark):
    """Maps, signed zeros, NULL arrivals and ties: nothing changes and nothing is lost."""
    new = spark.sql(
        """SELECT * FROM VALUES
        ('a', 1, map('k', 1), -0.0D), ('a', 1, map('k', 2), 0.0D), ('a', 2, NULL, -0.0D),
        ('b', NULL, map('k', 3), 1.0D), ('b', 0, map('k', 3), 1.0D),
        ('c', 1, map('k', 4), -0.0D), ('c', 1, map('k', 4), -0.0D), ('t', 1, map(), -0.0D),
        (NULL, 1, map('k', 5), -0.0D) AS t(name, arrival, tags, size)"""
    )
    base = spark.sql("SELECT * FROM VALUES ('t'), (NULL) AS t(name)")
    accepted, refused = insert_absent(base, new, "name", ["arrival"])

    def counted(*parts):
        return Counter(str(tuple(row)) for part in parts for row in part.collect())

    assert counted(accepted, refused) == counted(new)
    assert sorted(row["name"] for row in accepted.collect()) == ["a", "b", "c"]
    assert {row["name"]: row["arrival"] for row in accepted.collect()} == {"a": 1, "b": None, "c": 1}
    two = insert_absent(base, new, "name", ["arrival", "size"])
    assert counted(*two) == counted(new)


def test_insert_sorts_no_batch(spark, plan_of):
    """Only rows that arrive first with their key are compared as a whole."""
    batch = spark.range(1000).selectExpr("id % 7 AS name", "id AS arrival", "uuid() AS note")
    batch = batch.select("name", "arrival", batch.note.substr(1, 3).alias("note"))
    accepted, _ = insert_absent(batch.select("name").limit(0), batch, "name", ["arrival"])
    plan = plan_of(accepted, "simple")
    assert "HashAggregate(keys=[name" in plan.replace("#", " ").replace("name ", "name")


def test_insert_shrinks_hot_keys_before_the_shuffle(spark, plan_of):
    batch = spark.range(10).selectExpr("id % 2 AS name", "id AS arrival")
    accepted, _ = insert_absent(batch.select("name").limit(0), batch, "name", ["arrival"])
    plan = plan_of(accepted, "simple")
    assert "partial_min" in plan and "Window" not in plan


@pytest.fixture
def base(spark):
    return spark.createDataFrame(
        [("a", 1, "x"), ("b", 2, "y"), ("c", 3, None)], "name string, size int, note string"
    )


def test_update_named_columns_only(spark, base, rows):
    updates = spark.createDataFrame(
        [("a", 10, "new"), ("b", None, "gone"), ("z", 5, "?")], "name string, size int, note string"
    )
    updated, unknown = update_columns(base, updates, "name", ["size"])
    assert rows(updated) == rows(
        spark.createDataFrame([("a", 10, "x"), ("b", None, "y"), ("c", 3, None)], base.schema)
    )
    assert updated.dtypes == base.dtypes
    assert [tuple(r) for r in unknown.collect()] == [("z", 5, "?")]


def test_last_update_wins(spark, base):
    updates = spark.createDataFrame(
        [("a", 1, 50, "late"), ("a", 3, None, "last"), ("a", 2, 70, "mid"), (None, 9, 1, "n")],
        "name string, at int, size int, note string",
    )
    updated, unknown = update_columns(base, updates, "name", ["note", "size"], ["at"])
    row = updated.where("name = 'a'").first()
    assert (row["size"], row["note"]) == (None, "last")
    assert updated.count() == 3
    assert [r["at"] for r in unknown.collect()] == [9]


def test_order_column_may_be_updated_too(spark, base):
    updates = spark.createDataFrame([("a", 7), ("a", 5)], "name string, size int")
    updated, _ = update_columns(base, updates, "name", ["size"], ["size"])
    assert updated.where("name = 'a'").first()["size"] == 7


def test_few_updates_do_not_shuffle_the_base(spark, base, plan_of):
    updated, _ = update_columns(base, base, "name", ["size"])
    plan = plan_of(updated, "simple")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_all_null_update_still_overwrites(spark, base):
    updates = spark.createDataFrame([("a", None, None)], base.schema)
    updated, _ = update_columns(base, updates, "name", ["size", "note"])
    assert tuple(updated.where("name = 'a'").first()) == ("a", None, None)


def test_updates_that_name_their_own_columns(spark, base):
    updates = spark.createDataFrame(
        [
            ("a", 1, 50, "one", ["size"]),
            ("a", 2, 70, "two", ["note"]),
            ("a", 3, None, None, []),
            ("b", 1, None, "x", ["size", "note"]),
            ("b", 2, 8, None, ["note"]),
            ("c", 1, 9, "n", None),
            ("z", 1, 9, "n", ["size"]),
        ],
        "name string, at int, size int, note string, sets array<string>",
    )
    updated, unknown = update_columns(base, updates, "name", ["size", "note"], ["at"], "sets")
    assert sorted(tuple(row) for row in updated.collect()) == [
        ("a", 50, "two"),
        ("b", None, None),
        ("c", 3, None),
    ]
    assert [row["name"] for row in unknown.collect()] == ["z"]


def test_unknown_updates_take_no_job_of_the_base(spark, base, plan_of):
    _, unknown = update_columns(base, base, "name", ["size"])
    assert "LeftAnti" in plan_of(unknown, "simple")


def test_update_of_missing_column(base):
    with pytest.raises(ValueError, match="colour"):
        update_columns(base, base, "name", ["colour"])


def test_list_keys(base):
    assert sorted(r.name for r in list_keys(base).collect()) == ["a", "b", "c"]
