"""Lookups by broadcast and by spread shuffle give the same rows as a plain loop."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sparkmart.operators import DuplicateKeyError, lookup
from sparkmart.operators import lookups

SPREAD = {"broadcast_bytes": 0, "rows_per_task": 50}


def brute_force(fact, dimension, fold=lambda key: key):
    out = Counter()
    for number, key in fact:
        hits = [v for k, v in dimension if None not in (k, key) and fold(k) == fold(key)]
        for value in hits or [None]:
            out[(number, key, value)] += 1
    return out


@pytest.fixture(scope="module")
def tables(spark):
    dealer = random.Random(7)
    # A third of the rows on one key, a sixth on NULL, and copies of whole rows.
    keys = ["hot"] * 400 + [None] * 200 + [f"k{dealer.randrange(40)}" for _ in range(600)]
    fact = [(dealer.randrange(500), key) for key in keys] + [(1, "hot")] * 100
    dimension = [(f"k{i}", f"v{i}") for i in range(25)] + [
        ("hot", "h1"),
        ("hot", "h2"),
        (None, "never"),
        ("K1", "upper"),
    ]
    return (
        fact,
        dimension,
        spark.createDataFrame(fact, "number int, code string").repartition(5),
        spark.createDataFrame(dimension, "key string, value string"),
    )


@pytest.mark.parametrize(
    "options",
    [{}, SPREAD, {"broadcast_bytes": 0}, {"broadcast_bytes": 0, "rows_per_task": None}],
)
def test_lookup_matches_brute_force(tables, options):
    fact, dimension, fact_df, dimension_df = tables
    joined = lookup(fact_df, dimension_df, {"code": "key"}, {"found": "value"}, **options)
    assert joined.columns == ["number", "code", "found"]
    got = Counter(tuple(row) for row in joined.collect())
    assert got == brute_force(fact, dimension)


@pytest.mark.parametrize("options", [{}, SPREAD])
def test_normalised_keys(tables, options):
    fact, dimension, fact_df, dimension_df = tables
    joined = lookup(
        fact_df, dimension_df, {"code": "key"}, {"found": "value"}, normalise=F.upper, **options
    )
    got = Counter(tuple(row) for row in joined.collect())
    assert got == brute_force(fact, dimension, str.upper)


@pytest.mark.parametrize("options", [{}, SPREAD])
def test_two_key_columns(spark, options):
    fact = spark.createDataFrame(
        [(1, "a")] * 90 + [(2, "a"), (1, None), (None, None)], "x int, y string"
    )
    dimension = spark.createDataFrame(
        [(1, "a", "hit"), (2, "b", "miss"), (1, None, "null")], "p int, q string, value string"
    )
    joined = lookup(fact, dimension, {"x": "p", "y": "q"}, {"value": "value"}, **options)
    got = Counter(tuple(row) for row in joined.collect())
    assert got == {
        (1, "a", "hit"): 90,
        (2, "a", None): 1,
        (1, None, None): 1,
        (None, None, None): 1,
    }


def test_small_dimension_is_broadcast_and_fact_stays_put(tables, plan_of):
    _, _, fact_df, dimension_df = tables
    plan = plan_of(lookup(fact_df, dimension_df, {"code": "key"}, {"found": "value"}))
    assert "BroadcastHashJoin" in plan
    assert "hashpartitioning" not in plan


def test_large_dimension_is_not_broadcast(spark, plan_of):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = spark.range(1000).select((F.col("id") % 3).alias("code"))
        dimension = spark.range(3).select(F.col("id").alias("key"), F.col("id").alias("value"))
        joined = lookup(fact, dimension, {"code": "key"}, {"found": "value"}, **SPREAD)
        plan = plan_of(joined)
        assert "SortMergeJoin" in plan
        assert joined.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_rows_are_spread_over_slots(tables):
    _, _, fact_df, _ = tables
    hot = {row._key_hash: row._slots for row in lookups._hot_keys(fact_df, ["code"], 50).collect()}
    hashed = fact_df.select("code", F.xxhash64("code").alias("h")).distinct()
    hashes = {row.code: row.h for row in hashed.collect()}
    assert hot[hashes["hot"]] == 10
    assert hot[hashes[None]] == 4
    assert len(hot) == 2


@pytest.mark.parametrize("options", [{}, SPREAD])
def test_column_names_with_dots(spark, options):
    fact = spark.createDataFrame([("a", 1)] * 60, "`the.key` string, n int")
    dimension = spark.createDataFrame([("a", 2)], "`its.key` string, `its.value` int")
    joined = lookup(fact, dimension, {"the.key": "its.key"}, {"new.value": "its.value"}, **options)
    assert joined.columns == ["the.key", "n", "new.value"]
    assert [tuple(row) for row in joined.distinct().collect()] == [("a", 1, 2)]


def test_unique(spark):
    fact = spark.createDataFrame([(1,)], "id int")
    doubled = spark.createDataFrame([(1, "a"), (1, "b")], "key int, value string")
    nulls = spark.createDataFrame([(None, "a"), (None, "b"), (1, "c")], "key int, value string")
    with pytest.raises(DuplicateKeyError, match="1"):
        lookup(fact, doubled, {"id": "key"}, {"value": "value"}, unique=True)
    found = lookup(fact, nulls, {"id": "key"}, {"value": "value"}, unique=True)
    assert [tuple(row) for row in found.collect()] == [(1, "c")]


def test_measured_size_covers_nested_and_text_columns(spark):
    wide = spark.createDataFrame([("x" * 1000, ["y" * 1000])], "a string, b array<string>")
    assert lookups._measure(wide, ["a"], False) > 2000
    assert lookups._measure(wide.where("false"), ["a"], False) == 0


@pytest.mark.parametrize("most", [1, 2, 3])
def test_too_many_hot_keys_split_the_largest(tables, most):
    fact, dimension, fact_df, dimension_df = tables
    left = fact_df.withColumn("_key_0", F.col("code"))
    right = dimension_df.select(F.col("key").alias("_key_0"), F.col("value").alias("found"))
    joined = lookups._spread_join(left, right, ["_key_0"], 50, most)
    got = Counter(tuple(row) for row in joined.select("number", "code", "found").collect())
    assert got == brute_force(fact, dimension)
