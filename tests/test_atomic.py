"""Publication in one step: readers never miss a relation, and failures leave the old one."""

import threading

import pytest
from pyspark.sql import functions as F

from sparkmart.plans import Product
from sparkmart.sources import tables
from sparkmart.sources.tables import full_refresh, published_version, remove_superseded


@pytest.fixture
def shop(spark, tmp_path, request):
    name = "a_" + "".join(c if c.isalnum() else "_" for c in request.node.name).lower()
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name} LOCATION '{tmp_path}/db'")
    return name, str(tmp_path / "files")


def layouts(spark):
    yield spark.range(3).select(F.col("id").alias("n"))
    yield spark.range(4).select(F.col("id").cast("string").alias("n"), F.lit(1).alias("more"))
    yield spark.range(5).select(F.lit("x").alias("other"))


def test_a_polling_reader_never_misses_the_table(spark, shop):
    schema, root = shop
    table = f"{schema}.numbers"
    full_refresh(next(layouts(spark)), table, root)
    allowed = {(("n",), 3), (("n", "more"), 4), (("other",), 5)}
    seen, wrong, stop = set(), [], threading.Event()

    def poll():
        session = spark.newSession()
        while not stop.is_set():
            try:
                df = session.table(table)
                seen.add((tuple(df.columns), df.count()))
            except Exception as error:
                wrong.append(error)

    reader = threading.Thread(target=poll)
    reader.start()
    try:
        for _ in range(4):
            for df in layouts(spark):
                full_refresh(df, table, root)
    finally:
        stop.set()
        reader.join()
    assert wrong == []
    assert seen <= allowed and len(seen) > 1


def test_a_failure_at_the_step_leaves_the_old_table(spark, shop, monkeypatch):
    schema, root = shop
    table = f"{schema}.numbers"
    full_refresh(spark.range(3), table, root)

    def fails(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(tables, "publish", fails)
    with pytest.raises(RuntimeError):
        full_refresh(spark.range(9).selectExpr("'x' as word"), table, root)
    assert spark.table(table).columns == ["id"] and spark.table(table).count() == 3


def test_comments_and_tags_follow_the_layout(spark, shop):
    schema, root = shop
    table = f"{schema}.numbers"
    for comment, tags in (("first", {"meta.a": "1"}), ("second", {"meta.b": "2", "description": "d'd"})):
        df = spark.range(2).withMetadata("id", {"comment": comment})
        full_refresh(df, table, root, tags)
        assert [c.description for c in spark.catalog.listColumns(table)] == [comment]
        assert tables.stored_tags(spark, table) == tags


def test_a_plain_table_gives_way(spark, shop):
    schema, root = shop
    table = f"{schema}.numbers"
    spark.range(9).write.format("parquet").saveAsTable(table)
    full_refresh(spark.range(3), table, root)
    assert spark.table(table).count() == 3


def test_superseded_versions_go(spark, shop):
    schema, root = shop
    table = f"{schema}.numbers"
    for size in (1, 2, 3):
        full_refresh(spark.range(size), table, root)
        full_refresh(spark.range(size), f"{schema}.numbers_two", root)
    assert len(remove_superseded(spark, table, root)) == 2
    assert remove_superseded(spark, table, root) == []
    assert spark.table(table).count() == 3 and spark.table(f"{schema}.numbers_two").count() == 3
    names = [t.name for t in spark.catalog.listTables(f"{schema}__versions")]
    assert len([n for n in names if n.startswith("numbers__")]) == 1


def chain(spark, schema, root, add, broken=False):
    product = Product(spark, schema, root=root)
    product.seed("numbers", lambda spark: spark.range(4).select((F.col("id") + add).alias("n")))
    product.model("kept", materialized="table", sql="select n from {numbers}")
    product.model("seen", sql=f"select n, {add} as added from {{kept}}")
    text = "select raise_error('broken') as total from {seen}" if broken else "select sum(n) as total from {seen}"
    product.model("last", materialized="table", sql=text)
    return product


def state(spark, schema):
    return (
        sorted(row[0] for row in spark.table(f"{schema}.numbers").collect()),
        sorted(tuple(row) for row in spark.table(f"{schema}.seen").collect()),
        spark.table(f"{schema}.last").first()[0],
    )


def test_a_failing_model_leaves_all_as_they_were(spark, shop):
    schema, root = shop
    product = chain(spark, schema, root, 0)
    product.build()
    before = state(spark, schema)
    with pytest.raises(Exception, match="broken"):
        chain(spark, schema, root, 10, broken=True).build()
    assert state(spark, schema) == before
    chain(spark, schema, root, 20).build()
    assert state(spark, schema)[2] == before[2] + 80


@pytest.mark.parametrize("at", [0, 1, 3])
def test_a_failing_pointer_puts_the_others_back(spark, shop, monkeypatch, at):
    schema, root = shop
    product = chain(spark, schema, root, 0)
    product.build()
    before, real, calls = state(spark, schema), tables.publish, []

    def fails_once(*arguments):
        calls.append(arguments)
        if len(calls) == at + 1:
            raise RuntimeError("lost")
        real(*arguments)

    monkeypatch.setattr(tables, "publish", fails_once)
    with pytest.raises(RuntimeError):
        chain(spark, schema, root, 10).build()
    monkeypatch.undo()
    assert state(spark, schema) == before
    assert product.recover() == []
    assert product.ref("kept").agg(F.sum("n")).first()[0] == 6


def test_a_lost_driver_is_made_good(spark, shop, monkeypatch):
    schema, root = shop
    chain(spark, schema, root, 0).build()
    real, calls = tables.publish, []

    class Lost(BaseException):
        pass

    def lost_after_two(*arguments):
        calls.append(arguments)
        if len(calls) > 2:
            raise Lost
        real(*arguments)

    monkeypatch.setattr(tables, "publish", lost_after_two)
    with pytest.raises(Lost):
        chain(spark, schema, root, 10).build()
    monkeypatch.undo()
    other = Product(spark.newSession(), schema, root=root)
    assert len(other.recover()) == 4
    assert state(spark, schema) == ([10, 11, 12, 13], [(n, 10) for n in range(10, 14)], 46)
    assert other.recover() == []


def test_first_build_that_fails_leaves_no_names(spark, shop, monkeypatch):
    schema, root = shop
    with pytest.raises(Exception, match="broken"):
        chain(spark, schema, root, 0, broken=True).build()
    assert spark.catalog.listTables(schema) == []


def test_version_of_a_relation(spark, shop):
    schema, root = shop
    assert published_version(spark, f"{schema}.nothing") is None
    full_refresh(spark.range(1), f"`spark_catalog`.`{schema}`.`numbers`", root)
    version = published_version(spark, f"{schema}.numbers")
    assert version.startswith(f"`spark_catalog`.`{schema}__versions`.`numbers__")
