"""Governed SQL by the resolved plan: what may be read, and what is refused without effect."""

import pytest
from pyspark.sql import functions as F

from sparkmart.operators import ColumnMask, Identity, RowFilter, TableName
from sparkmart.plans import Product
from sparkmart.sources.tables import SourceTable

ANALYST = Identity("analyst")


@pytest.fixture(scope="module")
def product(spark):
    product = Product(spark, "governed_shop")
    product.seed("cust", spark.range(10).select(F.col("id").alias("n"), F.lit("secret").alias("word")))
    product.model("secret_view", sql="select word, n from {cust}")
    product.model("secret_table", materialized="table", sql="select word, n from {cust}")
    product.build()
    table = TableName("spark_catalog", "governed_shop", "cust")
    product.policies += [RowFilter(table, "n < 3"), ColumnMask(table, "word", "'***'")]
    spark.range(7).createOrReplaceTempView("governed_elsewhere")
    return product


REFUSED = [
    # Reads that do not name the relation in braces.
    "select count(*) from identifier('governed_shop.cust')",
    "select count(*) from identifier('governed_shop' || '.cust')",
    "select count(*) from identifier(lower('GOVERNED_SHOP.CUST')) where n in (select n from {cust})",
    "select * from {cust} where exists (select 1 from identifier('governed_shop.cust') c where c.n = 9)",
    "select (select max(n) from identifier('governed_shop.cust')) from {cust}",
    "with c as (select * from identifier('governed_shop.cust')) select * from c",
    "select * from {cust} cross join lateral (select max(n) as m from governed_shop.cust)",
    "table governed_shop.cust",
    "from governed_shop.cust |> select n",
    "select * from governed_shop.secret_view",
    "select * from governed_shop.secret_table",
    "select * from governed_elsewhere",
    "select * from {cust} union all select * from spark_catalog.governed_shop.cust",
    "select * from parquet.`/tmp`",
    "select * from identifier('parquet.`/tmp`')",
    # Statements that are not queries.
    "execute immediate 'select count(*) from governed_shop.cust'",
    "begin select 1; end",
    "create table governed_shop.copied using parquet as select * from identifier('governed_shop.cust')",
    "create table governed_shop.copied using parquet as select * from {cust}",
    "create or replace view governed_shop.cust as select 1 as n",
    "create temporary view stolen as select * from governed_shop.cust",
    "describe table extended governed_shop.cust",
    "describe query select * from {cust}",
    "show tables in governed_shop",
    "show create table governed_shop.cust",
    "explain extended select * from {cust}",
    "drop table governed_shop.cust",
    "drop view governed_shop.cust",
    "drop schema governed_shop cascade",
    "alter table governed_shop.cust set tblproperties ('a' = 'b')",
    "insert into governed_shop.cust select * from {cust}",
    "insert overwrite governed_shop.cust select * from {cust}",
    "from {cust} insert into governed_shop.cust select n, word",
    "delete from governed_shop.cust",
    "update governed_shop.cust set n = 0",
    "merge into governed_shop.cust c using {cust} d on c.n = d.n when matched then delete",
    "truncate table governed_shop.cust",
    "cache table governed_shop.cust",
    "refresh table governed_shop.cust",
    "set spark.sql.ansi.enabled = false",
    "declare variable x int default 1",
    "use governed_shop",
    "create function f() returns int return select max(n) from governed_shop.cust",
    "analyze table governed_shop.cust compute statistics",
    # Programs.
    "select transform(n) using 'cat' as (x) from {cust}",
    "select reflect('java.lang.System', 'getProperty', 'user.dir')",
    "select n from {cust} where java_method('java.util.UUID', 'randomUUID') is not null",
    "select try_reflect('java.lang.System', 'getProperty', 'user.dir')",
]


def test_refused_without_effect(spark, product):
    before = sorted(t.name for t in spark.catalog.listTables("governed_shop"))
    for text in REFUSED:
        with pytest.raises(PermissionError):
            product.sql(text, ANALYST)
            pytest.fail(text)
    for identity in (None, Identity("admin")):
        with pytest.raises(PermissionError):
            product.sql("drop table governed_shop.cust", identity)
    assert sorted(t.name for t in spark.catalog.listTables("governed_shop")) == before
    assert spark.catalog.currentDatabase() == "default"
    assert spark.table("governed_shop.cust").count() == 10


def test_plain_names_reach_no_table_of_the_current_schema(spark, product):
    spark.sql("use governed_shop")
    try:
        for text in ("select * from cust", "with c as (select * from cust) select * from c"):
            with pytest.raises(PermissionError, match="braces"):
                product.sql(text, ANALYST)
    finally:
        spark.sql("use default")


ALLOWED = [
    ("select count(*) from {cust}", [(3,)]),
    ("select distinct word from {cust}", [("***",)]),
    ("with cust as (select * from {cust}) select max(n) from cust", [(2,)]),
    ("with a as (select n from {cust}), b as (select n + 1 as n from a) select sum(n) from b join a using (n)", [(3,)]),
    ("select count(*) from {cust} c where exists (select 1 from {cust} d where d.n = c.n + 1)", [(2,)]),
    ("select (select max(n) from {cust}) as m, count(*) from range(5)", [(2, 5)]),
    ("select x from values (1), (2) as v(x) where x in (select n from {cust})", [(1,), (2,)]),
    ("select count(*) from {cust} a, lateral (select a.n * 2 as m) where m > 0", [(2,)]),
    ("select '{{}}' as braces, 'drop table x' as text", [("{}", "drop table x")]),
    ("from {cust} |> where n > 0 |> aggregate count(*)", [(2,)]),
    ("select n, posexplode(array(1)) from {cust} order by n limit 1", [(0, 0, 1)]),
    ("with recursive r(k) as (select 1 union all select k + 1 from r where k < 3) select max(k) from r", [(3,)]),
]


@pytest.mark.parametrize("text, expected", ALLOWED)
def test_allowed(product, rows, text, expected):
    assert rows(product.sql(text, ANALYST)) == expected


def test_exempt_users_see_all(product):
    assert product.sql("select count(*) from {cust}", Identity("admin")).first()[0] == 10


def test_functions_over_tables_are_leaves_too(spark, product):
    spark.sql("create or replace temporary function peek() returns bigint return (select max(n) from governed_shop.cust)")
    try:
        with pytest.raises(PermissionError):
            product.sql("select peek() from {cust}", ANALYST)
    finally:
        spark.sql("drop temporary function peek")


def test_sources_and_missing_tables(spark, product):
    product.declare_source("again", SourceTable("cust", "governed_shop"))
    assert product.sql("select count(*) from {again}", ANALYST).first()[0] == 3
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        product.sql("select * from nowhere", ANALYST)


def test_no_views_are_left(spark, product):
    product.sql("select * from {cust}", ANALYST).collect()
    with pytest.raises(PermissionError):
        product.sql("drop table governed_shop.cust", ANALYST)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("governed_") and t.name != "governed_elsewhere"]
