"""Policies that follow columns: lineage of resolved plans, masks and filters on models above."""

import pytest
from pyspark.sql import functions as F

from sparkmart.operators import ColumnMask, Identity, RowFilter, TableName
from sparkmart.plans import Product

ANALYST = Identity("analyst")
PEOPLE = [(1, "ann", "x", 10), (2, "bob", "y", 20), (3, "cid", "x", 30), (4, None, "z", 40)]


@pytest.fixture
def product(spark, tmp_path, request):
    name = "l_" + "".join(c if c.isalnum() else "_" for c in request.node.name).lower()
    product = Product(spark, name, root=str(tmp_path), follow=True)
    product.seed("people", spark.createDataFrame(PEOPLE, "n int, name string, kind string, pay int"))
    product.seed("kinds", spark.createDataFrame([("x", "ex"), ("y", "why")], "kind string, label string"))
    return product


def table(product, name):
    return TableName("spark_catalog", product.schema, name)


def mask(product, column, expression, name="people"):
    return ColumnMask(table(product, name), column, expression)


def test_masks_follow_through_tables_views_and_functions(product, rows):
    product.model("renamed", materialized="table", sql="select n, name as who, upper(name) as loud, pay from {people}")
    product.model("again", sql="select who as person, loud || '!' as louder, n, pay + 1 as more from {renamed}")

    @product.model("last", refs=["again"])
    def last(ctx):
        return ctx.ref("again").select("person", F.length("louder").alias("size"), "more", "n")

    product.build()
    product.policies.append(mask(product, "name", "left(name, 1) || '**'"))
    assert rows(product.read("renamed", ANALYST).where("n < 3")) == [(1, "a**", None, 10), (2, "b**", None, 20)]
    assert rows(product.read("again", ANALYST).where("n = 1")) == [("a**", None, 1, 11)]
    assert rows(product.read("last", ANALYST).where("n = 1")) == [("a**", None, 11, 1)]
    assert rows(product.read("last", Identity("admin")).where("n = 1")) == [("ann", 4, 11, 1)]
    assert product.read("last", ANALYST).dtypes == product.ref("last").dtypes
    assert product.sql("select max(person) from {last}", ANALYST).first()[0] == "c**"


def test_a_mask_that_reads_other_columns(product, rows):
    product.model("with_kind", sql="select name, kind from {people} where n = 1")
    product.model("without", sql="select name from {people} where n = 1")
    product.build()
    product.policies.append(mask(product, "name", "concat(kind, '-', name)"))
    assert rows(product.read("with_kind", ANALYST)) == [("x-ann", "x")]
    assert rows(product.read("without", ANALYST)) == [(None,)]


def test_derived_columns_of_all_sorts_are_hidden(product):
    product.model("made", sql="""
        select n, cast(pay as long) as pay_cast, (select max(pay) from {people}) as top,
            sum(pay) over (order by n) as running, case when pay > 15 then 1 end as flag,
            row_number() over (order by pay) as place, kind
        from {people}""")
    product.model("grouped", sql="select kind, sum(pay) as pay, count(*) as n from {people} group by kind")
    product.model("both", sql="select n, pay from {people} union all select 0, 5")
    product.model("either", sql="with p as (select n, pay as p from {people}) select a.n, b.p from p a join p b using (n)")
    product.model("spread", sql="select n, part from {people} lateral view explode(array(pay, n)) as part")
    product.build()
    product.policies.append(mask(product, "pay", "-1"))
    first = product.read("made", ANALYST).where("n = 2").first()
    assert tuple(first) == (2, None, None, None, None, None, "y")
    assert {tuple(r) for r in product.read("grouped", ANALYST).collect()} == {("x", None, 2), ("y", None, 1), ("z", None, 1)}
    assert {r["pay"] for r in product.read("both", ANALYST).collect()} <= {-1, None}
    assert {r["p"] for r in product.read("either", ANALYST).collect()} == {-1}
    assert {r["part"] for r in product.read("spread", ANALYST).collect()} == {None}


def test_filters_follow_where_rows_stand_for_rows(product, rows, plan_of):
    product.model("kept", materialized="table", sql="select n as number, kind as sort, pay * 2 as twice from {people}")
    product.model("joined", sql="select number, sort, label from {kept} left join {kinds} on sort = kind")
    product.build()
    product.policies.append(RowFilter(table(product, "people"), "kind = 'x' and n > 1"))
    assert rows(product.read("kept", ANALYST)) == [(3, "x", 60)]
    assert rows(product.read("joined", ANALYST)) == [(3, "x", "ex")]
    plan = plan_of(product.read("kept", ANALYST))
    assert "EqualTo(sort,x)" in plan and "__versions.people" not in plan
    assert product.read("kept", Identity("admin")).count() == 4


def test_filters_that_cannot_be_carried_make_the_rows_anew(product, rows):
    product.model("total", materialized="table", sql="select sum(pay) as pay, count(*) as n from {people}")
    product.model("narrow", materialized="table", sql="select pay from {people}")
    product.model("top", sql="select n, kind from {people} order by n limit 2")
    product.model("outer_side", sql="select k.kind, n from {kinds} k left join {people} p on k.kind = p.kind and n < 3")
    product.model("twice", sql="select a.n, b.n as m from {people} a join {people} b on a.kind = b.kind")
    product.model("exists_only", sql="select * from {kinds} k where exists (select 1 from {people} p where p.kind = k.kind)")

    @product.model("by_function", refs=["people"], materialized="table")
    def by_function(ctx):
        return ctx.ref("people").groupBy("kind").agg(F.max("pay").alias("top"))

    product.model("above", sql="select pay + 1 as next from {total}")
    product.build()
    product.policies.append(RowFilter(table(product, "people"), "n > 1 and kind <> 'y'"))
    assert rows(product.read("total", ANALYST)) == [(70, 2)]
    assert rows(product.read("narrow", ANALYST)) == [(30,), (40,)]
    assert rows(product.read("top", ANALYST)) == [(3, "x"), (4, "z")]
    assert rows(product.read("outer_side", ANALYST)) == [("x", None), ("y", None)]
    assert rows(product.read("twice", ANALYST)) == [(3, 3), (4, 4)]
    assert rows(product.read("exists_only", ANALYST)) == [("x", "ex")]
    assert rows(product.read("by_function", ANALYST)) == [("x", 30), ("z", 40)]
    assert rows(product.read("above", ANALYST)) == [(71,)]
    assert rows(product.read("total", Identity("admin"))) == [(100, 4)]


def test_own_policies_come_on_top_and_owners_rights_stay_the_default(spark, product, rows):
    product.model("seen", materialized="table", sql="select n, name from {people}")
    product.build()
    product.policies += [
        mask(product, "name", "'*'"),
        RowFilter(table(product, "seen"), "n < 3"),
        RowFilter(table(product, "kinds"), "kind = 'x'"),
    ]
    assert rows(product.read("seen", ANALYST)) == [(1, "*"), (2, "*")]
    product.follow = False
    assert rows(product.read("seen", ANALYST)) == [(1, "ann"), (2, "bob")]


def test_a_rebuild_has_the_new_lineage(spark, product, rows):
    for text, expected in (("select name as a from {people} where n = 1", "*"), ("select kind as a from {people} where n = 1", "x")):
        again = Product(spark, product.schema, root=product.root, follow=True)
        again._seeds = product._seeds
        again.model("seen", materialized="table", sql=text)
        again.build()
        again.policies.append(mask(again, "name", "'*'"))
        assert rows(again.read("seen", ANALYST)) == [(expected,)]
