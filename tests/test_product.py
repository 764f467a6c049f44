import graphlib

import pytest
from pyspark.sql import functions as F

from sparkmart.operators import (
    ColumnMask,
    Contract,
    ContractColumn,
    ContractError,
    Identity,
    RowFilter,
    TableName,
)
from sparkmart.plans import Product, relation_name
from sparkmart.sources import SourceTable


@pytest.mark.parametrize(
    "name, alias, version, expected",
    [
        ("anytoany", "any_to_any", "1.0", "any_to_any_v1_0"),
        ("anytoany", "any_to_any", 2.0, "any_to_any_v2_0"),
        ("anytoany", "  any_to_any ", None, "any_to_any"),
        ("anytoany", None, "1.2.3", "anytoany_v1_2_3"),
        ("anytoany", "", 3, "anytoany_v3"),
        ("anytoany", "x", 0, "x"),
        ("anytoany", None, None, "anytoany"),
    ],
)
def test_relation_name(name, alias, version, expected):
    assert relation_name(name, alias, version) == expected


@pytest.fixture
def product(spark, tmp_path, request):
    name = "t_" + "".join(c if c.isalnum() else "_" for c in request.node.name).lower()
    return Product(spark, name, root=str(tmp_path))


def numbers(spark):
    return spark.range(5).select(F.col("id").alias("n"))


def test_chain_is_built_in_dependency_order(product):
    built = []
    product.seed("numbers", numbers)

    @product.model("last", refs=["middle"], materialized="table")
    def last(ctx):
        built.append("last")
        return ctx.ref("middle").agg(F.sum("n").alias("total"))

    @product.model("middle", refs=["first"])
    def middle(ctx):
        built.append("middle")
        return ctx.ref("first").where("n > 1")

    @product.model("first", refs=["numbers"])
    def first(ctx):
        built.append("first")
        return ctx.ref("numbers").select((F.col("n") * 10).alias("n"))

    relations = product.build()
    assert built == ["first", "middle", "last"]
    assert set(relations) == {"numbers", "first", "middle", "last"}
    assert relations["last"].first().total == 100
    assert relations["middle"].count() == 4


def test_seed_file_is_named_after_the_file(product, tmp_path):
    (tmp_path / "countries.csv").write_text("code,name\nDE,Germany\n")
    assert product.seed_file(str(tmp_path / "countries.csv")) == "countries"
    product.model("names", refs=["countries"], sql="select name from {countries}")
    assert product.build()["names"].first().name == "Germany"


def test_sql_view_is_stored_and_follows_its_table(spark, product):
    product.seed("numbers", numbers)
    product.model("evens", refs=["numbers"], sql="select n from {numbers} where n % 2 = 0")
    product.build()
    stored = f"spark_catalog.{product.schema}.evens"
    assert spark.catalog.tableExists(stored)
    assert not spark.catalog.getTable(stored).isTemporary
    assert spark.table(stored).count() == 3


def test_stored_view_over_session_view_raises(product):
    product.seed("numbers", numbers)
    product.model("session", refs=["numbers"])(lambda ctx: ctx.ref("numbers"))
    product.model("stored", refs=["session"], sql="select * from {session}")
    with pytest.raises(Exception, match="INVALID_TEMP_OBJ_REFERENCE"):
        product.build()


def test_rebuild_replaces_content(spark, product):
    size = [3]
    product.seed("numbers", lambda spark: spark.range(size[0]).select(F.col("id").alias("n")))
    product.model("copied", refs=["numbers"], materialized="table", sql="select * from {numbers}")
    before = product.build()["copied"]
    assert before.count() == 3
    size[0] = 7
    assert product.build()["copied"].count() == 7
    assert before.count() == 3


def test_versions_stay_side_by_side(product):
    product.seed("numbers", numbers)
    for version, limit in ((1.0, 2), ("10.0", 4), (2.0, 3)):
        product.model(
            "small",
            refs=["numbers"],
            alias="few",
            version=version,
            sql="select n from {numbers} where n < " + str(limit),
        )
    product.model("newest", refs=["small"], sql="select count(*) as n from {small}")
    product.model("pinned", refs=[("small", 1.0)], sql="select count(*) as n from {few_v1_0}")
    built = product.build()
    assert {"few_v1_0", "few_v2_0", "few_v10_0"} <= set(built)
    assert built["newest"].first().n == 4
    assert built["pinned"].first().n == 2
    assert product.ref("small", "2.0").count() == 3
    assert product.ref("small").count() == 4


def test_declared_latest_version_wins(product):
    product.seed("numbers", numbers)
    product.model("m", refs=["numbers"], version=1, latest=True, sql="select 1 as v from {numbers}")
    product.model("m", refs=["numbers"], version=2, sql="select 2 as v from {numbers}")
    product.build()
    assert product.ref("m").first().v == 1


def test_contract_is_enforced_and_comments_are_stored(spark, product):
    contract = Contract.of(ContractColumn("n", "bigint", "a number"))
    product.seed("numbers", numbers)
    product.model(
        "good",
        refs=["numbers"],
        materialized="table",
        contract=contract,
        sql="select * from {numbers}",
    )
    product.model("seen", refs=["numbers"], contract=contract, sql="select * from {numbers}")
    product.build()
    for name in ("good", "seen"):
        columns = spark.catalog.listColumns(f"spark_catalog.{product.schema}.{name}")
        assert [(c.name, c.description) for c in columns] == [("n", "a number")]

    product.model(
        "bad", refs=["numbers"], contract=contract, sql="select cast(n as int) as n from {numbers}"
    )
    with pytest.raises(ContractError, match="int, not bigint"):
        product.build()


def test_tags_and_output_ports(spark, product):
    product.seed("numbers", numbers)
    port = {"output_port": "true", "brand_content": "north"}
    text = "select * from {numbers}"
    product.model("a", refs=["numbers"], materialized="table", meta=port, sql=text)
    product.model("b", refs=["numbers"], meta={"output_port": "false"}, sql=text)
    product.model("c", refs=["numbers"], meta=port, description="the c's", sql=text)
    product.build()
    assert list(product.output_ports()) == ["a", "c"]
    assert list(product.relations(output_port="false")) == ["b"]
    for name in ("a", "c"):
        table = f"spark_catalog.{product.schema}.{name}"
        stored = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
        assert stored["meta.brand_content"] == "north"
    assert stored["description"] == "the c's"


def test_namespaces_do_not_mix(spark, tmp_path):
    counts = {}
    for schema, size in (("ns_one", 2), ("ns_two", 5)):
        product = Product(spark, schema, root=str(tmp_path))
        product.seed("numbers", lambda spark, size=size: spark.range(size))
        product.model("seen", refs=["numbers"])(lambda ctx: ctx.ref("numbers"))
        product.model("kept", refs=["numbers"], materialized="table", sql="select * from {numbers}")
        counts[schema] = product.build()
    assert [counts["ns_one"][n].count() for n in ("numbers", "seen", "kept")] == [2, 2, 2]
    assert [counts["ns_two"][n].count() for n in ("numbers", "seen", "kept")] == [5, 5, 5]


def test_sources_and_adhoc_sql(spark, product):
    product.seed("numbers", numbers)
    product.build()
    other = Product(spark, "t_reader", root=product.root)
    other.declare_source("outside", SourceTable("numbers", product.schema, "spark_catalog"))
    other.model("counted")(lambda ctx: ctx.source("outside").agg(F.count("*").alias("raw_count")))
    assert other.build()["counted"].first().raw_count == 5
    assert other.sql("select max(n) as top from {outside}").first().top == 4
    assert other.sql("select raw_count + 1 as next from {counted}").first().next == 6


def test_governed_read(spark, product):
    product.seed("numbers", numbers)
    product.build()
    table = TableName("spark_catalog", product.schema, "numbers")
    product.policies += [RowFilter(table, "n <> 3"), ColumnMask(table, "n", "n * 0")]
    seen = product.read("numbers", Identity("someone"))
    assert tuple(seen.agg(F.sum("n"), F.count("*")).first()) == (0, 4)
    assert product.read("numbers", Identity("admin")).count() == 5


def test_governed_sql(spark, product):
    product.seed("numbers", numbers)
    for version in (1, 2):
        product.model(
            "m", refs=["numbers"], version=version, sql="select n, %d as v from {numbers}" % version
        )
    product.build()
    product.declare_source("outside", SourceTable("numbers", product.schema))
    product.policies += [
        RowFilter(TableName("spark_catalog", product.schema, "numbers"), "n > 2"),
        RowFilter(TableName("spark_catalog", product.schema, "m_v2"), "n > 3"),
    ]
    text = "select (select count(*) from {numbers}), (select count(*) from {outside}), " \
        "(select count(*) from {m}), (select count(*) from {m_v1})"
    assert tuple(product.sql(text).first()) == (2, 2, 1, 5)
    assert tuple(product.sql(text, Identity("analyst")).first()) == (2, 2, 1, 5)
    assert tuple(product.sql(text, Identity("admin")).first()) == (5, 5, 5, 5)
    with pytest.raises(KeyError, match="nothing"):
        product.sql("select * from {nothing}")


def test_cycle_raises(product):
    product.model("a", refs=["b"], sql="select * from {b}")
    product.model("b", refs=["a"], sql="select * from {a}")
    with pytest.raises(graphlib.CycleError):
        product.build()


def test_unknown_and_undeclared_references(product):
    product.seed("numbers", numbers)
    with pytest.raises(LookupError):
        product.ref("numbers")
    product.model("uses", refs=[])(lambda ctx: ctx.ref("numbers"))
    with pytest.raises(KeyError, match="does not declare"):
        product.build()
    product.model("broken", refs=["nothing"], sql="select 1")
    with pytest.raises(KeyError, match="nothing"):
        product.build()


def test_names_must_be_new(product):
    product.seed("numbers", numbers)
    with pytest.raises(ValueError, match="twice"):
        product.seed("numbers", numbers)
    with pytest.raises(ValueError, match="twice"):
        product.model("numbers", sql="select 1 as x")
    product.model("m", version=1, sql="select 1 as x")
    with pytest.raises(ValueError, match="twice"):
        product.model("m", version="1", sql="select 1 as x")
    with pytest.raises(ValueError, match="needs one"):
        product.model("m", sql="select 1 as x")
    with pytest.raises(ValueError, match="relation"):
        product.model("other", alias="m", version=1, sql="select 1 as x")
    with pytest.raises(ValueError, match="materialized"):
        product.model("n", materialized="stream", sql="select 1 as x")
