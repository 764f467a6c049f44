"""Data products over the test tables: chains, contracts, versions, namespaces."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import SparkRuntimeException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.operators import (
    ColumnMask,
    Contract,
    ContractColumn,
    Identity,
    RowFilter,
    TableName,
    tail_mask,
)
from sparkmart.operators import cross_rates as rate_matrix
from sparkmart.plans import Product, chain_sql, convert, monthly, stage
from sparkmart.workload import rates, sales
from sparkmart.workload.tables import lay_table, load

RATE_CONTRACT = Contract.of(
    ContractColumn("from_currency", "string", "Code of the money given"),
    ContractColumn("to_currency", "string", "Code of the money received"),
    ContractColumn("rate", "float", "Units received for one unit given"),
)


def sales_product(spark: SparkSession, sf_dir: str, schema: str) -> Product:
    """Staging, conversion and monthly totals as a chain of views over two seeds."""
    product = Product(spark, schema)
    product.seed("countries", lambda spark: sales.countries(spark, sf_dir))
    product.seed("exchange_rates", sales.exchange_rates)

    @product.model("mart_monthly_sales", refs=["fct_sales"], meta={"output_port": "true"})
    def mart(ctx):
        return monthly(ctx.ref("fct_sales"))

    @product.model("fct_sales", refs=["stg_sales", "exchange_rates"])
    def fact(ctx):
        return convert(ctx.ref("stg_sales"), ctx.ref("exchange_rates"))

    @product.model("stg_sales", refs=["countries"])
    def staged(ctx):
        raw = sales.raw_sales(ctx.spark, sf_dir)
        return stage(raw, ctx.ref("countries"), sales.REPLACEMENTS)

    return product


def model_chain_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    product = sales_product(spark, sf_dir, "sparkmart_chain")
    return product.build()["mart_monthly_sales"]


def model_chain_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three views in SQL text, stored in the catalog, each built on the one before."""
    product = Product(spark, "sparkmart_chain_sql")
    product.seed("nations", lambda spark: load(spark, sf_dir, "nation"))
    lake = "sparkmart_chain_sql_lake"
    product.declare_source("orders", lay_table(spark, sf_dir, "orders", lake))
    product.declare_source("customers", lay_table(spark, sf_dir, "customer", lake))
    product.model(
        "spending",
        sql="select c_nationkey, o_orderpriority, cast(o_totalprice as decimal(18,2)) as price "
        "from {orders} left join {customers} on o_custkey = c_custkey",
    )
    product.model(
        "spending_by_nation",
        refs=["spending", "nations"],
        sql="select n_name, o_orderpriority, sum(price) as spent, count(*) as orders "
        "from {spending} left join {nations} on c_nationkey = n_nationkey "
        "group by n_name, o_orderpriority",
    )
    product.model(
        "urgent_spending",
        refs=["spending_by_nation"],
        sql="select n_name, cast(spent as decimal(18,2)) as spent, orders "
        "from {spending_by_nation} where o_orderpriority = '1-URGENT'",
    )
    return product.build()["urgent_spending"]


def sales_chain_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales chain as views stored in the catalog, over a landed table and two seeds."""
    product = Product(spark, "sparkmart_sales_sql")
    product.seed("countries", lambda spark: sales.countries(spark, sf_dir))
    product.seed("exchange_rates", sales.exchange_rates)

    @product.model("sales", materialized="table")
    def landed(ctx):
        return sales.raw_sales(ctx.spark, sf_dir)

    texts = chain_sql(sales.REPLACEMENTS)
    for name, text in texts.items():
        port = {"output_port": "true"} if name.startswith("mart") else {}
        product.model(name, sql=text, meta=port)
    return product.build()["mart_monthly_sales_eur"]


def model_namespaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One product built into two namespaces."""
    parts = []
    customers = lay_table(spark, sf_dir, "customer", "sparkmart_namespaces_lake")
    for schema in ("sparkmart_dev", "sparkmart_prod"):
        product = Product(spark, schema)
        product.seed("nations", lambda spark: load(spark, sf_dir, "nation"))
        product.declare_source("customers", customers)
        product.model(
            "customers_by_nation",
            refs=["nations"],
            sql="select n_name, count(c_custkey) as customers from {nations} "
            "left join {customers} on n_nationkey = c_nationkey group by n_name",
        )
        rows = product.build()["customers_by_nation"]
        parts.append(rows.select(F.lit(schema).alias("namespace"), "*"))
    return reduce(DataFrame.union, parts)


def rate_product(spark: SparkSession, sf_dir: str, schema: str) -> Product:
    """Two versions of a rate table under one contract."""
    product = Product(spark, schema)
    product.seed("exchange_rates", lambda spark: rates.price_levels(spark, sf_dir))
    for version in (1.0, 2.0):
        pivot = "F" if version == 1.0 else "O"

        def body(ctx, pivot=pivot):
            matrix = rate_matrix(ctx.ref("exchange_rates"), pivot)
            return matrix.select("rate", "to_currency", "from_currency")

        product.model(
            "anytoany",
            refs=["exchange_rates"],
            materialized="table",
            alias="any_to_any",
            version=version,
            latest=version == 2.0,
            contract=RATE_CONTRACT.inherit("all"),
        )(body)
    return product


def model_table_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest version as a table in contract order."""
    product = rate_product(spark, sf_dir, "sparkmart_contract")
    product.build()
    return product.ref("anytoany")


def model_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both versions side by side, told apart by the relation's name."""
    built = rate_product(spark, sf_dir, "sparkmart_versions").build()
    parts = [
        built[name].select(F.lit(name).alias("relation"), "*")
        for name in ("any_to_any_v1_0", "any_to_any_v2_0")
    ]
    return reduce(DataFrame.union, parts)


def model_output_ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of the relations tagged as output ports."""
    product = Product(spark, "sparkmart_ports")
    product.declare_source("orders", lay_table(spark, sf_dir, "orders", "sparkmart_ports_lake"))
    port = {"output_port": "true", "audience": "finance"}
    product.model(
        "open_orders",
        meta=port,
        sql="select * from {orders} where o_orderstatus = 'O'",
    )
    product.model(
        "orders_by_status",
        materialized="table",
        meta=port,
        sql="select o_orderstatus, count(*) as orders from {orders} group by o_orderstatus",
    )
    product.model(
        "scratch", sql="select * from {orders} where o_orderstatus = 'F'"
    )
    built = product.build()
    parts = [
        built[name].agg(F.count("*").alias("rows")).select(F.lit(name).alias("relation"), "rows")
        for name in product.output_ports()
    ]
    return reduce(DataFrame.union, parts)


def adhoc_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A question in SQL to a product's source."""
    product = Product(spark, "sparkmart_adhoc")
    lake = "sparkmart_adhoc_lake"
    product.declare_source("customers", lay_table(spark, sf_dir, "customer", lake))
    return product.sql(
        "select c_mktsegment, count(*) as customers, "
        "cast(sum(cast(c_acctbal as decimal(18,2))) as decimal(18,2)) as balance "
        "from {customers} group by c_mktsegment"
    )


def adhoc_sql_governed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same kind of question from a user who may not see everything."""
    product = Product(spark, "sparkmart_governed")
    lake = "sparkmart_governed_lake"
    product.declare_source("customers", lay_table(spark, sf_dir, "customer", lake))
    customer = TableName(product.catalog, lake, "customer")
    product.policies += [
        RowFilter(customer, "c_mktsegment <> 'BUILDING'"),
        ColumnMask(customer, "c_name", tail_mask("c_name")),
    ]
    product.declare_source("orders", lay_table(spark, sf_dir, "orders", lake))
    orders = TableName(product.catalog, lake, "orders")
    product.policies.append(RowFilter(orders, "o_orderstatus <> 'P'"))
    return product.sql(
        "select c_mktsegment, right(c_name, 1) as last_digit, count(o_orderkey) as orders, "
        "count(distinct c_name) as names "
        "from {customers} left join {orders} on c_custkey = o_custkey group by all",
        Identity("analyst"),
    )


def policy_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Policies on two seeds as they reach a view over a table over them: two filters, a mask that
    follows a renamed column, and columns made of masked ones, which are hidden."""
    product = Product(spark, "sparkmart_lineage", follow=True)
    product.seed("customers", load(spark, sf_dir, "customer"))
    product.seed("orders", load(spark, sf_dir, "orders"))
    product.model("sold", materialized="table", sql="""
        select o_orderkey, o_orderstatus as status, o_totalprice, c_name as buyer,
               c_mktsegment as segment, concat(c_mktsegment, '/', c_name) as label
        from {orders} join {customers} on o_custkey = c_custkey""")
    product.model("shown", sql="""
        select o_orderkey as order_key, status, buyer, segment, label, o_totalprice * 2 as twice
        from {sold} where status <> 'F'""")
    product.build()
    customers, orders = [
        TableName(product.catalog, product.schema, name) for name in ("customers", "orders")
    ]
    product.policies += [
        RowFilter(customers, "c_mktsegment <> 'BUILDING'"),
        RowFilter(orders, "o_orderstatus <> 'P' or o_orderkey % 2 = 0"),
        ColumnMask(customers, "c_name", tail_mask("c_name")),
        ColumnMask(orders, "o_totalprice", "0"),
    ]
    return product.read("shown", Identity("analyst"))


def model_atomic_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by status, built; then built anew over finished orders only, which fails in the last
    model; what is published is the first build, table and view."""

    def product(rows: DataFrame, last: str) -> Product:
        product = Product(spark, "sparkmart_atomic")
        product.seed("orders", rows)
        product.model("counted", materialized="table", sql="""
            select o_orderstatus, count(*) as orders from {orders} group by o_orderstatus""")
        product.model("ranked", sql="select *, orders > 100 as many from {counted}")
        product.model("last", materialized="table", sql=last)
        return product

    orders = load(spark, sf_dir, "orders")
    total = "select sum(orders) as total from {ranked}"
    built = product(orders, total)
    built.build()
    try:
        broken = product(orders.where("o_orderstatus = 'F'"), f"{total} having raise_error('no') = 1")
        broken.build()
    except SparkRuntimeException:
        pass
    else:
        raise AssertionError("the second build must fail")
    total = built.ref("last").select(F.lit("all").alias("o_orderstatus"), F.col("total").alias("orders"))
    return built.ref("ranked").unionByName(total, allowMissingColumns=True)


def model_switch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model built as a view, then as a table, then as a view again."""
    for kind in ("view", "table", "view"):
        product = Product(spark, "sparkmart_switch")
        product.seed("nations", lambda spark: load(spark, sf_dir, "nation"))
        product.model(
            "nations_by_region",
            materialized=kind,
            sql="select n_regionkey, count(*) as nations from {nations} group by n_regionkey",
        )
        built = product.build()
    return built["nations_by_region"]


QUERIES = {
    "model_chain_view": model_chain_view,
    "model_chain_sql": model_chain_sql,
    "sales_chain_sql": sales_chain_sql,
    "model_namespaces": model_namespaces,
    "model_table_contract": model_table_contract,
    "model_versions": model_versions,
    "model_output_ports": model_output_ports,
    "model_atomic_build": model_atomic_build,
    "policy_lineage": policy_lineage,
    "model_switch": model_switch,
    "adhoc_sql": adhoc_sql,
    "adhoc_sql_governed": adhoc_sql_governed,
}

_BY_NATION = """
    select n_name, count(c_custkey) as customers
    from nation left join customer on n_nationkey = c_nationkey group by n_name
"""

ORACLES = {
    "policy_lineage": """
        select o_orderkey as order_key, o_orderstatus as status, '****' || right(c_name, 3) as buyer,
               c_mktsegment as segment, cast(null as varchar) as label,
               cast(null as double) as twice
        from orders join customer on o_custkey = c_custkey
        where o_orderstatus <> 'F' and c_mktsegment <> 'BUILDING'
            and (o_orderstatus <> 'P' or o_orderkey % 2 = 0)
    """,
    "model_atomic_build": """
        select o_orderstatus, count(*) as orders, count(*) > 100 as many
        from orders group by o_orderstatus
        union all
        select 'all', count(*), null from orders
    """,
    "model_switch": "select n_regionkey, count(*) as nations from nation group by 1",
    "model_chain_view": sales.MART,
    "sales_chain_sql": sales.MART,
    "model_chain_sql": """
        select n_name, cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(18,2)) as spent,
               count(*) as orders
        from orders left join customer on o_custkey = c_custkey
        left join nation on c_nationkey = n_nationkey
        where o_orderpriority = '1-URGENT' group by n_name
    """,
    "model_namespaces": f"""
        select 'sparkmart_dev' as namespace, * from ({_BY_NATION})
        union all
        select 'sparkmart_prod', * from ({_BY_NATION})
    """,
    "model_table_contract": rates.CROSS,
    "model_versions": f"""
        select 'any_to_any_v1_0' as relation, * from ({rates.CROSS.replace("'O'", "'F'")})
        union all
        select 'any_to_any_v2_0', * from ({rates.CROSS})
    """,
    "model_output_ports": """
        select 'open_orders' as relation, count(*) as rows from orders where o_orderstatus = 'O'
        union all
        select 'orders_by_status', count(distinct o_orderstatus) from orders
    """,
    "adhoc_sql": """
        select c_mktsegment, count(*) as customers,
               cast(sum(cast(c_acctbal as decimal(18,2))) as decimal(18,2)) as balance
        from customer group by c_mktsegment
    """,
    "adhoc_sql_governed": """
        select c_mktsegment, right(c_name, 1) as last_digit, count(o_orderkey) as orders,
               count(distinct right(c_name, 3)) as names
        from customer left join (select * from orders where o_orderstatus <> 'P')
            on c_custkey = o_custkey
        where c_mktsegment <> 'BUILDING' group by 1, 2
    """,
}
