"""Row filters and column masks over customers and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.operators import ColumnMask, Identity, RowFilter, TableName, secure, tail_mask
from sparkmart.workload.tables import load

CUSTOMER = TableName("lake", "crm", "customer")
ARCHIVE = TableName("lake", "archive", "customer")
DOCUMENT = TableName("lake", "crm", "documents")

ANALYST = Identity("analyst")
ADMIN = Identity("admin")

NOT_BUILDING = RowFilter(CUSTOMER, "c_mktsegment <> 'BUILDING'")
IN_CREDIT = RowFilter(CUSTOMER, "c_acctbal > 0")
NO_BALANCE = ColumnMask(CUSTOMER, "c_acctbal", "NULL")
SEGMENT_TAIL = ColumnMask(CUSTOMER, "c_mktsegment", tail_mask("c_mktsegment"))
NAME_TAIL = ColumnMask(CUSTOMER, "c_name", tail_mask("c_name"))


def policy_row_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secure(load(spark, sf_dir, "customer"), CUSTOMER, ANALYST, [NOT_BUILDING])


def policy_row_filter_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A NULL segment fails the filter."""
    customer = load(spark, sf_dir, "customer").withColumn(
        "c_mktsegment", F.expr("nullif(c_mktsegment, 'AUTOMOBILE')")
    )
    return secure(customer, CUSTOMER, ANALYST, [NOT_BUILDING])


def policy_multi_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secure(load(spark, sf_dir, "customer"), CUSTOMER, ANALYST, [NOT_BUILDING, IN_CREDIT])


def policy_mask_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secure(load(spark, sf_dir, "customer"), CUSTOMER, ANALYST, [NO_BALANCE])


def policy_mask_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of two characters and NULLs among longer ones."""
    documents = load(spark, sf_dir, "documents").select(
        "doc_id", "lang", F.expr("nullif(source, 'src7')").alias("source"), "text"
    )
    masks = [ColumnMask(DOCUMENT, c, tail_mask(c)) for c in ("lang", "source", "text")]
    return secure(documents, DOCUMENT, ANALYST, masks)


def policy_admin_bypass(spark: SparkSession, sf_dir: str) -> DataFrame:
    policies = [NOT_BUILDING, NO_BALANCE]
    return secure(load(spark, sf_dir, "customer"), CUSTOMER, ADMIN, policies)


def policy_no_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    policies = [NOT_BUILDING, NO_BALANCE]
    return secure(load(spark, sf_dir, "customer"), CUSTOMER, None, policies)


def policy_other_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table name in another schema is not governed."""
    policies = [NOT_BUILDING, NO_BALANCE]
    return secure(load(spark, sf_dir, "customer"), ARCHIVE, ANALYST, policies)


def policy_filter_then_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The filter sees the segment that the mask covers."""
    policies = [SEGMENT_TAIL, NAME_TAIL, NO_BALANCE, IN_CREDIT, NOT_BUILDING]
    return secure(load(spark, sf_dir, "customer"), CUSTOMER, ANALYST, policies)


QUERIES = {
    "policy_row_filter": policy_row_filter,
    "policy_row_filter_nulls": policy_row_filter_nulls,
    "policy_multi_filter": policy_multi_filter,
    "policy_mask_null": policy_mask_null,
    "policy_mask_tail": policy_mask_tail,
    "policy_admin_bypass": policy_admin_bypass,
    "policy_no_identity": policy_no_identity,
    "policy_other_table": policy_other_table,
    "policy_filter_then_mask": policy_filter_then_mask,
}


def _tail(column: str) -> str:
    return (
        f"case when {column} is null then null when length({column}) < 3 then '****' "
        f"else '****' || right({column}, 3) end"
    )


ORACLES = {
    "policy_row_filter": "select * from customer where c_mktsegment <> 'BUILDING'",
    "policy_row_filter_nulls": """
        select * from customer where c_mktsegment not in ('BUILDING', 'AUTOMOBILE')
    """,
    "policy_multi_filter": """
        select * from customer where c_mktsegment <> 'BUILDING' and c_acctbal > 0
    """,
    "policy_mask_null": """
        select c_custkey, c_name, c_nationkey, cast(null as double) as c_acctbal, c_mktsegment
        from customer
    """,
    "policy_mask_tail": f"""
        select doc_id, {_tail("lang")} as lang,
               {_tail("nullif(source, 'src7')")} as source, {_tail("text")} as text
        from documents
    """,
    "policy_admin_bypass": "select * from customer",
    "policy_no_identity": """
        select c_custkey, c_name, c_nationkey, cast(null as double) as c_acctbal, c_mktsegment
        from customer where c_mktsegment <> 'BUILDING'
    """,
    "policy_other_table": "select * from customer",
    "policy_filter_then_mask": f"""
        select c_custkey, {_tail("c_name")} as c_name, c_nationkey,
               cast(null as double) as c_acctbal, {_tail("c_mktsegment")} as c_mktsegment
        from customer where c_mktsegment <> 'BUILDING' and c_acctbal > 0
    """,
}
