"""Registry operations over documents, events, customers and suppliers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.operators import (
    RegistryStore,
    insert_absent,
    list_keys,
    new_records,
    update_columns,
    validate,
    with_reasons,
)
from sparkmart.sources import (
    read_documents,
    read_large_document,
    write_documents,
    write_parquet,
)
from sparkmart.sources.documents import FLAGS
from sparkmart.workload.tables import SCHEMAS, load
from sparkmart.workspace import fresh_folder


def candidate_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record per document, good and bad ones according to language and text."""
    good = F.concat("source", F.lit("@"), "lang", F.lit(".org"))
    bad = F.concat("source", F.lit("@"), "lang")
    return load(spark, sf_dir, "documents").select(
        "doc_id",
        F.concat_ws("_", "source", "doc_id").alias("name"),
        F.when(F.col("lang") == "es", F.upper("source")).otherwise(F.col("source")).alias("domain"),
        F.col("text").alias("description"),
        F.when(F.col("lang") == "en", F.array(good))
        .when(F.col("lang") == "de", F.array(good, bad))
        .when(F.col("lang") == "fr", F.array().cast("array<string>"))
        .otherwise(F.array(good, good))
        .alias("admin_emails"),
    )


def registry_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record with the reasons against it, none for a good one."""
    checked = with_reasons(candidate_records(spark, sf_dir))
    return checked.select("doc_id", "name", F.concat_ws(",", "reasons").alias("reasons"))


def registry_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The good records only, with their flags set to false."""
    valid, _ = validate(candidate_records(spark, sf_dir))
    return new_records(valid.select("doc_id", "name", "description"))


def registry_insert_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as inserts keyed by user; suppliers' numbers are taken already."""
    taken = load(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("user_id"))
    batch = load(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    accepted, rejected = insert_absent(taken, batch, "user_id", ["event_id"])
    inserted = new_records(accepted, ["published"]).withColumn("outcome", F.lit("inserted"))
    refused = rejected.withColumn("outcome", F.lit("refused"))
    return inserted.withColumn("published", F.col("published").cast("string")).unionByName(
        refused, allowMissingColumns=True
    )


def _account_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").select(
        F.col("user_id").alias("s_suppkey"),
        "event_id",
        F.expr("nullif(event_type, 'error')").alias("s_name"),
        F.col("value").alias("s_acctbal"),
    )


def registry_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A supplier's last event overwrites two columns, one of them at times by NULL."""
    updated, _ = update_columns(
        load(spark, sf_dir, "supplier"),
        _account_updates(spark, sf_dir),
        "s_suppkey",
        ["s_name", "s_acctbal"],
        ["event_id"],
    )
    return updated


def registry_update_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Updates for suppliers that do not exist."""
    _, unknown = update_columns(
        load(spark, sf_dir, "supplier"),
        _account_updates(spark, sf_dir),
        "s_suppkey",
        ["s_name", "s_acctbal"],
        ["event_id"],
    )
    return unknown


def registry_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return list_keys(load(spark, sf_dir, "customer"), "c_name")


def registry_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers written as registry documents and read back as rows."""
    folder = fresh_folder(spark, "registry_document")
    write_documents(load(spark, sf_dir, "customer"), folder, key="c_name")
    return read_documents(spark, folder, T.StructType.fromDDL(SCHEMAS["customer"]))


def registry_large_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as one registry document, written by one task and read by as many tasks as its
    size asks for; names and texts hold braces and quotes."""
    folder = fresh_folder(spark, "registry_large_document")
    records = load(spark, sf_dir, "documents").select(
        F.concat_ws("_", "source", "doc_id").alias("name"),
        "doc_id",
        F.replace("text", F.lit(". "), F.lit('."}{" \\ ')).alias("text"),
    )
    entry = F.concat(
        F.substring(F.to_json(F.array("name")), F.lit(2), F.length(F.to_json(F.array("name"))) - 2),
        F.lit(": "),
        F.to_json(F.struct("*")),
    )
    # The lines of one file: the opening with an empty entry, the entries, and the end.
    listed = records.select(F.concat(F.lit(", "), entry).alias("value"))
    opening = spark.range(1).select(F.lit('{"data_products": {"": null').alias("value"))
    closing = spark.range(1).select(F.lit("}}").alias("value"))
    opening.unionByName(listed).unionByName(closing).coalesce(1).write.text(f"{folder}/registry")
    schema = T.StructType.fromDDL("name string, doc_id bigint, text string")
    found = read_large_document(spark, f"{folder}/registry", schema).where("doc_id is not null")
    return write_parquet(found, f"{folder}/read")


def registry_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored registry of suppliers. Sign-ups and purchases insert accounts that are absent, and
    the last of the other events overwrites two columns; then all is read back."""
    folder = fresh_folder(spark, "registry_merge")
    schema = T.StructType.fromDDL(SCHEMAS["supplier"])
    store = RegistryStore.create(spark, folder, schema, "s_suppkey", buckets=16)
    store.merge(inserts=load(spark, sf_dir, "supplier"), arrival=["s_suppkey"])
    is_insert = F.col("event_type").isin("signup", "purchase")
    events = load(spark, sf_dir, "events").withColumnsRenamed(
        {"user_id": "s_suppkey", "value": "s_acctbal"}
    )
    store.merge(
        inserts=events.where(is_insert).withColumn("s_name", F.col("event_type")),
        arrival=["event_id"],
        updates=events.where(~is_insert).withColumn("s_name", F.expr("nullif(event_type, 'error')")),
        columns=["s_name", "s_acctbal"],
        order=["event_id"],
    )
    return store.read()


QUERIES = {
    "registry_validate": registry_validate,
    "registry_valid": registry_valid,
    "registry_insert_absent": registry_insert_absent,
    "registry_update": registry_update,
    "registry_update_unknown": registry_update_unknown,
    "registry_list": registry_list,
    "registry_document": registry_document,
    "registry_merge": registry_merge,
    "registry_large_document": registry_large_document,
}

_CHECKED = r"""
with records as (
    select doc_id, source || '_' || doc_id as name, text as description,
           case lang when 'es' then upper(source) else source end as domain,
           case lang when 'en' then [source || '@' || lang || '.org']
                     when 'de' then [source || '@' || lang || '.org', source || '@' || lang]
                     when 'fr' then []
                     else [source || '@' || lang || '.org', source || '@' || lang || '.org']
           end as admin_emails
    from documents
), checked as (
    select doc_id, name, description, concat_ws(',',
        case when not regexp_full_match(domain, '[a-z0-9_]+') then 'domain' end,
        case when not regexp_full_match(name, '[a-z0-9_]+') then 'name' end,
        case when length(description) not between 10 and 200 then 'description' end,
        case when len(admin_emails) < 1 then 'admin_emails_empty' end,
        case when len(list_filter(admin_emails, lambda e: not regexp_full_match(e,
             '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}'))) > 0
             then 'admin_emails' end) as reasons
    from records
)
"""

ORACLES = {
    "registry_validate": f"{_CHECKED} select doc_id, name, reasons from checked",
    "registry_valid": f"""
        {_CHECKED}
        select doc_id, name, description, {", ".join(f"false as {flag}" for flag in FLAGS)}
        from checked where reasons = ''
    """,
    "registry_insert_absent": """
        with ranked as (
            select *, row_number() over (partition by user_id order by event_id) as place
            from events
        ), decided as (
            select *, place = 1 and user_id not in (select s_suppkey from supplier) as fresh
            from ranked
        )
        select user_id, event_id, event_type, value,
               case when fresh then 'false' end as published,
               case when fresh then 'inserted' else 'refused' end as outcome
        from decided
    """,
    "registry_update": """
        with last as (
            select *, row_number() over (partition by user_id order by event_id desc) as place
            from events
        )
        select s_suppkey,
               case when user_id is null then s_name else nullif(event_type, 'error') end
                   as s_name,
               s_nationkey,
               case when user_id is null then s_acctbal else value end as s_acctbal
        from supplier left join last on s_suppkey = user_id and place = 1
    """,
    "registry_update_unknown": """
        select user_id as s_suppkey, event_id, nullif(event_type, 'error') as s_name,
               value as s_acctbal
        from events where user_id not in (select s_suppkey from supplier)
    """,
    "registry_list": "select c_name from customer",
    "registry_large_document": """
        select source || '_' || doc_id as name, doc_id,
               replace(text, '. ', '."}{" \\ ') as text
        from documents
    """,
    "registry_merge": """
        with inserted as (
            select * from supplier
            union all
            select user_id, event_type, null, value
            from events where event_type in ('signup', 'purchase')
                and user_id not in (select s_suppkey from supplier)
            qualify row_number() over (partition by user_id order by event_id) = 1
        ), last as (
            select * from events where event_type not in ('signup', 'purchase')
            qualify row_number() over (partition by user_id order by event_id desc) = 1
        )
        select s_suppkey, case when user_id is null then s_name else nullif(event_type, 'error') end
                as s_name, s_nationkey,
            case when user_id is null then s_acctbal else value end as s_acctbal
        from inserted left join last on s_suppkey = user_id
    """,
    "registry_document": "select * from customer",
}
