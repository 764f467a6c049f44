"""A training corpus from raw documents: one dealt operator per stage, in Spark tables.

Each stage works on all rows of ``documents`` that its predecessor kept, and its decisions take
effect. All stages but the last return the columns of ``documents``; the last returns the packed
pieces. A stage handles nulls, empty texts and repeated rows as its operator says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.llm.common import DOCUMENT_COLUMNS, stored, table
from sparkmart.llm.decontamination import without_benchmark
from sparkmart.llm.line_dedup import without_repeated_lines
from sparkmart.llm.near_duplicates import near_duplicates
from sparkmart.llm.packing import pack
from sparkmart.llm.quality import KEEP_FROM, fit_quality, with_quality


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among them, does not reject."""
    rows = docs.select(*DOCUMENT_COLUMNS)
    model = fit_quality(rows, table(spark, sf_dir, "labels"))
    return with_quality(rows, model).where(F.col("score") >= KEEP_FROM).drop("score")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that stand in another document with a larger id."""
    rows = without_repeated_lines(docs.select(*DOCUMENT_COLUMNS))
    return rows.withColumn("n_chars", F.length("text").cast("bigint"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id; rows without
    an id belong to no group and stay."""
    rows = docs.select(*DOCUMENT_COLUMNS)
    kept = near_duplicates(rows).where("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    return rows.join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")), "left_semi")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return without_benchmark(docs.select(*DOCUMENT_COLUMNS), table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces with their sequence and offset."""
    return pack(docs)


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", line_dedup),
    ("minhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("best_fit_packing", packing),
]

#: The fitted model, the tiling and the tokenizer have no SQL form; tests compare by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
