"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.workspace import fresh_folder, map_arrow, ship_code  # noqa: F401

SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SPACES = b" \t\n\x0b\x0c\r"

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table under its declared schema, so that no file is opened to infer one."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with the first number behind it that no column of ``df`` has."""
    taken = {column.lower() for column in df.columns}
    names = [name, *(f"{name}_{number}" for number in range(1, len(taken) + 1))]
    return next(free for free in names if free.lower() not in taken)


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written below the shared folder and read back: a cut in the lineage that
    outlives any executor."""
    path = fresh_folder(df.sparkSession, f"llm/{label}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Within this, jobs send ``rows`` rows at a time to Python, so whole texts take less memory
    on both sides."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def id_remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text modulo ``modulus``; a null id counts as the empty text."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % modulus


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, max_rows: int, folds: int = 5
) -> DataFrame:
    """Documents with a label, as (doc_id, text, y double, fold), fold 0 left out.

    At most about ``max_rows`` of the labelled ids are used, picked by a hash of the id, so
    the id list is small whatever the corpus and can be broadcast. Null ids and null labels
    teach nothing; an id labelled several times counts with the mean of its labels.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col("doc_id").alias("labelled_id"))
        .agg(F.avg(F.col(label).cast("double")).alias("y"))
        .withColumn("fold", id_remainder("labelled_id", folds))
        .where("fold <> 0")
    )
    total = known.count()
    if total > max_rows:
        # 2**20 hash values: the picked count stays within a few roots of the bound.
        share = int(0.98 * max_rows / total * (1 << 20))
        picked = F.pmod(F.xxhash64("labelled_id"), F.lit(1 << 20)) < share
        known = known.where(picked)
    return docs.select("doc_id", "text").join(
        F.broadcast(known), F.col("doc_id") == F.col("labelled_id")
    ).select("doc_id", "text", "y", "fold")


def among(df: DataFrame, column: str, ids: DataFrame, most_bits: int = 1 << 26) -> DataFrame:
    """The rows of ``df`` whose ``column`` may be an id of the one-column ``ids``.

    A Bloom filter in DataFrame form: one hash into 16 bits per id, at most ``most_bits``, sent
    as a table of 64 bits per row; so at most a million rows are sent, whatever the number of ids.
    Rows that pass must still be joined; it only spares those that cannot match the shuffle.
    Null ids do not pass.
    """
    bits = min(most_bits, max(1 << 16, 1 << (16 * ids.count()).bit_length()))
    spot = F.pmod(F.xxhash64(ids.columns[0]), F.lit(bits))
    marks = (
        ids.select(F.shiftright(spot, 6).alias("_word"), (spot % 64).cast("int").alias("_bit"))
        .groupBy("_word")
        .agg(F.expr("bit_or(shiftleft(1L, _bit))").alias("_bits"))
    )
    own = F.pmod(F.xxhash64(column), F.lit(bits))
    marked = df.withColumn("_spot", own).join(
        F.broadcast(marks), F.shiftright("_spot", 6) == F.col("_word")
    )
    hit = F.expr("shiftrightunsigned(_bits, cast(_spot % 64 as int)) & 1") == 1
    return marked.where(hit & F.col(column).isNotNull()).select(*(df[c] for c in df.columns))
