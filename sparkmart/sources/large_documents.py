"""One registry document of any size, read by many tasks.

The file is cut at closing braces, wherever its blocks begin. A piece tells, for a start within a string
and for one outside, how many quotes it has and by how much it changes the depth of nesting. Prefix
sums over the pieces of a block, and over the blocks, then give the state and the depth at each
piece, and an entry ends where the depth comes back to that of the map. The pieces of an entry
are joined, and Spark's JSON parser reads it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.sources.documents import RECORD, ROOT

# Depth within the map of entries: the document's brace and the map's.
_MAP_DEPTH = 2


def _count(text: Column, letter: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(letter), F.lit("")))


def read_pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, place, piece): the text before each closing brace; within a block by place."""
    return spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        F.col("value").alias("piece"),
    )


def _measured(pieces: DataFrame) -> DataFrame:
    """Pieces with ``_quotes`` and the change of depth from a start outside and inside a string."""
    bare = F.regexp_replace("piece", r"(?s)\\.", "")
    strings = r'"[^"]*("|$)'
    outside = F.regexp_replace("_bare", strings, "")
    after_string = F.regexp_replace(F.regexp_replace("_bare", r'^[^"]*("|$)', ""), strings, "")
    quotes = _count(F.col("_bare"), '"')

    def change(text: Column, start: int) -> Column:
        # The closing brace behind the piece counts unless it stands within a string.
        return _count(text, "{") - F.when((quotes + start) % 2 == 0, 1).otherwise(0)

    return pieces.withColumn("_bare", bare).select(
        "file",
        "block",
        "place",
        "piece",
        (quotes % 2).alias("_quotes"),
        change(outside, 0).alias("_change_0"),
        change(after_string, 1).alias("_change_1"),
    )


def entries(pieces: DataFrame) -> DataFrame:
    """(file, text, ended) of all entries of the documents' maps, with what stands around the first;
    the rest behind the last entry has not ``ended``."""
    inside = Window.partitionBy("file", "block").orderBy("place")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    counted = _measured(pieces).withColumn(
        "_state", F.coalesce(F.sum("_quotes").over(before), F.lit(0)) % 2
    )

    def depth(start: int) -> Column:
        change = F.when((F.col("_state") + start) % 2 == 0, F.col("_change_0"))
        return change.otherwise(F.col("_change_1"))

    blocks = counted.groupBy("file", "block").agg(
        F.sum("_quotes").alias("_sum"), F.sum(depth(0)).alias("_d0"), F.sum(depth(1)).alias("_d1")
    )
    by_block = Window.partitionBy("file").orderBy("block")
    earlier = by_block.rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn(
        "_start", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)) % 2
    ).withColumn("_deeper", F.when(F.col("_start") == 0, F.col("_d0")).otherwise(F.col("_d1")))
    left_open = F.sum("_deeper").over(Window.partitionBy("file"))
    blocks = blocks.select(
        "file",
        "block",
        "_start",
        F.coalesce(F.sum("_deeper").over(earlier), F.lit(0)).alias("_depth"),
        # Without a brace behind it, the blank end of a file counts as one level less.
        F.when(left_open.between(-1, 0), False)
        .otherwise(F.raise_error(F.concat(F.lit("malformed: braces are left open in "), "file")))
        .alias("_broken"),
    )
    placed = counted.join(blocks, ["file", "block"]).withColumn(
        "_change",
        F.when(F.col("_start") == 0, depth(0)).otherwise(depth(1)),
    )
    deep = F.col("_depth") + F.sum("_change").over(
        inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    outside = (F.col("_start") + F.col("_state") + F.col("_quotes")) % 2 == 0
    ended = placed.select(
        "file",
        "block",
        "place",
        "piece",
        (outside & (deep == _MAP_DEPTH) & ~F.col("_broken")).alias("_ends"),
    )
    return _joined(ended)


def _joined(pieces: DataFrame) -> DataFrame:
    """The pieces up to each end as one text; an end may be some blocks further on.

    What follows is looked up in falling order, so that a frame grows row by row: one that reaches
    to the end of its partition is computed anew for each row.
    """
    inside = Window.partitionBy("file", "block").orderBy(F.desc("place"))
    end = F.when(F.col("_ends"), F.col("place"))
    own = F.min(end).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    falling = Window.partitionBy("file").orderBy(F.desc("block"))
    later = falling.rowsBetween(Window.unboundedPreceding, -1)
    first = F.when(F.col("_first").isNotNull(), F.struct(F.col("block").alias("at"), F.col("_first").alias("end")))
    blocks = (
        pieces.groupBy("file", "block")
        .agg(F.min(end).alias("_first"))
        .select("file", "block", "_first", F.last(first, ignorenulls=True).over(later).alias("_next"))
    )
    placed = pieces.withColumn("_own", own).join(blocks, ["file", "block"])
    parts = F.array_sort(F.collect_list(F.struct("block", "place", "piece")))
    text = F.array_join(F.transform(parts, lambda part: part["piece"]), "}").alias("text")
    # Entries behind the first end of a block are in it as a whole, and so grouped where they are; only
    # the pieces at the edges of a block are dealt out anew.
    behind = F.coalesce(F.col("_own") > F.col("_first"), F.lit(False))
    alone = placed.where(behind).groupBy("file", "block", "_own").agg(text)
    entry = F.when(
        F.col("_own").isNotNull(), F.struct(F.col("block").alias("at"), F.col("_own").alias("end"))
    )
    edges = placed.where(~behind).groupBy("file", F.coalesce(entry, F.col("_next")).alias("_entry")).agg(text)
    return alone.select("file", "text", F.lit(True).alias("ended")).unionByName(
        edges.select("file", "text", F.col("_entry").isNotNull().alias("ended"))
    )


def read_large_document(
    spark: SparkSession, path: str, record: T.StructType = RECORD, root: str = ROOT
) -> DataFrame:
    """The records of the documents below ``path``, each file one JSON object ``{root: {name: record}}``.

    As ``read_documents`` with ``whole_file``, but a file is read by as many tasks as its size asks
    for. A file with braces left open, another root or a record that does not fit ends the read. A file
    must hold one document, with ``root`` its only member.
    """
    found = entries(read_pieces(spark, path))
    opening = rf'^\s*\{{\s*"{root}"\s*:\s*\{{'
    text = F.when(F.col("ended"), F.concat("text", F.lit("}"))).otherwise(
        F.regexp_replace("text", r"\s*(\}\s*){0,2}$", "")
    )
    text = F.when(
        text.rlike(opening) | text.rlike(r"^\s*(,|$)"), F.regexp_replace(text, opening, "")
    ).otherwise(F.raise_error(F.concat(F.lit("malformed: an entry is not set apart in "), "file")))
    entry = F.trim(F.regexp_replace(text, r"^\s*,", ""), F.lit(" \t\r\n"))
    kind = T.MapType(T.StringType(), record)
    wrapped = F.concat(F.lit("{"), "_text", F.lit("}"))
    return (
        found.select(entry.alias("_text"))
        .where("_text <> ''")
        .select(F.explode(F.from_json(wrapped, kind, {"mode": "FAILFAST"})).alias("_key", "_record"))
        .select("_record.*")
    )
