"""Mixing sources to target weights by systematic sampling.

Sources share all words by weight, none more than a multiple of what it has; what is over is shared
again by weight. A source's target over its size is the expected number of copies of each of its
documents. Within a source, documents stand by size and then by a hash of their id; their expected
copies are summed up in that order, one random offset is added, and a document is emitted once for
each whole number that its own share carries the sum across. So it appears floor or ceiling of its
expected copies times, and since neighbours in order are of about equal size, the words taken miss the
target by no more than about the source's longest document.

The sums are made by ranges: a range partitioning by source, size and hash splits a source of
any size, each range sums its own rows, and a range's sum carries over to the later ranges. Expected
copies are whole numbers of 2**-30, so a run again gives the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm.common import stored
from sparkmart.operators.lookups import lookup

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
SEED = 1
#: Expected copies are counted in these parts of one.
BITS = 30
ONE = 1 << BITS

_WORD = r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"
_SPACES = " \t\n\x0b\x0c\r"


def word_count(text: Column) -> Column:
    """Number of `[^\\x20\\x09-\\x0D]+` in a text, 0 for null: each word and the space behind it
    become one letter, so no array of words is made."""
    letters = F.translate(F.regexp_replace(text, _WORD, "x"), _SPACES, "")
    return F.coalesce(F.length(letters), F.lit(0)).cast("bigint")


def ranged(df: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """``df`` dealt into ranges of ``order`` and written, with the number of the range in
    ``_range``. Ranges are in order; rows equal in ``order`` share one."""
    return stored(
        df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), label
    )


def running_sums(
    rows: DataFrame, group: str, order: Sequence[str], sums: dict[str, Column], modulus: int | None = None
) -> DataFrame:
    """``rows`` of ``ranged`` with the sums of earlier rows of the group, under the names of ``sums``.

    Each range sums its own rows; a group's ranges, as many as the tasks that hold its rows,
    carry theirs over. With a modulus the sums are meant modulo it, and stay small.
    """
    own = rows.withColumns({f"_own_{name}": value for name, value in sums.items()})
    per_range = own.groupBy("_range", group).agg(
        *[F.sum(f"_own_{name}").alias(name) for name in sums]
    )

    def within(value: Column) -> Column:
        return F.pmod(value, F.lit(modulus)) if modulus else value

    earlier = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_range.select(
        F.col("_range"),
        F.col(group),
        *[
            F.coalesce(F.sum(within(F.col(name))).over(earlier), F.lit(0)).alias(f"_start_{name}")
            for name in sums
        ],
    )
    before = (
        Window.partitionBy("_range", group)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        own.join(starts, ["_range", group])
        .withColumns(
            {
                name: within(
                    F.col(f"_start_{name}")
                    + F.coalesce(F.sum(f"_own_{name}").over(before), F.lit(0))
                )
                for name in sums
            }
        )
        .select(*rows.columns, *sums)
    )


def targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES
) -> DataFrame:
    """``sizes(source_key, source_size)``, a row per source, with its ``target``.

    The sources by key weigh ``weights`` in turn. Sources in order of most * size / weight: those
    at their bound come first, so the level of the rest follows from sums over the earlier ones.
    """
    one = F.lit(0).alias("_all")
    listed = ranged(sizes.select("source_key", "source_size", one), ["source_key"], "sources")
    place = running_sums(listed, "_all", ["source_key"], {"_place": F.lit(1).cast("bigint")})
    turn = (F.col("_place") % len(weights) + 1).cast("int")
    weighed = place.drop("_range").select(
        "*",
        F.element_at(F.array(*[F.lit(w).cast("bigint") for w in weights]), turn).alias("_weight"),
        (F.col("source_size") * most).alias("_bound"),
    )
    by_bound = weighed.withColumn("_ratio", F.col("_bound") / F.col("_weight"))
    order = ["_ratio", "source_key"]
    levels = running_sums(
        ranged(by_bound, order, "bounds"),
        "_all",
        order,
        {"_bounds": F.col("_bound"), "_weights": F.col("_weight")},
    )
    total = by_bound.agg(
        F.coalesce(F.sum("source_size"), F.lit(0)).alias("size"), F.sum("_weight").alias("weight")
    ).first()
    level = (F.lit(total["size"]) - F.col("_bounds")) / (F.lit(total["weight"]) - F.col("_weights"))
    found = (
        levels.withColumn("_level", level)
        .where(F.col("_ratio") >= F.col("_level"))
        .agg(F.min_by("_level", F.struct("_ratio", "source_key")).alias("level"))
        .first()["level"]
    )
    target = F.least(
        F.col("_bound").cast("double"), F.lit(found).cast("double") * F.col("_weight")
    )
    return levels.select("source_key", "source_size", target.alias("target"))


def plan_mix(
    docs: DataFrame,
    keep: Sequence[str] = ("doc_id",),
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST_COPIES,
    seed: int = SEED,
) -> DataFrame:
    """The ``keep`` columns of each row of ``docs(doc_id, text, source)`` with ``size``, its source's
    ``source_size`` and ``target``, and ``copies``, how often the mix takes it.

    Only the columns in ``keep`` travel. A null text has size 0; a null source is a source
    of its own, the last; a source without words has target 0 and no copies. Rows that repeat
    count each, and those equal in source, size, id and text may change places without
    changing the plan. An empty table gives no rows. ``keep`` must not name the four new columns.
    """
    clash = {"size", "source_size", "target", "copies"} & set(keep)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are made here; rename yours")
    rows = docs.select(
        F.struct(*keep).alias("_kept"),
        word_count(F.col("text")).alias("size"),
        F.coalesce(F.concat(F.lit("0"), F.col("source")), F.lit("1")).alias("source_key"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("_tie"),
        F.xxhash64("text").alias("_text"),
        # Rows equal in all else may change places, but a range must be able to part them.
        F.monotonically_increasing_id().alias("_row"),
    )
    within = ["size", "_tie", "_text", "_row"]
    dealt = ranged(rows, ["source_key", *within], "mix")
    sizes = dealt.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    rated = targets(sizes, weights, most).withColumn(
        "_expected",
        F.when(F.col("source_size") > 0, F.round(F.col("target") / F.col("source_size") * ONE))
        .otherwise(0)
        .cast("bigint"),
    )
    taken = {name: name for name in ("source_size", "target", "_expected")}
    shared = lookup(dealt, rated, {"source_key": "source_key"}, taken)
    summed = running_sums(
        shared, "source_key", within, {"_before": F.col("_expected")}, ONE
    )
    drawn = F.md5(F.concat(F.lit(f"{seed}/"), F.col("source_key")).cast("binary"))
    offset = F.conv(F.substring(drawn, 1, 7), 16, 10).cast("bigint") * (ONE >> 28)
    passed = F.pmod(F.col("_before") + offset, F.lit(ONE)) + F.col("_expected")
    return summed.select(
        "_kept.*", "size", "source_size", "target", F.shiftright(passed, BITS).alias("copies")
    )


def mixed(plan: DataFrame) -> DataFrame:
    """The rows of a plan, each as often as the mix takes it."""
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))
    return plan.where("copies > 0").select(*plan.columns, copies.alias("_copy")).drop("_copy")
