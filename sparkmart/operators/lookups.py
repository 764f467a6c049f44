"""Left outer lookup of a dimension, whatever its size and however skewed the keys.

The dimension is measured first. Within the bound it is broadcast, and the fact
rows are not shuffled at all. Beyond it both sides are shuffled on the key, and
the keys that hold more fact rows or bytes than one task should are spread over several
slots, with the dimension's rows of just these keys repeated once per slot.
Either way gives the same rows.

A dimension beyond the bound is never broadcast, by Spark's own choice either. Beyond the
bound heavy keys are found by a sketch in a pass of its own: rows and bytes are summed by cells of the
key's hash, each task for itself and then all together, so what is shuffled are cells and not
keys. A heavy key makes its cell heavy. Only the keys of heavy cells, if there are any, are then counted
one by one. Write a fact that is costly to compute to a table before.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.sources.tables import write_parquet
from sparkmart.workspace import fresh_folder

BROADCAST_BYTES = 128 * 1024 * 1024
ROWS_PER_TASK = 5_000_000
TASK_BYTES = 256 * 1024 * 1024
# Two numbers are broadcast per hot key: some tens of megabytes at most.
MAX_HOT_KEYS = 500_000
# Cells of the sketch. At this number a fact of 100 TB has cells of 100 MB on average.
CELLS = 1 << 20

_ROW_OVERHEAD = 64
_FIXED_WIDTH = 16


class DuplicateKeyError(ValueError):
    """A table that must hold each key once holds one several times."""


def _named(name: str) -> Column:
    return F.col(f"`{name}`")


_HASHED = (T.StringType, T.BinaryType, T.BooleanType, T.NumericType, T.DatetimeType)


def _hashable(df: DataFrame) -> list[str]:
    """The columns of types that have a hash; maps and variants, alone or nested, have none."""

    def has_hash(field: T.StructField) -> bool:
        if isinstance(field.dataType, _HASHED):
            return True
        try:
            df.select(F.xxhash64(_named(field.name)))
        except AnalysisException:
            return False
        return True

    return [field.name for field in df.schema.fields if has_hash(field)]


def row_bytes(df: DataFrame) -> Column:
    """A row's size in memory, rounded up."""
    sizes = [str(_ROW_OVERHEAD + _FIXED_WIDTH * len(df.schema.fields))]
    for field in df.schema.fields:
        column = f"`{field.name}`"
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            column = f"to_json(struct({column}))"
        elif not isinstance(field.dataType, (T.StringType, T.BinaryType)):
            continue
        sizes.append(f"coalesce(octet_length({column}), 0)")
    return F.expr(f"cast({' + '.join(sizes)} as bigint)")


def _measure(df: DataFrame, key_names: Sequence[str], unique: bool) -> int:
    """Bytes of all rows, by one aggregate over them that may check the keys too."""
    if not unique:
        return df.agg(F.sum(row_bytes(df)).alias("bytes")).first()["bytes"] or 0
    named = F.struct(*key_names)
    complete = F.concat(*[F.col(name).cast("string") for name in key_names]).isNotNull()
    per_key = df.groupBy(*key_names).agg(
        F.sum(row_bytes(df)).alias("bytes"), F.count("*").alias("rows")
    )
    measured = per_key.agg(
        F.sum("bytes").alias("bytes"),
        F.max(F.when(complete & (F.col("rows") > 1), named)).alias("doubled"),
    ).first()
    if measured["doubled"] is not None:
        raise DuplicateKeyError(f"key occurs more than once: {tuple(measured['doubled'])}")
    return measured["bytes"] or 0


def measured_bytes(df: DataFrame) -> int:
    """Bytes that all rows take in memory, rounded up, by one aggregate over them."""
    return _measure(df, [], unique=False)


def lookup(
    fact: DataFrame,
    dimension: DataFrame,
    keys: Mapping[str, str],
    take: Mapping[str, str],
    *,
    normalise: Callable[[Column], Column] = lambda key: key,
    unique: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_task: int | None = ROWS_PER_TASK,
    task_bytes: int = TASK_BYTES,
    dimension_bytes: int | None = None,
) -> DataFrame:
    """All columns of ``fact`` plus columns of the matching dimension row.

    ``keys`` maps fact columns to dimension columns, ``take`` maps new column
    names to dimension columns, and ``normalise`` is put on both key sides. A fact
    row without a match gets NULLs, one with several matches is repeated; with
    ``unique`` a dimension that holds a key twice is refused. Keys with more than
    ``rows_per_task`` fact rows or ``task_bytes`` bytes of them are spread; without a number of rows
    the caller tells that the fact has no such key. Columns may be of any type.
    A caller that has measured the dimension gives its ``dimension_bytes``, and it is not
    measured again.
    """
    key_names = [f"_key_{i}" for i in range(len(keys))]
    left = fact.select(
        "*", *[normalise(_named(c)).alias(k) for c, k in zip(keys, key_names)]
    )
    right = dimension.select(
        *[normalise(_named(c)).alias(k) for c, k in zip(keys.values(), key_names)],
        *[_named(source).alias(name) for name, source in take.items()],
    )
    if dimension_bytes is None or unique:
        dimension_bytes = _measure(right, key_names, unique)
    if dimension_bytes <= broadcast_bytes:
        joined = left.join(F.broadcast(right), key_names, "left")
    elif rows_per_task is None:
        joined = left.join(right.hint("merge"), key_names, "left")
    else:
        joined = _spread_join(left, right, key_names, rows_per_task, task_bytes=task_bytes)
    return joined.select(*[_named(name) for name in [*fact.columns, *take]])


def _hot_keys(
    left: DataFrame,
    key_names: list[str],
    rows_per_task: int,
    task_bytes: int = TASK_BYTES,
    cells: int = CELLS,
) -> DataFrame:
    """(key hash, slots) of the keys with more rows or bytes than one task should get.

    Written to a small table, since both sides of the join read it. It has fewer rows than the fact
    has multiples of ``rows_per_task`` and ``task_bytes``.
    """
    spark = left.sparkSession
    weighed = left.select(
        F.xxhash64(*key_names).alias("_key_hash"), row_bytes(left).alias("_bytes")
    ).withColumn("_cell", F.pmod("_key_hash", F.lit(cells)).cast("int"))
    heavy = (F.col("_rows") > rows_per_task) | (F.col("_bytes") > task_bytes)

    def summed(df: DataFrame, by: str) -> DataFrame:
        return df.groupBy(by).agg(F.count("*").alias("_rows"), F.sum("_bytes").alias("_bytes")).where(heavy)

    sketch = write_parquet(summed(weighed, "_cell").select("_cell"), fresh_folder(spark, "hot_cells"))
    if sketch.isEmpty():
        return spark.createDataFrame([], "_key_hash bigint, _slots bigint")
    # One number per cell is broadcast: some megabytes at most.
    suspects = weighed.join(F.broadcast(sketch), "_cell", "left_semi")
    slots = F.greatest(
        F.ceil(F.col("_rows") / rows_per_task), F.ceil(F.col("_bytes") / task_bytes)
    )
    hot = summed(suspects, "_key_hash").select("_key_hash", slots.alias("_slots"))
    return write_parquet(hot, fresh_folder(spark, "hot_keys"))


def _spread_join(
    left: DataFrame,
    right: DataFrame,
    key_names: list[str],
    rows_per_task: int,
    max_hot_keys: int = MAX_HOT_KEYS,
    task_bytes: int = TASK_BYTES,
) -> DataFrame:
    slots = _hot_keys(left, key_names, rows_per_task, task_bytes)
    hot = slots.count()
    if hot == 0:
        return left.join(right.hint("merge"), key_names, "left")
    if hot > max_hot_keys:
        # Fewer than this many keys can hold more than an equal share of the slots. The
        # others are left whole: each is a tiny share of the fact.
        share = slots.agg(F.sum("_slots")).first()[0] / max_hot_keys
        slots = slots.where(F.col("_slots") > share)
    slots = F.broadcast(slots)

    def with_slots(df: DataFrame) -> DataFrame:
        hashed = df.withColumn("_key_hash", F.xxhash64(*key_names))
        return hashed.join(slots, "_key_hash", "left").drop("_key_hash")

    # A row's slot follows from its content and partition, so a task that runs
    # again after a lost executor puts the row into the same slot.
    # Rows spread by the columns that have a hash.
    row_hash = F.xxhash64(F.spark_partition_id(), *map(_named, _hashable(left)))
    spread = with_slots(left).withColumn(
        "_slot",
        F.when(F.col("_slots").isNotNull(), F.pmod(row_hash, F.col("_slots"))).otherwise(0),
    )
    repeated = with_slots(right).withColumn(
        "_slot",
        F.explode(
            F.sequence(F.lit(0).cast("bigint"), F.coalesce("_slots", F.lit(1)) - 1)
        ),
    )
    return spread.drop("_slots").join(
        repeated.drop("_slots").hint("merge"), [*key_names, "_slot"], "left"
    )
