"""A keyed registry table: validation, insert-if-absent, partial updates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.operators.lookups import DuplicateKeyError, lookup, measured_bytes, row_bytes
from sparkmart.sources.documents import FLAGS
from sparkmart.sources.tables import write_parquet
from sparkmart.workspace import fresh_folder

# Patterns and length bounds of a record's fields.
NAME_PATTERN = r"^[a-z0-9_]+\z"
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}\z"
DESCRIPTION_LENGTH = (10, 200)

COPIES_PER_TASK = 100_000


def record_rules() -> dict[str, Column]:
    """Reason for rejection -> the condition a good record meets."""
    return {
        "domain": F.col("domain").rlike(NAME_PATTERN),
        "name": F.col("name").rlike(NAME_PATTERN),
        "description": F.length("description").between(*DESCRIPTION_LENGTH),
        "admin_emails_empty": F.size("admin_emails") >= 1,
        "admin_emails": F.forall("admin_emails", lambda email: email.rlike(EMAIL_PATTERN)),
    }


def with_reasons(df: DataFrame, rules: Mapping[str, Column] | None = None) -> DataFrame:
    """Rows with an array ``reasons`` of the conditions they fail; none for a good row.

    A condition that comes out NULL is not met.
    """
    rules = record_rules() if rules is None else rules
    failed = [
        F.when(~F.coalesce(condition, F.lit(False)), F.lit(reason))
        for reason, condition in rules.items()
    ]
    # Drops the NULLs inside generated code, which array_compact would leave.
    nothing = F.array(F.lit(None).cast("string"))
    return df.withColumn("reasons", F.array_except(F.array(*failed), nothing))


def validate(
    df: DataFrame, rules: Mapping[str, Column] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Split rows into good ones and rejected ones with their ``reasons``.

    The good rows are plain filters, one per condition, so a condition on a stored
    column reaches the scan.
    """
    rules = record_rules() if rules is None else rules
    valid = df
    for condition in rules.values():
        valid = valid.where(condition)
    return valid, with_reasons(df, rules).where(F.size("reasons") > 0)


def new_records(df: DataFrame, flags: Sequence[str] = FLAGS) -> DataFrame:
    """Records as first inserted: flags that are missing or NULL become false."""
    present = set(df.columns)
    return df.withColumns(
        {
            flag: F.coalesce(F.col(flag), F.lit(False)) if flag in present else F.lit(False)
            for flag in flags
        }
    )


def _digest(columns: Sequence[str]) -> Column:
    """120 bits of a row's sha256 as a whole number, which a hash aggregate can keep the least of.

    Text tells -0.0 from 0.0 and has an order for maps too.
    """
    text = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    hexes = F.sha2(text, 256)
    high, low = [
        F.conv(F.substring(hexes, start, 15), 16, 10).cast("decimal(19,0)") for start in (1, 16)
    ]
    return (high * F.lit(1 << 60).cast("decimal(19,0)") + low).cast("decimal(38,0)")


def _one_of_equals(rows: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """One row per key, where all rows of a key are equal: their commonest value, which hash
    aggregates find for rows with any columns and without changing them."""
    return rows.groupBy(F.col(key).alias("_equals")).agg(F.mode(F.struct(*columns)).alias("_row")).select(
        *[F.col(f"_row.`{name}`").alias(name) for name in columns]
    )


def _repeated(counted: DataFrame, columns: Sequence[str], copies_per_task: int) -> DataFrame:
    """Each row as often as its ``_copies`` says.

    A count too large for one task to write out is cut into pieces that are spread first.
    """
    few = counted.where(F.col("_copies").between(1, copies_per_task))
    pieces = (
        counted.where(F.col("_copies") > copies_per_task)
        .withColumn(
            "_start",
            F.explode(F.sequence(F.lit(0), F.col("_copies") - 1, F.lit(copies_per_task))),
        )
        .repartition("_digest", "_start")
        .withColumn("_copies", F.least(F.col("_copies") - F.col("_start"), F.lit(copies_per_task)))
        .drop("_start")
    )
    return (
        few.unionByName(pieces)
        .select(*columns, F.explode(F.sequence(F.lit(1), "_copies")).alias("_copy"))
        .drop("_copy")
    )


def insert_absent(
    base: DataFrame,
    new: DataFrame,
    key: str,
    arrival: Sequence[str],
    copies_per_task: int = COPIES_PER_TASK,
) -> tuple[DataFrame, DataFrame]:
    """Split ``new`` into the rows to insert and the refused ones.

    A row is refused when its key is NULL, is in ``base`` or came earlier in the batch, by
    the ``arrival`` columns (NULL comes first); of several that arrive together one is taken
    by its content. Of the base only the keys are read. The two results together are all rows
    of ``new``, unchanged; columns may be of any type.

    The first arrival per key is a minimum, so a hot key shrinks to one row per task before the
    shuffle. It is brought back to the batch by ``lookup``, and only rows that arrive with their
    key's first are compared as a whole, by counted digests. Whole rows are not aggregated, but for
    copies of an accepted row. The first arrivals are measured when this is called.
    """
    columns = list(new.columns)
    unknown = base.select(key).where(F.col(key).isNotNull())
    if len(arrival) == 1:
        # Two flat minima keep the aggregate on hash maps; a struct would sort the batch.
        place = F.col(arrival[0])
        first = [F.min(place).alias("_first"), F.max(place.isNull()).alias("_no_place")]
        same = F.when(F.col("_no_place"), place.isNull()).otherwise(place == F.col("_first"))
    else:
        place = F.struct(*arrival)
        first = [F.min(place).alias("_first"), F.lit(False).alias("_no_place")]
        same = place.eqNullSafe(F.col("_first"))
    firsts = (
        new.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(*first)
        .join(unknown, key, "left_anti")
        .withColumn("_open", F.lit(True))
    )
    size = measured_bytes(firsts)
    taken = {name: name for name in ("_first", "_no_place", "_open")}
    # The digest is only made of rows that arrive with their key's first.
    early = (
        lookup(new, firsts, {key: key}, taken, dimension_bytes=size)
        .where(F.col("_open") & same)
        .select(key, "_first", "_no_place", _digest(columns).alias("_digest"))
    )
    copies = early.groupBy(key, "_first", "_no_place", "_digest").agg(F.count("*").alias("_copies"))
    # Numbers only, so all of it is hash aggregates; the row itself comes back by the lookup.
    chosen = copies.groupBy(key, "_first", "_no_place").agg(
        F.min("_digest").alias("_chosen"), F.min_by("_copies", "_digest").alias("_copies")
    )
    taken = {name: name for name in ("_first", "_no_place", "_chosen", "_copies")}
    # It has no more rows than the first arrivals, whose rows count as 128 bytes or more
    # each; two numbers add less than that.
    marked = lookup(new, chosen, {key: key}, taken, dimension_bytes=2 * size)
    is_chosen = F.col("_chosen").isNotNull() & same & (_digest(columns) == F.col("_chosen"))
    # One condition on both sides of the join, so that all branches read one broadcast.
    marked = marked.withColumn("_equal", F.coalesce(is_chosen, F.lit(False)))
    best = _one_of_equals(marked.where("_equal"), key, [*columns, "_copies", "_chosen"])
    refused = marked.where("not _equal").select(*columns)
    further = best.withColumn("_copies", F.col("_copies") - 1).withColumnRenamed("_chosen", "_digest")
    return (
        best.select(*columns),
        refused.unionByName(_repeated(further, columns, copies_per_task)),
    )


def update_columns(
    base: DataFrame,
    updates: DataFrame,
    key: str,
    columns: Sequence[str],
    order: Sequence[str] = (),
    named: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Overwrite ``columns`` of the rows that ``updates`` names.

    Gives the updated base and the updates with an unknown key. An explicit NULL
    overwrites. Of several updates for a key the last by ``order`` counts; without
    an order each key may come once, or ``DuplicateKeyError`` is raised. Few updates are
    broadcast, and the base is then not shuffled.

    With ``named``, an array column of ``updates``, each update sets only the columns that its
    array lists (a NULL array none), and the last update that names a column sets it.
    """
    missing = [c for c in columns if c not in base.columns or c not in updates.columns]
    if missing:
        raise ValueError(f"columns to update are not in both tables: {missing}")
    if not order:
        doubled = updates.groupBy(key).count().where(f"`{key}` is not null and count > 1").first()
        if doubled:
            raise DuplicateKeyError(f"several updates without an order for key {doubled[0]!r}")
    if named is None:
        groups = {"_new": columns}
        last, size = _last_updates(updates, key, columns, order)
    else:
        size = None
        groups = {f"_new_{i}": [c] for i, c in enumerate(columns)}
        places = [F.col(c).alias(f"_place_{i}") for i, c in enumerate(order)]
        last = updates.groupBy(key).agg(
            *[
                F.max(F.when(F.array_contains(named, c), F.struct(*places, c))).alias(group)
                for group, (c,) in groups.items()
            ]
        )
    # The base holds each key once, so no key of it need be spread.
    matched = lookup(
        base, last, {key: key}, {g: g for g in groups}, rows_per_task=None, dimension_bytes=size
    )
    group_of = {c: g for g, group in groups.items() for c in group}
    updated = matched.select(
        *[
            F.when(F.col(group_of[c]).isNotNull(), F.col(f"{group_of[c]}.{c}"))
            .otherwise(F.col(c))
            .alias(c)
            if c in columns
            else F.col(c)
            for c in base.columns
        ]
    )
    # An anti join keeps NULL keys, and Spark splits a skewed side of it at run time.
    unknown = updates.join(base.select(key), key, "left_anti").select(*updates.columns)
    return updated, unknown


def _last_updates(
    updates: DataFrame, key: str, columns: Sequence[str], order: Sequence[str]
) -> tuple[DataFrame, int | None]:
    """(key, _new), the ``columns`` of each key's last update as a struct, and their bytes if known.

    Of several in the last place the one with the greatest digest counts. The place, the digest
    and the size of the last update are numbers, kept by hash aggregates and measured in one pass;
    the row itself comes back by a lookup. A place that is NULL comes first.
    """
    new = F.struct(*columns).alias("_new")
    found = updates.where(F.col(key).isNotNull())
    if not order:
        return found.select(key, new), None
    for place in order[:-1]:
        # One column of the order after the other.
        last = found.groupBy(key).agg(F.max(place).alias("_last"))
        found = lookup(found, last, {key: key}, {"_last": "_last"}).where(
            F.col(place).eqNullSafe(F.col("_last"))
        ).drop("_last")
    place = F.col(order[-1]).alias("_place")
    carried = [c for c in columns if c != key]
    found = found.select(key, place, *carried, _digest(columns).alias("_digest"))
    places = found.groupBy(key, "_place").agg(
        F.max("_digest").alias("_digest"),
        F.count("*").alias("_ties"),
        F.max(row_bytes(found)).alias("_bytes"),
    )

    def at_last(name: str) -> Column:
        return F.coalesce(F.max_by(name, "_place"), F.max(name)).alias(f"_last{name}")

    # Read twice below, and by each reader of the result.
    last = write_parquet(
        places.groupBy(key).agg(
            F.max("_place").alias("_last_place"), *map(at_last, ("_digest", "_ties", "_bytes"))
        ),
        fresh_folder(updates.sparkSession, "last_updates"),
    )
    measured = last.agg(F.sum("_last_bytes").alias("bytes"), F.max("_last_ties").alias("ties")).first()
    size = measured["bytes"] or 0
    taken = {name: name for name in ("_last_place", "_last_digest")}
    marked = lookup(found, last, {key: key}, taken, dimension_bytes=size).where(
        F.col("_place").eqNullSafe(F.col("_last_place")) & (F.col("_digest") == F.col("_last_digest"))
    )
    if (measured["ties"] or 0) > 1:
        marked = _one_of_equals(marked, key, [key, *carried])
    return marked.select(key, new), size


def list_keys(base: DataFrame, key: str = "name") -> DataFrame:
    """The keys of all records."""
    return base.select(key)
