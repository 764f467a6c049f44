"""Sharding by a permutation-filled lookup table (Maglev hashing).

Every shard walks through its own permutation of the slots of a prime-sized table. The shards take
turns, and at its turn a shard claims the first slot in its order that is still free, until no slot
is. Shards so get equally many slots (give or take one), and adding or removing a shard moves
little else. The table depends on the shard names and its size only, never on the data; a row
finds its shard by one hash and one look-up in the broadcast table.
"""

from __future__ import annotations

from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.llm.common import free_name
from sparkmart.workspace import fresh_folder

SHARDS = tuple(f"shard-{number:02d}" for number in range(32))
SLOTS = 4093
MOST_SLOTS = 1 << 20


def _number(text: str) -> int:
    return int(md5(text.encode()).hexdigest()[:15], 16)


def fill(shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> list[int]:
    """For each slot the place of its shard in ``shards``."""
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards must be named, each by a name of its own")
    if slots > MOST_SLOTS or slots < len(shards) or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError(f"slots must be a prime from the number of shards to {MOST_SLOTS}")
    start = [_number(f"{shard}/offset") % slots for shard in shards]
    skip = [_number(f"{shard}/skip") % (slots - 1) + 1 for shard in shards]
    owner = [-1] * slots
    for turn in range(slots):
        shard = turn % len(shards)
        while owner[start[shard]] >= 0:
            start[shard] = (start[shard] + skip[shard]) % slots
        owner[start[shard]] = shard
    return owner


def lookup_table(
    spark: SparkSession, shards: tuple[str, ...] = SHARDS, slots: int = SLOTS
) -> DataFrame:
    """(slot, shard), a row per slot, as SQL over one text literal."""
    owners = F.split(F.lit(",".join(map(str, fill(shards, slots)))), ",")
    names = F.array(*(F.lit(shard) for shard in shards))
    return (
        spark.range(1)
        .select(F.posexplode(owners).alias("slot", "owner"))
        .select("slot", F.element_at(names, F.col("owner").cast("int") + 1).alias("shard"))
    )


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """A key's slot; a null key counts as the empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint") % slots).cast("int")


def place(
    df: DataFrame, key: str, shards: tuple[str, ...] = SHARDS, slots: int = SLOTS
) -> DataFrame:
    """All rows and columns of ``df`` with ``shard_slot`` and ``shard``.

    Equal keys share a shard, whatever their number; a null key counts as the empty text; repeated
    rows stay; no rows give none. ``df`` is not shuffled. The table has ``slots`` rows (a parameter of at
    most a million), which bounds its broadcast. Where ``df`` has columns of the two names, they
    stay, and the new ones are ``shard_1`` and ``shard_slot_1`` or the next names that are free.
    """
    slot, shard = _names(df)
    found = lookup_table(df.sparkSession, shards, slots).withColumnsRenamed(
        {"slot": slot, "shard": shard}
    )
    return (
        df.withColumn(slot, slot_of(F.col(key), slots))
        .join(F.broadcast(found), slot)
        .select(*df.columns, slot, shard)
    )


def _names(df: DataFrame) -> tuple[str, str]:
    return free_name(df, "shard_slot"), free_name(df, "shard")


def write_shards(
    df: DataFrame, key: str, shards: tuple[str, ...] = SHARDS, slots: int = SLOTS
) -> DataFrame:
    """The rows of ``place``, all columns, written to a folder per shard and read back.

    Each task writes its own rows of a shard to a file, so ``df`` is not shuffled and equal keys
    do not meet in one task. Null, empty and very long texts are rows like others, and so are those
    of a null key. Shard names must not be empty.
    """
    placed = place(df, key, shards, slots)
    path = fresh_folder(df.sparkSession, "llm/shards")
    placed.write.partitionBy(_names(df)[1]).parquet(path)
    return df.sparkSession.read.schema(placed.schema).parquet(path).select(*placed.columns)
