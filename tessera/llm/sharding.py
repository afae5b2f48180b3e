"""Sharding by a permutation-filled lookup table.

Every shard has an own permutation of the slots of a table of prime size
(``offset + j * skip``); the shards take turns, each claiming the first slot of its
permutation that is still free, until the table is full. A key hashes to a slot and
the slot names the shard. Shards get almost equal numbers of slots, and when a shard
joins or leaves few of the other slots change hands.

The table has ``slots`` entries whatever the data's size, so filling it on the driver
and broadcasting it are bounded by a parameter.

Edge cases: a null key is placed as the empty string; repeated keys share a shard; an
empty table gives an empty result; ``slot`` and ``shard`` replace columns of those names.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import fresh

SLOTS = 65_537
SHARDS = 64


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n ** 0.5) + 1))


def fill_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """Index into ``shards`` for each slot. ``slots`` has to be prime, so that every
    ``skip`` gives a permutation of all of them."""
    if not _is_prime(slots):
        raise ValueError("slots must be a prime number")
    if not 0 < len(set(shards)) == len(shards) <= slots:
        raise ValueError("shards must be distinct, at least one and at most as many as slots")
    at, skip = [], []
    for s in shards:
        d = hashlib.md5(s.encode()).digest()
        at.append(int.from_bytes(d[:8], "big") % slots)
        skip.append(int.from_bytes(d[8:], "big") % (slots - 1) + 1 if slots > 2 else 1)
    owner = [-1] * slots
    for turn in range(slots):
        i = turn % len(shards)
        while owner[at[i]] >= 0:
            at[i] = (at[i] + skip[i]) % slots
        owner[at[i]] = i
    return owner


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The first 60 bits of the key's MD5, modulo the table size."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return (F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % slots).cast("int")


def place(df: DataFrame, key: str, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """``df`` with ``slot`` (int) and ``shard`` (string): one lookup in the broadcast
    table for each row, no shuffle."""
    names = ",".join(f'"{shards[i]}"' for i in fill_table(shards, slots))
    at, owner = fresh("_at", df), fresh("_owner", df)
    lookup = df.sparkSession.range(slots).select(
        F.col("id").cast("int").alias(at),
        F.get(F.from_json(F.lit(f"[{names}]"), "array<string>"), F.col("id").cast("int")).alias(owner))
    placed = df.withColumn("slot", slot_of(F.col(key), slots))
    return (placed.join(F.broadcast(lookup), F.col("slot") == F.col(at))
            .withColumn("shard", F.col(owner)).drop(at, owner))


def write_shards(df: DataFrame, key: str, shards: list[str], path: str, slots: int = SLOTS,
                 files_per_shard: int = 4) -> None:
    """Write ``df`` as Parquet, one folder for each shard. Rows are dealt out by shard
    and by a salt of the whole row, so that a shard with a hot key, or one key with a
    third of all rows, is written by ``files_per_shard`` tasks."""
    placed = place(df, key, shards, slots)
    salt = fresh("_salt", placed)
    (placed.withColumn(salt, F.pmod(F.xxhash64(*df.columns), F.lit(files_per_shard)))
     .repartition(len(shards) * files_per_shard, "shard", salt).drop(salt)
     .write.partitionBy("shard").parquet(path))
