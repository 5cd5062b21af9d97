"""Sharding by a permutation-filled lookup table.

The table has a prime number of slots, about ``SLOTS`` per shard. Each shard's name fixes an order of
preference over all slots (an offset and a step); the shards take turns, each claiming its next slot
that is still free. All get equally many slots but for one, and when a shard comes or goes most slots
keep their owner. A row goes to the owner of the slot that the hash of its key names: a join with a
broadcast table of at most ``SLOTS * 2`` rows per shard, so its size depends on the shards only.

Edge cases: a null key has the hash of the empty text; rows of one key share a shard, as they must;
columns named slot or shard are replaced. ``write_shards`` salts by row, so that a key with a third
of all rows is still written by many tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

SLOTS = 100


def number_of(text: str) -> int:
    """60 bits of the MD5 hash, the same in Python and in SQL."""
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def prime_from(n: int) -> int:
    n = max(n, 2)
    while any(n % d == 0 for d in range(2, int(n ** 0.5) + 1)):
        n += 1
    return n


def lookup_table(shards: Sequence[str], slots: int | None = None) -> list[int]:
    """Owner (index in ``shards``) of every slot. Names must differ."""
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards need names that differ")
    size = prime_from(slots or SLOTS * len(shards))
    if size < len(shards):
        raise ValueError("fewer slots than shards")
    spot = [number_of(f"{name}:offset") % size for name in shards]
    step = [number_of(f"{name}:step") % (size - 1) + 1 for name in shards]
    owner, free = [-1] * size, size
    while free:
        for shard in range(len(shards)):
            while owner[spot[shard]] >= 0:
                spot[shard] = (spot[shard] + step[shard]) % size
            owner[spot[shard]] = shard
            free -= 1
            if not free:
                break
    return owner


def slot_of(key: Column, size: int) -> Column:
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.pmod(F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint"),
                  F.lit(size))


def place(rows: DataFrame, shards: Sequence[str], key: str = "doc_id",
          slots: int | None = None) -> DataFrame:
    """Add ``slot`` and ``shard`` (its name) to every row."""
    owner = lookup_table(shards, slots)
    table = rows.sparkSession.createDataFrame(
        [(slot, shards[shard]) for slot, shard in enumerate(owner)], "_slot bigint, shard string")
    placed = rows.drop("slot", "shard").withColumn("slot", slot_of(F.col(key), len(owner)))
    return placed.join(F.broadcast(table), F.col("slot") == F.col("_slot")).drop("_slot")


def write_shards(rows: DataFrame, path: str, shards: Sequence[str], key: str = "doc_id",
                 files: int = 8) -> None:
    """One folder per shard, each written by ``files`` tasks whatever the keys."""
    placed = place(rows, shards, key)
    salt = F.pmod(F.xxhash64(*placed.columns), F.lit(files))
    placed.repartition(len(shards) * files, "shard", salt).write.partitionBy("shard").parquet(path)


def read_shards(like: DataFrame, path: str) -> DataFrame:
    """What ``write_shards`` wrote of rows ``like`` these.

    The schema is given, not guessed: shards without rows and names such as "01" stay what they are.
    """
    fields = [f for f in like.schema.fields if f.name not in ("slot", "shard")]
    schema = T.StructType([*fields, T.StructField("slot", T.LongType()),
                           T.StructField("shard", T.StringType())])
    return like.sparkSession.read.schema(schema).parquet(path)
