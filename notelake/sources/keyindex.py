"""Bloom filters of the keys in stored batches: which batches may hold a key, without reading them.

A filter has ``BITS_PER_KEY`` bits for every key of its batch, in blocks of 32,768 bits; a key belongs to
one block and sets ``HASHES`` bits in it. A key that is not in a batch passes its filter about once in a
million times, so a batch of new keys reads almost no stored rows. Filters are DataFrame aggregates
(one bitmap per block, combined before the shuffle) and are stored in a folder of their own per batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BITS_PER_KEY, HASHES = 32, 12
# Fixed value: the bits of a bitmap of Spark's bitmap functions.
BLOCK_BITS = 32_768
FILTERS = "batch string, blocks int, block int, bits binary"


def _block(key: Column, blocks: Column | int) -> Column:
    return F.pmod(F.xxhash64(F.lit(0), key), F.lit(blocks) if isinstance(blocks, int) else blocks
                  ).cast("int")


def _positions(key: Column) -> Column:
    return F.array(*[F.pmod(F.xxhash64(F.lit(i), key), F.lit(BLOCK_BITS)) for i in range(1, HASHES + 1)])


def build_filter(keys: DataFrame, key: str) -> DataFrame:
    """(blocks, block, bits) of the distinct values of ``key``; one count, then one aggregate."""
    n = keys.agg(F.count(key)).first()[0]
    blocks = max(1, -(-n * BITS_PER_KEY // BLOCK_BITS))
    bits = keys.where(F.col(key).isNotNull()).select(
        _block(F.col(key), blocks).alias("block"), F.explode(_positions(F.col(key))).alias("position"))
    return bits.groupBy("block").agg(F.bitmap_construct_agg("position").alias("bits")).select(
        F.lit(blocks).alias("blocks"), "block", "bits")


def _is_set(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (position / 8).cast("int") + 1, F.lit(1))), 16, 10)
    return F.getbit(byte.cast("bigint"), (position % 8).cast("int")) == 1


def may_hold(keys: DataFrame, filters: DataFrame, key: str) -> DataFrame:
    """(key, batch): the batches whose filter a key passes. ``filters``: see ``FILTERS``.

    Every key meets one block of each batch; batches are few, since small ones are merged.
    """
    batches = filters.select("batch", "blocks").distinct()
    sizes = batches.agg(F.collect_list(F.struct("batch", "blocks"))).first()[0]
    if not sizes:
        return keys.select(key, F.lit("").alias("batch")).where("false")
    listed = F.array(*[F.struct(F.lit(r["batch"]).alias("batch"), F.lit(r["blocks"]).alias("blocks"))
                       for r in sizes])
    asked = keys.where(F.col(key).isNotNull()).select(key, F.explode(listed).alias("of")).select(
        key, "of.batch", _block(F.col(key), F.col("of.blocks")).alias("block"))
    return asked.join(filters.drop("blocks"), ["batch", "block"]).where(F.forall(
        _positions(F.col(key)), lambda p: _is_set(F.col("bits"), p))).select(key, "batch")


def write_filter(keys: DataFrame, key: str, folder: str) -> None:
    build_filter(keys, key).write.mode("overwrite").parquet(folder)


def stored_filters(spark: SparkSession, folders: dict[str, str]) -> DataFrame:
    """The filters of batches (name -> folder)."""
    found = spark.createDataFrame([], FILTERS)
    for name, folder in sorted(folders.items()):
        rows = spark.read.schema("blocks int, block int, bits binary").parquet(folder)
        found = found.unionByName(rows.withColumn("batch", F.lit(name)))
    return found
