"""Connected components of links between keys, by alternating stars; nothing leaves the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from notelake.session import fresh_path


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it: a lost executor repeats one step only."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def large_star(links: DataFrame) -> DataFrame:
    """Hang the larger neighbours of each key under the smallest of its neighbours and itself."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(
        "a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(
        F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def small_star(links: DataFrame) -> DataFrame:
    """Hang each key and its smaller neighbours under the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(
        F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(key, component) for every key of ``links`` (a, b); the component is its smallest key."""
    links = stored(links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    while True:
        summary = links.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a")))
        now = tuple(summary.first())
        if now == state:
            break
        state = now
        links = stored(small_star(stored(large_star(links), "links")), "links")
    under = links.select(F.col("a").alias("key"), F.col("b").alias("component"))
    tops = links.select(F.col("b").alias("key"), F.col("b").alias("component")).distinct()
    return under.unionByName(tops)
