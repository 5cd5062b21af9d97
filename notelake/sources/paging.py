"""Hits numbered and stored once for paging: a page reads the files that hold its rows.

``write_paged`` sorts the hits by id and gives every row its ``position``. Rows lie in folders of
``ROWS_PER_CHUNK`` consecutive positions, in files sorted by position, so a position is found by a
division (which folder) and the statistics of the files (which part of it): an order-statistic index
that costs one column. A page is a condition on ``chunk`` and ``position``; it sorts nothing but its own
rows. New hits, whose ids follow the stored ones, are appended with the positions that follow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from notelake.operators.ordering import global_index

ROWS_PER_CHUNK = 1 << 20
# So many folders a table has at most when ``rows_per_folder`` sizes them: every read lists them all.
MOST_CHUNKS = 1 << 10
# Texts of a hit that a page shows, "" where they are missing.
PAGE_TEXTS = ("repo_name", "file_url", "keyword")
STORED = "id long, repo_name string, file_url string, keyword string, position long, chunk long"


def rows_per_folder(rows: int, least: int = ROWS_PER_CHUNK) -> int:
    """``least``, or as many more as keep a table of ``rows`` within ``MOST_CHUNKS`` folders."""
    return max(least, -(-rows // MOST_CHUNKS))


def page_columns(rows: DataFrame) -> DataFrame:
    """The columns of a page; rows without a link are dropped after paging."""
    return rows.select("id", *[F.coalesce(t, F.lit("")).alias(t) for t in PAGE_TEXTS]).where(
        "file_url != ''")


def _store(hits: DataFrame, path: str, start: int, mode: str, rows_per_chunk: int) -> None:
    order = [F.col("id"), F.col("file_url")]
    placed = global_index(hits.select(F.col("id").cast("long"), *PAGE_TEXTS), order, "position").withColumn(
        "position", F.col("position") + start)
    chunk = F.expr(f"position div {rows_per_chunk}")
    # The ranges of the sort are written as they are: consecutive positions, few folders per task.
    placed.withColumn("chunk", chunk).sortWithinPartitions("chunk", "position").write.mode(
        mode).partitionBy("chunk").parquet(path)


def write_paged(hits: DataFrame, path: str, rows_per_chunk: int = ROWS_PER_CHUNK,
                mode: str = "errorifexists") -> None:
    _store(hits, path, 0, mode, rows_per_chunk)


def stored_rows(spark: SparkSession, path: str) -> tuple[int, int | None]:
    """(rows, largest id) of a stored table, read from its last chunk."""
    table = spark.read.schema(STORED).parquet(path)
    newest = table.agg(F.max("chunk")).first()[0]
    if newest is None:
        return 0, None
    last = table.where(F.col("chunk") == newest).agg(
        F.max("position").alias("position"), F.max("id").alias("id")).first()
    return last["position"] + 1, last["id"]


def append_paged(hits: DataFrame, path: str, rows_per_chunk: int = ROWS_PER_CHUNK) -> None:
    """Add hits whose ids are larger than all stored ones (as ``assign_ids`` gives them)."""
    rows, largest = stored_rows(hits.sparkSession, path)
    least = hits.agg(F.min("id")).first()[0]
    if least is None:
        return
    if largest is not None and least <= largest:
        raise ValueError(f"id {least} does not follow {largest}")
    _store(hits, path, rows, "append", rows_per_chunk)


def page_rows(spark: SparkSession, path: str, limit: int | None = None, offset: int = 0,
              rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """The stored rows of a page, unsorted; no limit when it is missing or not positive."""
    table = spark.read.schema(STORED).parquet(path)
    inside = (F.col("position") >= offset) & (F.col("chunk") >= offset // rows_per_chunk)
    if limit is not None and limit > 0:
        last = offset + limit - 1
        inside &= (F.col("position") <= last) & (F.col("chunk") <= last // rows_per_chunk)
    return table.where(inside)


def read_page(spark: SparkSession, path: str, limit: int | None = None, offset: int = 0,
              rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """The same rows as ``page``, in order, from the files that hold them."""
    return page_columns(page_rows(spark, path, limit, offset, rows_per_chunk).orderBy("position"))
