"""Sorts, top and bottom rows, the peak row and its notebook."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from notelake.operators.ordering import global_index


def top_k(df: DataFrame, col: str, k: int = 15, ties: Sequence[str] = ()) -> DataFrame:
    """The ``k`` rows with the largest ``col``; equal values in the order of ``ties``."""
    return df.orderBy(F.desc(col), *ties).limit(k)


def bottom_k(df: DataFrame, col: str, k: int = 15, ties: Sequence[str] = ()) -> DataFrame:
    """The last ``k`` rows of the order of ``top_k``."""
    return df.orderBy(F.asc_nulls_first(col), *[F.desc(t) for t in ties]).limit(k)


def argmax_row(df: DataFrame, col: str, ties: Sequence[str] = ()) -> DataFrame:
    """The first row that attains the maximum of ``col``."""
    return top_k(df, col, 1, ties)


def drill_down(cells: DataFrame, row: DataFrame, key: str = "notebook_hash") -> DataFrame:
    """All cells of the notebook in the one-row frame ``row``."""
    return cells.join(F.broadcast(row.select(key)), key, "left_semi")


def rank_ops(summary: DataFrame, col: str = "count", name: str = "function") -> DataFrame:
    """Add ``rank``: 1 for the largest count, ties by name."""
    ranked = global_index(summary, [F.desc(col), F.col(name)], "rank")
    return ranked.withColumn("rank", F.col("rank") + 1)


def by_name(df: DataFrame, name: str = "function") -> DataFrame:
    return df.orderBy(name)


def preview(df: DataFrame, order: Sequence[str], k: int = 5) -> DataFrame:
    """The first rows under ``order``."""
    return df.orderBy(*order).limit(k)
