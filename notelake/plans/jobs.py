"""Whole jobs, from captured answers to the tables the next job reads.

Every step is a DataFrame; callers write what a job returns. Steps that more than one result needs
are written to the shared folder once.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from notelake.functions.links import link_key
from notelake.operators import aggregates as agg, cells, curate, ranking
from notelake.session import fresh_path
from notelake.sources.paging import read_page
from notelake.sources.tables import page, skip_existing


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def discover(ascending: DataFrame, descending: DataFrame, stored: DataFrame) -> DataFrame:
    """Search answers in both orders -> the hits table with the new links, numbered on.

    ``stored`` is the table so far (with ``id``).
    """
    found = curate.dedupe_hits(curate.match_hits(ascending), curate.match_hits(descending))
    _, inserted = curate.insert_or_ignore(stored, found)
    columns = [c for c in curate.HIT_COLUMNS if c in stored.columns]
    numbered = curate.assign_ids(stored, inserted)
    return stored.select("id", *columns).unionByName(numbered.select("id", *columns))


def fetch(hits: DataFrame | str, captured: DataFrame, written: DataFrame, mapped: DataFrame,
          limit: int | None = None, offset: int = 0) -> tuple[DataFrame, DataFrame]:
    """A page of hits and the captured files (file_url, content) -> (notebooks, links) to add.

    ``hits`` may be the path of a table stored by ``write_paged``, of which only the page is read.

    Only notebooks that qualify and are not yet in ``written`` (hash) are stored, slim or else as
    they are, and only their links are mapped.
    """
    paged = (read_page(captured.sparkSession, hits, limit, offset) if isinstance(hits, str)
             else page(hits, limit, offset))
    rows = paged.join(captured, "file_url")
    kept = curate.qualify(rows).where("kept").withColumn("hash", link_key(F.col("file_url")))
    new = curate.keep_first(skip_existing(kept, written), ["hash"], ["id"])
    notebooks = _stored(
        cells.slim_or_raw(new).select("id", "hash", "repo_name", "file_url", "stored", "fallback"),
        "fetched")
    return notebooks, curate.link_map(notebooks, mapped, order="id")


def check_repositories(
    links: DataFrame, responses: DataFrame, found_at: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Repository links and captured trees -> (CSV counts, CSV files) per repository."""
    known = curate.unique_repos(links).select("repo_name")
    trees = _stored(curate.choose_tree(responses.join(known, "repo_name", "left_semi")), "trees")
    return curate.csv_counts(trees, found_at), curate.csv_files(trees)


def chain_numbers(metrics: DataFrame) -> DataFrame:
    """(name, rows, mean_ratio): mean length of operation and of indexing chains, per cell."""
    of = (("operation chain", "TCO", "CO"), ("indexing chain", "TCI", "CI"))
    return reduce(DataFrame.unionByName, [
        agg.mean_ratio(metrics, total, count).withColumn("name", F.lit(name))
        for name, total, count in of])


def call_ranking(summary: DataFrame, k: int = 15) -> DataFrame:
    """(function, count, percentage, rank, place): shares and ranks, with the first and last k.

    ``place`` is "top", "bottom", "both" or NULL. Vocabularies are small, corpora are not: all of
    this works on one row per function.
    """
    ranked = ranking.rank_ops(agg.share_of_total(summary.select("function", "count"), "count"))
    ends = [ranking.top_k(summary, "count", k, ["function"]).withColumn("place", F.lit("top")),
            ranking.bottom_k(summary, "count", k, ["function"]).withColumn(
                "place", F.lit("bottom"))]
    places = ends[0].unionByName(ends[1]).groupBy("function").agg(
        F.when(F.count(F.lit(1)) > 1, "both").otherwise(F.min("place")).alias("place"))
    return ranked.join(places, "function", "left")


def peak_notebook(rolled: DataFrame, metrics: DataFrame, col: str) -> DataFrame:
    """The cells of the notebook whose ``col`` is largest (the first by name among equals)."""
    peak = ranking.argmax_row(rolled, col, ["notebook_hash"])
    return ranking.drill_down(metrics, peak, "notebook_hash")


def size_distribution(rolled: DataFrame, col: str = "n_cells") -> tuple[DataFrame, DataFrame]:
    """(fences, histogram of the notebooks within the fences)."""
    return agg.iqr_fences(rolled, col), agg.histogram(agg.iqr_filter(rolled, col), col)


def corpus_sizes(rolled: DataFrame, links: DataFrame, counts: DataFrame,
                 sums: Sequence[str] = ("LOC", "PO")) -> DataFrame:
    """(name, value): notebooks, repositories, those with CSV files, their files, metric totals."""
    notebooks = rolled.agg(F.count(F.lit(1)).alias("notebooks"),
                           *[F.sum(c).alias(f"{c}_total") for c in sums])
    repositories = agg.distinct_count(links, "repo_name", "repositories")
    with_csv = counts.agg(F.count_if(F.col("csv_count") > 0).alias("with_csv"),
                          F.coalesce(F.sum("csv_count"), F.lit(0)).alias("csv_files"))
    return reduce(DataFrame.unionByName, [
        df.unpivot([], df.columns, "name", "value") for df in (notebooks, repositories, with_csv)])
