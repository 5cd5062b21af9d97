"""Search hits, links, notebook qualification and repository checks over captured tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from notelake.functions.links import (
    blob_url, contents_url, file_link_parts, link_key, repo_link_parts, repo_url,
)
from notelake.functions.text import BLANK
from notelake.operators.cells import code_text
from notelake.operators.ordering import global_index

# Search strings asked per function.
QUERY_TEMPLATES = (
    '".%s(" extension:ipynb',
    '".%s(" "import pandas" extension:ipynb',
    '".%s(" ".read_" extension:ipynb',
    '".%s(" "import pandas" ".read_" extension:ipynb',
)
# What a kept notebook has to contain.
IMPORTS_PANDAS = rf"(?mdU)^{BLANK}*(import{BLANK}+pandas\b|from{BLANK}+pandas{BLANK}+import\b)"
CALLS_READER = rf"(?U)\.read_[A-Za-z0-9_]*{BLANK}*\("
HIT_COLUMNS = ("repo_name", "repo_url", "file_url", "search_query", "keyword", "found_at")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first in ``order``; combines before the shuffle."""
    row = F.struct(*df.columns)
    return df.groupBy(*keys).agg(F.min_by(row, F.struct(*order)).alias("_row")).select("_row.*")


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the last in ``order``."""
    row = F.struct(*df.columns)
    return df.groupBy(*keys).agg(F.max_by(row, F.struct(*order)).alias("_row")).select("_row.*")


def expand_queries(
    vocab: DataFrame, templates: Sequence[str] = QUERY_TEMPLATES, order: str | None = None
) -> DataFrame:
    """(line, slot, keyword, query): the search strings of each non-empty function.

    Sorting by (line, slot) gives the order of the vocabulary file.
    """
    line = F.monotonically_increasing_id() if order is None else F.col(order)
    keyword = F.trim(F.coalesce("function", F.lit("")))
    strings = F.array(*[F.format_string(t, "keyword") for t in templates])
    return (
        vocab.select(line.alias("line"), keyword.alias("keyword"))
        .where("keyword != ''")
        .select("line", "keyword", F.posexplode(strings).alias("slot", "query"))
        .select("line", "slot", "keyword", "query")
    )


def match_hits(raw: DataFrame) -> DataFrame:
    """Hits with a text fragment that calls the keyword, as flat records.

    ``seq`` and ``sort_order`` are kept for ``dedupe_hits``.
    """
    call = F.concat(F.lit("."), F.col("keyword"), F.lit("("))
    calls = F.exists("text_matches", lambda m: F.contains(
        F.coalesce(m["fragment"], F.lit("")), call))
    return raw.where(calls).select(
        "seq", "sort_order",
        F.col("repository.full_name").alias("repo_name"),
        F.col("repository.html_url").alias("repo_url"),
        F.col("html_url").alias("file_url"),
        "search_query", "keyword", "found_at",
    )


def dedupe_hits(asc: DataFrame, desc: DataFrame) -> DataFrame:
    """Union of both result orders, one record per link; the last one wins."""
    both = asc.withColumn("branch", F.lit(0)).unionByName(desc.withColumn("branch", F.lit(1)))
    linked = both.where(F.coalesce("file_url", F.lit("")) != "")
    return keep_last(linked, ["file_url"], ["branch", "seq"]).drop("branch")


def insert_or_ignore(
    existing: DataFrame, new: DataFrame, order: str = "seq"
) -> tuple[DataFrame, DataFrame]:
    """(all rows, inserted rows): new links only, first one wins, incomplete rows are ignored.

    Both carry the columns of ``existing`` without its ``id``.
    """
    columns = [c for c in HIT_COLUMNS if c in existing.columns]
    complete = new.dropna(subset=["repo_name", "repo_url", "file_url"])
    first = keep_first(complete, ["file_url"], [order])
    inserted = first.join(existing.select("file_url"), "file_url", "left_anti")
    return existing.select(columns).unionByName(inserted.select(columns)), inserted


def assign_ids(existing: DataFrame, inserted: DataFrame, order: str = "seq") -> DataFrame:
    """Give inserted rows the ids after the largest existing one, without gaps, by ``order``."""
    top = F.coalesce(existing.agg(F.max("id")).scalar(), F.lit(0))
    numbered = global_index(inserted, [F.col(order), F.col("file_url")], "id")
    return numbered.withColumn("id", F.col("id") + top + 1)


def hit_stats(hits: DataFrame) -> DataFrame:
    return hits.agg(
        F.count(F.lit(1)).alias("total"),
        F.countDistinct("repo_name").alias("unique_repos"),
        F.countDistinct("keyword").alias("unique_keywords"),
    )


def parse_blob_url(df: DataFrame, col: str = "file_url") -> DataFrame:
    """Add owner, repo, ref and path of a file link (NULL for any other link)."""
    return df.withColumn("_parts", file_link_parts(F.col(col))).select(
        *df.columns, "_parts.owner", "_parts.repo", "_parts.ref", "_parts.path")


def parse_repo_url(df: DataFrame, col: str = "repo_url") -> DataFrame:
    """Add owner, repo and repo_name of a repository link."""
    kept = [c for c in df.columns if c not in ("owner", "repo", "repo_name")]
    return df.withColumn("_parts", repo_link_parts(F.col(col))).select(
        *kept, "_parts.owner", "_parts.repo", "_parts.repo_name")


def build_links(df: DataFrame) -> DataFrame:
    """Add contents_url, repo_link and blob_link from owner, repo, ref and path."""
    owner, repo, ref, path = map(F.col, ("owner", "repo", "ref", "path"))
    return df.select(
        "*",
        contents_url(owner, repo, ref, path).alias("contents_url"),
        repo_url(owner, repo).alias("repo_link"),
        blob_url(F.concat_ws("/", owner, repo), ref, path).alias("blob_link"),
    )


def _calls(text: Column, op: Column) -> Column:
    quoted = F.replace(op, F.lit(r"\E"), F.lit(r"\E\\E\Q"))
    return F.regexp_like(text, F.concat(F.lit(r"(?U)\.\Q"), quoted, F.lit(rf"\E{BLANK}*\(")))


def qualify(nb: DataFrame, op: str = "keyword", content: str = "content") -> DataFrame:
    """Add import_pandas, has_read_call, has_op_call and ``kept`` (all three).

    A malformed notebook or a missing operation gives false.
    """
    name = F.coalesce(F.col(op), F.lit(""))
    flags = {
        "import_pandas": F.col("code_text").rlike(IMPORTS_PANDAS),
        "has_read_call": F.col("code_text").rlike(CALLS_READER),
        "has_op_call": (name != "") & _calls(F.col("code_text"), name),
    }
    found = code_text(nb, content).withColumns(
        {n: F.coalesce(flag, F.lit(False)) for n, flag in flags.items()})
    return found.withColumn(
        "kept", F.col("import_pandas") & F.col("has_read_call") & F.col("has_op_call")
    ).drop("code_text")


def link_map(
    nb: DataFrame, existing: DataFrame | None = None, order: str = "seq"
) -> DataFrame:
    """(repo_name, repo_url, file_link, hash) of links whose hash is not yet mapped."""
    parsed = parse_blob_url(nb, "file_url")
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    rows = parsed.select(
        text("repo_name").alias("repo_name"),
        repo_url(F.col("owner"), F.col("repo")).alias("repo_url"),
        F.col("file_url").alias("file_link"),
        link_key(F.col("file_url")).alias("hash"),
        F.col(order).alias("_order"),
    )
    first = keep_first(rows, ["hash"], ["_order"]).drop("_order")
    return first if existing is None else first.join(existing.select("hash"), "hash", "left_anti")


def unique_repos(links: DataFrame, order: str = "seq") -> DataFrame:
    """(owner, repo, repo_name): valid repository links, the first per name."""
    parsed = parse_repo_url(links).where(F.col("repo_name").isNotNull())
    return keep_first(parsed, ["repo_name"], [order]).select("owner", "repo", "repo_name")


def choose_tree(responses: DataFrame) -> DataFrame:
    """(repo_name, ref, tree): the first answer per repository; NULLs where none answered.

    Of a tree only the CSV files stay, so that whole trees are not shuffled.
    """
    answer = F.struct("ref", "tree")
    return (
        responses.withColumn("tree", F.when(F.col("tree").isNotNull(), csv_entries()))
        .groupBy("repo_name")
        .agg(F.min_by(F.when(F.col("tree").isNotNull(), answer),
                      F.when(F.col("tree").isNotNull(), F.col("priority"))).alias("answer"))
        .select("repo_name", "answer.ref", "answer.tree")
    )


def csv_entries() -> Column:
    return F.filter(
        F.coalesce("tree", F.array()),
        lambda e: (e["type"] == "blob") & F.endswith(F.lower(e["path"]), F.lit(".csv")),
    )


def csv_counts(trees: DataFrame, found_at: Column | None = None) -> DataFrame:
    """(repo_name, repo_url, csv_count, found_at) per repository, 0 where it has none."""
    return trees.select(
        "repo_name",
        F.concat_ws("/", F.lit("https://github.com"), "repo_name").alias("repo_url"),
        F.size(csv_entries()).cast("bigint").alias("csv_count"),
        (F.current_timestamp() if found_at is None else found_at).alias("found_at"),
    )


def csv_files(trees: DataFrame) -> DataFrame:
    """(repo_name, file_url): one row per CSV file of the chosen trees."""
    return trees.select(
        "repo_name", "ref", F.explode_outer(csv_entries()).alias("entry")
    ).where("entry IS NOT NULL").select(
        "repo_name",
        blob_url(F.col("repo_name"), F.col("ref"), F.col("entry.path")).alias("file_url"),
    )


def link_cells(cells: DataFrame, links: DataFrame, counts: DataFrame) -> DataFrame:
    """Cells with the repository of their notebook and its CSV count (0 when unknown)."""
    sourced = links.select(F.col("hash").alias("notebook_hash"), "repo_name", "file_link")
    # The narrow side is joined first, cells meet one ready lookup table.
    lookup = sourced.join(counts.select("repo_name", "csv_count"), "repo_name", "left")
    return cells.join(lookup, "notebook_hash").withColumn(
        "csv_count", F.coalesce("csv_count", F.lit(0)))
