"""Queries over whole jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from notelake.operators import aggregates as agg, curate
from notelake.plans import fixtures as fx, jobs, notebook_queries as nq
from notelake.plans.registry import query

_STORED = f"""(SELECT file_url, min(id) AS id FROM {nq._HITS} WHERE keyword = 'click'
               GROUP BY file_url)"""


_COLUMNS = "repo_name, repo_url, search_query, keyword, found_at"


@query(f"""
SELECT id, file_url, {_COLUMNS} FROM {nq._HITS} h
WHERE keyword = 'click' AND id = (SELECT min(id) FROM {nq._HITS} o WHERE o.file_url = h.file_url)
UNION ALL
SELECT row_number() OVER (ORDER BY seq, file_url) + (SELECT max(id) FROM {_STORED}), file_url, {_COLUMNS}
FROM (SELECT file_url, max(seq) AS seq FROM {nq._HITS}
      WHERE value >= 10 AND keyword <> 'click' GROUP BY file_url)
JOIN (SELECT seq, {_COLUMNS} FROM {nq._HITS}) USING (seq)""")
def discovered_hits(spark, sf_dir):
    hits = fx.event_hits(spark, sf_dir)
    stored = curate.keep_first(
        hits.where(F.col("keyword") == "click"), ["file_url"], ["seq"]).drop("seq")
    raw = fx.raw_hits(spark, sf_dir)
    found = jobs.discover(raw, raw.withColumn("sort_order", F.lit("desc")), stored)
    return found.select(
        "id", "file_url", "repo_name", "repo_url", "search_query", "keyword", "found_at")


def _part_url(key):
    return F.concat(F.lit("https://github.com/o/r/blob/main/"), F.col(key), F.lit(".ipynb"))


_PART_URL = "'https://github.com/o/r/blob/main/' || p_partkey || '.ipynb'"


@query(f"""
SELECT p_partkey AS id, {_PART_URL} AS file_link, sha1({_PART_URL}) AS hash, 'o/r' AS repo_name,
       'https://github.com/o/r' AS repo_url, false AS fallback
FROM (SELECT * FROM part ORDER BY p_partkey OFFSET 7)
WHERE p_partkey % 4 IN (0, 1) AND p_partkey % 8 <> 0 AND p_partkey % 12 <> 1""")
def fetched_notebooks(spark, sf_dir):
    """Every twelfth file has text behind its document; every eighth notebook was stored before."""
    parts = fx.part_notebooks(spark, sf_dir).withColumn("file_url", _part_url("notebook_hash"))
    hits = parts.select(F.col("notebook_hash").cast("bigint").alias("id"),
                        F.lit("o/r").alias("repo_name"), "file_url", "keyword")
    before = parts.where(F.col("notebook_hash").cast("bigint") % 8 == 0).select(
        F.sha1("file_url").alias("hash"))
    content = F.when(F.col("notebook_hash").cast("bigint") % 12 == 1,
                     F.concat("content", F.lit(" {}"))).otherwise(F.col("content"))
    notebooks, links = jobs.fetch(
        hits, parts.select("file_url", content.alias("content")), before, before, offset=7)
    return notebooks.join(links.drop("repo_name"), "hash").select(
        "id", "file_link", "hash", "repo_name", "repo_url", "fallback")


@query(f"""
SELECT repo_name, csv_count, f.files FROM (
  SELECT repo_name, count(*) FILTER (is_csv AND ref IS NOT NULL) AS csv_count
  FROM {nq._CHOSEN} GROUP BY repo_name)
LEFT JOIN (SELECT repo_name, count(*) AS files FROM {nq._CHOSEN}
           WHERE is_csv AND ref IS NOT NULL GROUP BY repo_name) f USING (repo_name)""")
def checked_repositories(spark, sf_dir):
    parts = fx.table(spark, sf_dir, "part")
    links = parts.select(
        F.col("p_partkey").alias("seq"),
        F.concat(F.lit("https://github.com/o/r"), F.expr("p_partkey div 50")).alias("repo_url"))
    counts, files = jobs.check_repositories(links, fx.part_trees(spark, sf_dir))
    listed = files.groupBy("repo_name").agg(F.count(F.lit(1)).alias("files"))
    return counts.select("repo_name", "csv_count").join(listed, "repo_name", "left")


@query(" UNION ALL ".join(f"""
SELECT '{name}' AS name, count(*) AS "rows", round(avg({total} / {count}), 9) AS mean_ratio
FROM {nq._CASE_TABLE} WHERE {count} > 0"""
                          for name, total, count in (("operation chain", "TCO", "CO"),
                                                     ("indexing chain", "TCI", "CI"))))
def chain_lengths(spark, sf_dir):
    found = jobs.chain_numbers(nq.part_metrics(spark, sf_dir))
    return found.withColumn("mean_ratio", F.round("mean_ratio", 9))


_COUNTS = """(SELECT cast(l_partkey AS VARCHAR) AS "function", count(*) AS "count"
              FROM lineitem GROUP BY l_partkey)"""


@query(f"""
SELECT "function", "count", round_even("count" / sum("count") OVER () * 100 * 100, 0) / 100 AS percentage,
       "rank", CASE WHEN top <= 15 AND bottom <= 15 THEN 'both' WHEN top <= 15 THEN 'top'
                    WHEN bottom <= 15 THEN 'bottom' END AS place
FROM (SELECT *, row_number() OVER (ORDER BY "count" DESC, "function") AS "rank",
             row_number() OVER (ORDER BY "count" DESC, "function") AS top,
             row_number() OVER (ORDER BY "count", "function" DESC) AS bottom FROM {_COUNTS})""")
def calls_with_shares_and_ranks(spark, sf_dir):
    counts = fx.table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_partkey").cast("string").alias("function")).agg(F.count(F.lit(1)).alias("count"))
    return jobs.call_ranking(counts)


@query(f"""
SELECT * EXCLUDE (failed) FROM {nq._CASE_TABLE} WHERE notebook_hash = (
  SELECT notebook_hash FROM {nq._CASE_TABLE} GROUP BY notebook_hash
  ORDER BY sum(PO) DESC, notebook_hash LIMIT 1)""")
def cells_of_the_peak_notebook(spark, sf_dir):
    measured = nq.part_metrics(spark, sf_dir).drop("cell_pos", "parse_error")
    rolled = agg.notebook_rollup(measured, ["LOC", "PO"], [])
    return jobs.peak_notebook(rolled, measured, "PO")


@query(f"""
SELECT name, value FROM (UNPIVOT (
  SELECT count(DISTINCT notebook_hash) AS notebooks, cast(sum(LOC) AS BIGINT) AS LOC_total,
         cast(sum(PO) AS BIGINT) AS PO_total FROM {nq._CASE_TABLE})
  ON notebooks, LOC_total, PO_total INTO NAME name VALUE value)
UNION ALL SELECT 'repositories', count(DISTINCT repo_name) FROM {nq._HITS}
UNION ALL SELECT 'with_csv', count(DISTINCT repo_name) FROM {nq._CHOSEN}
          WHERE is_csv AND ref IS NOT NULL
UNION ALL SELECT 'csv_files', count(*) FROM {nq._CHOSEN} WHERE is_csv AND ref IS NOT NULL""")
def sizes_of_the_corpus(spark, sf_dir):
    rolled = agg.notebook_rollup(nq.part_metrics(spark, sf_dir))
    counts = curate.csv_counts(curate.choose_tree(fx.part_trees(spark, sf_dir)))
    return jobs.corpus_sizes(rolled, fx.event_hits(spark, sf_dir), counts)
