"""Queries over notebook documents, cell metrics, links and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from notelake.functions.links import link_key
from notelake.operators import aggregates as agg, cells as cellops, curate, metrics
from notelake.operators.factstore import cell_metrics_once
from notelake.plans import fixtures as fx
from notelake.plans.registry import query
from notelake.schemas import CELLS, METRICS, PEAK_METRICS
from notelake.session import fresh_path
from notelake.sources import tables
from notelake.sources.notebook_files import scan_packed, write_notebook_files
from notelake.sources.notebooks import scan_notebooks
from notelake.streaming import streams

# ---- documents and cells ----------------------------------------------------------------------

_TYPE = "CASE role WHEN 'user' THEN 'code' WHEN 'assistant' THEN 'markdown' ELSE 'raw' END"
_DOC_CELLS = f"""
(SELECT conv_id, turn // 64 AS chunk, turn, conv_id || '-' || (turn // 64) AS notebook_hash,
        conv_id || '-' || turn AS cell_id, {_TYPE} AS cell_type, text AS source,
        cast(row_number() OVER (PARTITION BY conv_id, turn // 64 ORDER BY turn) - 1 AS INTEGER)
          AS cell_pos
 FROM conversations)"""


@query(f"""
SELECT notebook_hash, cell_id, cell_pos, cell_type, source FROM {_DOC_CELLS}
WHERE cell_type <> 'raw'""")
def notebook_cells(spark, sf_dir):
    code, md = cellops.split_cells(
        cellops.explode_cells(fx.conversation_notebooks(spark, sf_dir)))
    return code.withColumn("cell_type", F.lit("code")).unionByName(
        md.withColumn("cell_type", F.lit("markdown")))


# Folders of notebook files: listing costs a call for each, and each is listed in one call.
FOLDERS = 64


def _notebook_files(spark, sf_dir):
    """Write one file per document, named by it, in a fixed number of folders."""
    path = fresh_path(spark, "notebooks")
    folder = F.pmod(F.xxhash64("notebook_hash"), F.lit(FOLDERS)).cast("string")
    write_notebook_files(fx.conversation_notebooks(spark, sf_dir).select(
        F.concat_ws("/", folder, "notebook_hash").alias("notebook_hash"), F.lit(0).alias("line"),
        F.col("content").alias("json")), path)
    return path


def _named(cells):
    """Relative names <folder>/<document>.ipynb."""
    name = F.regexp_extract("notebook_hash", r"^[0-9]+/([^/]+)\.ipynb$", 1)
    return cells.withColumn("notebook_hash", name)


@query(f"SELECT notebook_hash, cell_id, cell_pos, cell_type, source FROM {_DOC_CELLS}")
def scanned_notebook_files(spark, sf_dir):
    # A root that has to be resolved first.
    root = _notebook_files(spark, sf_dir)
    odd = f"{root}/../{root.rsplit('/', 1)[1]}/./"
    return _named(cellops.explode_cells(scan_notebooks(spark, odd)))


@query(f"""
SELECT notebook_hash, cell_pos, cell_type, source, 'python3' AS kernel, 'Python 3' AS kernel_title,
       cast(NULL AS VARCHAR) AS kernel_env, '3.11' AS python, cast(NULL AS VARCHAR) AS mode,
       cast(NULL AS VARCHAR) AS widgets, '4' AS minor,
       CASE cell_type WHEN 'code' THEN '[]' END AS outputs
FROM {_DOC_CELLS}""")
def slim_documents(spark, sf_dir):
    slim = cellops.slim_notebooks(fx.conversation_notebooks(spark, sf_dir))
    member = lambda path: F.get_json_object("slim", f"$.{path}")
    outputs = F.from_json("slim", "struct<cells:array<struct<outputs:string>>>")["cells"]["outputs"]
    cells = cellops.explode_cells(slim, content="slim").drop("cell_id")
    rest = slim.select(
        "notebook_hash", member("metadata.kernelspec.name").alias("kernel"),
        member("metadata.kernelspec.display_name").alias("kernel_title"),
        member("metadata.kernelspec.env").alias("kernel_env"),
        member("metadata.language_info.version").alias("python"),
        member("metadata.language_info.codemirror_mode").alias("mode"),
        member("metadata.widgets").alias("widgets"), member("nbformat_minor").alias("minor"),
        F.posexplode(outputs).alias("cell_pos", "outputs"))
    return cells.join(rest, ["notebook_hash", "cell_pos"])


@query(f"""
SELECT notebook_hash, coalesce(string_agg(source, chr(10) ORDER BY turn)
         FILTER (cell_type = 'code'), '') AS code_text
FROM {_DOC_CELLS} GROUP BY notebook_hash""")
def notebook_code_text(spark, sf_dir):
    return cellops.code_text(fx.conversation_notebooks(spark, sf_dir)).select(
        "notebook_hash", "code_text")


_TAIL = cellops.REBUILT_TAIL


_REBUILT = f"""
(WITH cells AS (
   SELECT conv_id || '' AS notebook_hash, turn,
          row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS line,
          count(*) OVER (PARTITION BY conv_id) AS n,
          CASE role WHEN 'user'
            THEN '{{"cell_type":"code","execution_count":null,"metadata":{{}},'
                 || '"outputs":[],"source":' || cast(to_json(text) AS VARCHAR) || '}}'
            ELSE '{{"cell_type":"markdown","metadata":{{}},"source":'
                 || cast(to_json(text) AS VARCHAR) || '}}' END AS cell
   FROM conversations WHERE role IN ('user', 'assistant'))
 SELECT notebook_hash, line, cell || CASE WHEN line < n THEN ',' ELSE '' END AS json FROM cells
 UNION ALL SELECT DISTINCT notebook_hash, 0, '{{"cells":[' FROM cells
 UNION ALL SELECT DISTINCT notebook_hash, n + 1, '{_TAIL}' FROM cells)"""


@query(f"SELECT * FROM {_REBUILT}")
def rebuilt_notebooks(spark, sf_dir):
    code, md = cellops.split_cells(fx.conversation_cells(spark, sf_dir))
    return cellops.rebuild_notebooks(code, md)


@query(f"SELECT * FROM {_REBUILT}")
def rebuilt_without_positions(spark, sf_dir):
    """From a table without ``cell_pos``, read with the schema that has it."""
    cells = fx.conversation_cells(spark, sf_dir)
    paths = {}
    for kind, side in zip(("code", "markdown"), cellops.split_cells(cells)):
        paths[kind] = fresh_path(spark, kind) + ".csv"
        tables.write_csv(side.drop("cell_pos"), paths[kind])
    code, md = (tables.read_csv_table(
        spark, path, CELLS, ["notebook_hash", "cell_id", "source"]) for path in paths.values())
    return cellops.rebuild_notebooks(code, md)


@query(f"""
SELECT notebook_hash, string_agg(json, '' ORDER BY line) AS document
FROM {_REBUILT} GROUP BY notebook_hash""")
def written_notebooks(spark, sf_dir):
    code, md = cellops.split_cells(fx.conversation_cells(spark, sf_dir))
    path = fresh_path(spark, "rebuilt")
    tables.write_notebooks(cellops.rebuild_notebooks(code, md), path)
    lines = tables.read_table(spark, path).groupBy("notebook_hash").agg(
        F.array_sort(F.collect_list(F.struct("line", "json"))).alias("lines"))
    return lines.select("notebook_hash", F.array_join("lines.json", "").alias("document"))


@query(f"""
SELECT form, notebook_hash || '.ipynb' AS notebook_hash, document
FROM (SELECT notebook_hash, string_agg(json, '' ORDER BY line) AS document
      FROM {_REBUILT} GROUP BY notebook_hash), (SELECT unnest(['files', 'archives']) AS form)""")
def notebook_files_and_archives(spark, sf_dir):
    """Written as a file each and as archives, and read back by the library's scans."""
    lines = cellops.rebuild_notebooks(*cellops.split_cells(fx.conversation_cells(spark, sf_dir)))
    files, archives = fresh_path(spark, "files"), fresh_path(spark, "archives")
    write_notebook_files(lines, files)
    write_notebook_files(lines, archives, buckets=8)
    found = scan_notebooks(spark, files).withColumn("form", F.lit("files")).unionByName(
        scan_packed(spark, archives).withColumn("form", F.lit("archives")))
    return found.select("form", "notebook_hash", F.col("content").cast("string").alias("document"))


@query(f"""
SELECT count(*) FILTER (conv_id % 3 <> 0) AS converted,
       count(*) FILTER (conv_id % 3 = 0) AS raw_fallback
FROM (SELECT DISTINCT conv_id, chunk FROM {_DOC_CELLS})""")
def slim_or_raw_counts(spark, sf_dir):
    broken = F.when(F.col("conv_id") % 3 == 0, F.expr("left(content, length(content) - 3)"))
    notebooks = fx.conversation_notebooks(spark, sf_dir).withColumn(
        "content", F.coalesce(broken, "content"))
    return cellops.fallback_counts(cellops.slim_or_raw(notebooks))


# ---- cell metrics -----------------------------------------------------------------------------


@query("""
SELECT doc_id, len(lines) AS LOC, len([x for x in lines if trim(x, ' ') = '']) AS BLC,
       len([x for x in lines if regexp_matches(x, '^ *[%!]')]) AS MSC,
       sha1(array_to_string([x for x in lines if NOT regexp_matches(x, '^ *[%!]')], chr(10)))
         AS code_hash
FROM (SELECT doc_id, CASE WHEN text = '' THEN []
             WHEN suffix(text, chr(10)) THEN string_split(text[:-2], chr(10))
             ELSE string_split(text, chr(10)) END AS lines FROM documents)""")
def line_metrics_of_documents(spark, sf_dir):
    docs = metrics.line_metrics(fx.table(spark, sf_dir, "documents"), "text")
    return docs.select("doc_id", "LOC", "BLC", "MSC", F.sha1("code").alias("code_hash"))


def case_vocabulary(spark):
    return metrics.vocabulary(
        fx.pandas_vocab(spark), fx.functions_table(spark, fx.MPL_OPS),
        fx.functions_table(spark, fx.SEABORN_OPS))


def _by_case(values):
    return f"([{','.join(map(str, values))}])[p_partkey % {len(fx.CELL_CASES)} + 1]"


_CASE_METRICS = ", ".join(
    f"cast({_by_case([m.get(name, 0) for _, m, _ in fx.CELL_CASES])} AS BIGINT) AS {name}"
    for name in METRICS)
_CASE_FAILED = _by_case(int(i in fx.UNPARSABLE_CASES) for i in range(len(fx.CELL_CASES)))
_CASE_TABLE = f"""
(SELECT p_brand AS notebook_hash, p_partkey || '' AS cell_id, {_CASE_METRICS},
        {_CASE_FAILED} = 1 AS failed FROM part)"""


def part_metrics(spark, sf_dir):
    return metrics.cell_metrics(fx.part_cells(spark, sf_dir), case_vocabulary(spark))


@query(f"SELECT * FROM {_CASE_TABLE}")
def cell_metrics_by_case(spark, sf_dir):
    return part_metrics(spark, sf_dir).drop("cell_pos").withColumn(
        "failed", F.col("parse_error").isNotNull()).drop("parse_error")


@query(f"""
SELECT *, (SELECT count(DISTINCT p_partkey % {len(fx.CELL_CASES)}) FROM part
           WHERE p_brand < 'Brand#3') > 0 AS parsed_first, 0 AS parsed_again
FROM {_CASE_TABLE}""")
def cell_metrics_from_stored_facts(spark, sf_dir):
    """Three runs over one facts table: some brands, all of them, and all again without a parser."""
    cells, vocab = fx.part_cells(spark, sf_dir), case_vocabulary(spark)
    path = fresh_path(spark, "facts")
    _, first = cell_metrics_once(cells.where("notebook_hash < 'Brand#3'"), vocab, path)
    cell_metrics_once(cells, vocab, path)
    found, again = cell_metrics_once(cells, vocab, path)
    return found.drop("cell_pos").withColumns({
        "failed": F.col("parse_error").isNotNull(), "parsed_first": F.lit(first > 0),
        "parsed_again": F.lit(again)}).drop("parse_error")


_SIZED = dict(
    LOC="p_size + 2", S="p_size + 2", OPRND="2 * p_size", UOPRND="2", OPRAT="p_size", UOPRAT="1",
    ID="5", PO="p_size + 1", CO="1", LCO="p_size + 1", TCO="p_size + 1", CI="1", LCI="p_size",
    TCI="p_size")


@query(f"""
SELECT p_type AS notebook_hash, p_partkey || '' AS cell_id, {", ".join(
    f"cast({_SIZED.get(m, '0')} AS BIGINT) AS {m}" for m in METRICS)} FROM part""")
def cell_metrics_by_size(spark, sf_dir):
    return metrics.cell_metrics(fx.sized_cells(spark, sf_dir), case_vocabulary(spark)).drop(
        "parse_error")


_ORDER_CELL = dict(
    LOC="3", S="3", NBD="1", OPRND="5",
    UOPRND="CASE WHEN floor(o_totalprice) = o_custkey THEN 4 ELSE 5 END", OPRAT="2", UOPRAT="2",
    ID="5", PO="4", CO="3", LCO="2", TCO="4", CI="1", LCI="1", TCI="1")


@query(f"""
SELECT o_custkey || '' AS notebook_hash, o_orderkey || '' AS cell_id, o_orderkey AS cell_pos,
       {", ".join(f"cast({_ORDER_CELL.get(m, '0')} AS BIGINT) AS {m}" for m in METRICS)}
FROM orders""")
def cell_metrics_of_orders(spark, sf_dir):
    return metrics.cell_metrics(fx.order_cells(spark, sf_dir), case_vocabulary(spark)).drop(
        "parse_error")


@query(f"""
SELECT * FROM (
  SELECT notebook_hash, kind, cast(sum(n) AS BIGINT) AS n FROM (
    SELECT notebook_hash, unnest(['stmt', 'import', 'def', 'operand', 'operator', 'op', 'chain',
                                  'index', 'visual', 'train', 'block', 'ident']) AS kind,
           unnest([S, I, UDF, OPRND, OPRAT, PO, CO, CI, V, TC, NBD, ID]) AS n FROM {_CASE_TABLE})
  GROUP BY notebook_hash, kind) WHERE n > 0""")
def facts_per_notebook(spark, sf_dir):
    """How often per kind; of blocks the depth, of identifiers those of the cell's own."""
    facts = metrics.cell_facts(fx.part_cells(spark, sf_dir), case_vocabulary(spark))
    rows = metrics.cell_fact_rows(facts, ("notebook_hash", "cell_id"))
    counted = (
        F.when(F.col("kind") == "block", F.col("value"))
        .when(F.col("kind") == "ident", (~F.col("name").isin(metrics.RESERVED)).cast("int"))
        .otherwise(F.col("times")))
    per_cell = rows.groupBy("notebook_hash", "cell_id", "kind").agg(
        F.sum(counted).alias("total"), F.max(counted).alias("top"))
    n = F.when(F.col("kind") == "block", F.col("top")).otherwise(F.col("total"))
    return per_cell.groupBy("notebook_hash", "kind").agg(F.sum(n).alias("n")).where("n > 0")


@query(f"""
SELECT count(*) AS total_rows, count(*) FILTER (failed) AS parse_errors FROM {_CASE_TABLE}""")
def measured_rows(spark, sf_dir):
    return agg.run_totals(part_metrics(spark, sf_dir))


_OP_ROWS = " UNION ALL ".join(f"""
SELECT '{op}' AS "function", '{category}' AS category,
       cast(sum({_by_case(ops.get(op, 0) for _, _, ops in fx.CELL_CASES)}) AS BIGINT) AS "count"
FROM part""" for op, category in fx.PANDAS_OPS.items())


@query(f'SELECT "function", "count" FROM ({_OP_ROWS}) WHERE "count" > 0')
def call_counts(spark, sf_dir):
    return agg.op_counts(
        metrics.cell_facts(fx.part_cells(spark, sf_dir), case_vocabulary(spark)))


@query(f'SELECT * FROM ({_OP_ROWS}) ORDER BY "function"')
def call_summary(spark, sf_dir):
    return agg.op_summary(fx.pandas_vocab(spark), call_counts(spark, sf_dir))


@query(f"""
SELECT notebook_hash, count(cell_id) AS n_cells, {", ".join(
    f"max({m}) AS {m}" if m in PEAK_METRICS else f"cast(sum({m}) AS BIGINT) AS {m}"
    for m in METRICS)} FROM {_CASE_TABLE} GROUP BY notebook_hash""")
def notebook_metrics(spark, sf_dir):
    return agg.notebook_rollup(part_metrics(spark, sf_dir))


# ---- curation ---------------------------------------------------------------------------------


@query("""
SELECT line, slot, keyword, query FROM (
  SELECT p_partkey AS line, p_name AS keyword,
         unnest([0, 1, 2, 3]) AS slot,
         unnest(['".' || p_name || '(" extension:ipynb',
                 '".' || p_name || '(" "import pandas" extension:ipynb',
                 '".' || p_name || '(" ".read_" extension:ipynb',
                 '".' || p_name || '(" "import pandas" ".read_" extension:ipynb']) AS query
  FROM part WHERE p_name <> '')""")
def search_strings(spark, sf_dir):
    vocab = fx.table(spark, sf_dir, "part").select(
        F.concat(F.lit(" "), "p_name").alias("function"), "p_partkey")
    return curate.expand_queries(vocab, order="p_partkey")


_HITS = """
(SELECT event_id AS seq, event_id AS id, 'u' || user_id || '/r' AS repo_name,
        'https://github.com/u' || user_id || '/r' AS repo_url,
        'https://github.com/u' || user_id || '/r/blob/main/' || event_type || '.ipynb' AS file_url,
        props AS search_query, event_type AS keyword, ts AS found_at, value FROM events)"""


@query(f"""
SELECT seq, 'asc' AS sort_order, repo_name, repo_url, file_url, search_query, keyword, found_at
FROM {_HITS} WHERE value >= 10""")
def matching_hits(spark, sf_dir):
    return curate.match_hits(fx.raw_hits(spark, sf_dir))


_RECORD = "repo_name, repo_url, search_query, keyword, found_at"


@query(f"""
SELECT file_url, seq, {_RECORD} FROM {_HITS} JOIN (
  SELECT max_by(seq, pos) AS seq FROM (
    SELECT file_url, seq, seq AS pos FROM {_HITS}
    UNION ALL SELECT file_url, seq, 1000000000000 - seq FROM {_HITS}) GROUP BY file_url) USING (seq)""")
def deduplicated_hits(spark, sf_dir):
    hits = fx.event_hits(spark, sf_dir)
    newest_first = hits.withColumn("original", F.col("seq")).withColumn("seq", -F.col("seq"))
    found = curate.dedupe_hits(hits.withColumn("original", F.col("seq")), newest_first)
    return found.select("file_url", F.col("original").alias("seq"), *_RECORD.split(", "))


def _stored_and_new(spark, sf_dir):
    hits = fx.event_hits(spark, sf_dir)
    stored = curate.keep_first(
        hits.where(F.col("keyword") == "click"), ["file_url"], ["seq"]).drop("seq")
    return stored, hits.withColumn(
        "repo_url", F.when(F.col("search_query") != '{"k": 7}', F.col("repo_url")))


_INSERTED = f"""
(SELECT file_url, min(seq) AS seq FROM {_HITS}
 WHERE keyword <> 'click' AND search_query <> '{{"k": 7}}' GROUP BY file_url)"""


@query(f"SELECT file_url, seq, {_RECORD} FROM {_INSERTED} JOIN (SELECT seq, {_RECORD} FROM {_HITS}) USING (seq)")
def inserted_hits(spark, sf_dir):
    _, inserted = curate.insert_or_ignore(*_stored_and_new(spark, sf_dir))
    return inserted.select("file_url", "seq", *_RECORD.split(", "))


@query(f"""
SELECT file_url, row_number() OVER (ORDER BY seq, file_url)
  + (SELECT max(id) FROM (SELECT min(id) AS id FROM {_HITS} WHERE keyword = 'click'
                          GROUP BY file_url)) AS id
FROM {_INSERTED}""")
def numbered_hits(spark, sf_dir):
    stored, new = _stored_and_new(spark, sf_dir)
    _, inserted = curate.insert_or_ignore(stored, new)
    return curate.assign_ids(stored, inserted.drop("id")).select("file_url", "id")


@query(f"""
SELECT count(*) AS total, count(DISTINCT repo_name) AS unique_repos,
       count(DISTINCT keyword) AS unique_keywords FROM {_HITS}""")
def hit_statistics(spark, sf_dir):
    return curate.hit_stats(fx.event_hits(spark, sf_dir))


_LINKS = r"""
(SELECT page_id AS seq, link AS file_url,
        ' ' || regexp_replace(link, '/blob/main/.*$', '') ||
        (['', '/', '.git', '.git/'])[page_id % 4 + 1] || chr(9) AS repo_url
 FROM (SELECT page_id, regexp_replace(url, '^https?://([^/]+)/([^/?#]+)/',
                                      'https://github.com/\1/\2/blob/main/') AS link FROM pages))"""
_PARSED = rf"""
(SELECT seq, file_url, nullif(regexp_extract(bare, '{{P}}', 1), '') AS owner,
        nullif(regexp_extract(bare, '{{P}}', 2), '') AS repo,
        nullif(regexp_extract(bare, '{{P}}', 3), '') AS ref,
        nullif(regexp_extract(bare, '{{P}}', 4), '') AS path
 FROM (SELECT *, split_part(split_part(file_url, '#', 1), '?', 1) AS bare FROM {_LINKS}))
""".replace("{P}", r"^https?://github\.com/([^/]+)/([^/]+)/blob/([^/]+)/(.+)$")


@query(f"SELECT * FROM {_PARSED}")
def file_link_fields(spark, sf_dir):
    return curate.parse_blob_url(fx.page_links(spark, sf_dir)).drop("repo_url")


@query(f"""
SELECT seq, 'https://api.github.com/repos/' || owner || '/' || repo || '/contents/' || path
              || '?ref=' || ref AS contents_url,
       'https://github.com/' || owner || '/' || repo AS repo_link,
       'https://github.com/' || owner || '/' || repo || '/blob/' || ref || '/' || path AS blob_link
FROM {_PARSED} WHERE owner IS NOT NULL""")
def derived_links(spark, sf_dir):
    parsed = curate.parse_blob_url(fx.page_links(spark, sf_dir)).where("owner IS NOT NULL")
    return curate.build_links(parsed).select("seq", "contents_url", "repo_link", "blob_link")


@query("""
SELECT p_partkey || '' AS notebook_hash, p_partkey % 4 <> 2 AS import_pandas,
       p_partkey % 4 <> 3 AS has_read_call, p_partkey % 4 <> 3 AS has_op_call,
       p_partkey % 4 IN (0, 1) AS kept FROM part""")
def qualified_notebooks(spark, sf_dir):
    return curate.qualify(fx.part_notebooks(spark, sf_dir)).drop("keyword", "content")


@query("SELECT page_id, sha1(url) AS hash FROM pages")
def link_keys(spark, sf_dir):
    return fx.table(spark, sf_dir, "pages").select("page_id", link_key(F.col("url")).alias("hash"))


@query(f"""
SELECT '' AS repo_name, coalesce('https://github.com/' || owner || '/' || repo, '') AS repo_url,
       file_url AS file_link, sha1(file_url) AS hash
FROM (SELECT *, row_number() OVER (PARTITION BY file_url ORDER BY seq) AS nth FROM {_PARSED})
WHERE nth = 1 AND file_url NOT IN (SELECT file_url FROM {_LINKS} l JOIN labels ON doc_id = seq)""")
def mapped_links(spark, sf_dir):
    links = fx.page_links(spark, sf_dir).drop("repo_url").withColumn(
        "repo_name", F.lit(None).cast("string"))
    labelled = fx.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("seq"))
    known = links.join(labelled, "seq", "left_semi")
    existing = known.select(link_key(F.col("file_url")).alias("hash"))
    return curate.link_map(links, existing)


_REPOS = rf"""
(SELECT seq, regexp_extract(url, '{{P}}', 1) AS owner, regexp_extract(url, '{{P}}', 2) AS repo
 FROM (SELECT seq, trim(replace(repo_url, chr(9), '')) AS url FROM {_LINKS})
 WHERE regexp_matches(url, '{{P}}'))
""".replace("{P}", r"^https?://github\.com/([^/]+)/([^/]+?)(?:\.git)?/?$")


@query(f"SELECT seq, owner, repo, owner || '/' || repo AS repo_name FROM {_REPOS}")
def repository_fields(spark, sf_dir):
    parsed = curate.parse_repo_url(fx.page_links(spark, sf_dir))
    return parsed.where("repo_name IS NOT NULL").select("seq", "owner", "repo", "repo_name")


@query(f"SELECT DISTINCT owner, repo, owner || '/' || repo AS repo_name FROM {_REPOS}")
def unique_repositories(spark, sf_dir):
    return curate.unique_repos(fx.page_links(spark, sf_dir))


_CHOSEN = """
(SELECT 'o/r' || (p_partkey // 50) AS repo_name,
        CASE WHEN (p_partkey // 50) % 3 <> 0 THEN 'main'
             WHEN (p_partkey // 50) % 6 <> 0 THEN 'master' END AS ref,
        p_size % 5 <> 0 AND p_size % 2 = 0 AS is_csv,
        p_type || '/' || replace(p_name, ' ', '_') || '_' || p_partkey || '.CSV' AS path
 FROM part)"""


@query(f"""
SELECT repo_name, 'https://github.com/' || repo_name AS repo_url,
       count(*) FILTER (is_csv AND ref IS NOT NULL) AS csv_count,
       TIMESTAMP '2024-05-06 07:08:09' AS found_at
FROM {_CHOSEN} GROUP BY repo_name""")
def csv_per_repository(spark, sf_dir):
    trees = curate.choose_tree(fx.part_trees(spark, sf_dir))
    return curate.csv_counts(trees, F.lit("2024-05-06 07:08:09").cast("timestamp"))


@query(f"""
SELECT repo_name, 'https://github.com/' || repo_name || '/blob/' || ref || '/' || path AS file_url
FROM {_CHOSEN} WHERE is_csv AND ref IS NOT NULL""")
def csv_file_links(spark, sf_dir):
    return curate.csv_files(curate.choose_tree(fx.part_trees(spark, sf_dir)))


@query("""
SELECT sha1(o_custkey || '') AS notebook_hash, o_orderkey || '' AS cell_id, c_mktsegment AS repo_name,
       o_custkey || '' AS file_link, n AS csv_count
FROM orders JOIN customer ON c_custkey = o_custkey
JOIN (SELECT c_mktsegment AS s, count(*) AS n FROM customer GROUP BY 1) ON s = c_mktsegment""")
def linked_cells(spark, sf_dir):
    cells = fx.table(spark, sf_dir, "orders").select(
        F.sha1(F.col("o_custkey").cast("string")).alias("notebook_hash"),
        F.col("o_orderkey").cast("string").alias("cell_id"))
    customers = fx.table(spark, sf_dir, "customer")
    links = customers.select(
        F.sha1(F.col("c_custkey").cast("string")).alias("hash"),
        F.col("c_mktsegment").alias("repo_name"), F.col("c_custkey").cast("string").alias("file_link"))
    counts = links.groupBy("repo_name").agg(F.count(F.lit(1)).alias("csv_count"))
    return curate.link_cells(cells, links, counts)


# ---- streams ----------------------------------------------------------------------------------


class _Streamed:
    """The provided tables as streams, for the functions that build fixtures."""

    def __init__(self, spark):
        self.read = self
        self._spark = spark

    def parquet(self, path):
        schema = self._spark.read.parquet(path).schema
        # As a pattern, so that a table may be one file or a folder of files.
        return self._spark.readStream.schema(schema).parquet(f"{path[:-1]}[{path[-1]}]")


@query(f"""
SELECT notebook_hash, cell_id, cell_pos, cell_type, source FROM {_DOC_CELLS}
WHERE cell_type <> 'raw'""")
def streamed_notebook_files(spark, sf_dir):
    target = fresh_path(spark, "cells")
    streams.ingest_stream(
        spark, _notebook_files(spark, sf_dir), target,
        fresh_path(spark, "progress")).awaitTermination()
    return _named(spark.read.parquet(target))


@query(f"SELECT * FROM {_CASE_TABLE}")
def streamed_cell_metrics(spark, sf_dir):
    target = fresh_path(spark, "metrics")
    streams.metrics_stream(
        fx.part_cells(_Streamed(spark), sf_dir), case_vocabulary(spark), target,
        fresh_path(spark, "progress")).awaitTermination()
    return spark.read.parquet(target).drop("cell_pos").withColumn(
        "failed", F.col("parse_error").isNotNull()).drop("parse_error")


@query(f"SELECT DISTINCT file_url, sha1(file_url) AS hash FROM {_HITS}")
def streamed_first_links(spark, sf_dir):
    target = fresh_path(spark, "links")
    streams.first_seen_stream(
        fx.event_hits(_Streamed(spark), sf_dir), target,
        fresh_path(spark, "progress")).awaitTermination()
    return spark.read.parquet(target).select("file_url", "hash")


_KNOWN = f"""(SELECT sha1(file_url) FROM {_HITS} WHERE keyword = 'click' AND repo_name < 'u5')"""


@query(f"""
SELECT sha1(file_url) AS hash, file_url, min(seq) AS seq, arg_min(repo_name, seq) AS repo_name,
       arg_min(keyword, seq) AS keyword, arg_min(found_at, seq) AS found_at
FROM {_HITS} WHERE sha1(file_url) NOT IN {_KNOWN} GROUP BY file_url""")
def streamed_unmapped_links(spark, sf_dir):
    """The link map of an earlier run is the state a fresh stream starts with."""
    hits = fx.event_hits(spark, sf_dir)
    known = curate.link_map(hits.where("keyword = 'click' and repo_name < 'u5'"))
    path, target = fresh_path(spark, "map"), fresh_path(spark, "links")
    known.write.parquet(path)
    streams.first_seen_stream(
        fx.event_hits(_Streamed(spark), sf_dir), target, fresh_path(spark, "progress"),
        known=spark.read.parquet(path), order="seq").awaitTermination()
    return spark.read.parquet(target).select(
        "hash", "file_url", "seq", "repo_name", "keyword", "found_at")


@query(f'SELECT * FROM ({_OP_ROWS}) ORDER BY "function"')
def streamed_call_summary(spark, sf_dir):
    target = fresh_path(spark, "summary")
    streams.op_count_stream(
        fx.part_cells(_Streamed(spark), sf_dir), case_vocabulary(spark), fx.pandas_vocab(spark),
        target, fresh_path(spark, "progress")).awaitTermination()
    return streams.latest_summary(spark, target)


@query(f"""
SELECT file_url, sha1(file_url) AS hash, min(seq) AS seq, arg_min(repo_name, seq) AS repo_name,
       arg_min(repo_url, seq) AS repo_url, arg_min(search_query, seq) AS search_query,
       arg_min(keyword, seq) AS keyword, arg_min(found_at, seq) AS found_at
FROM {_HITS} GROUP BY file_url""")
def streamed_hits_table(spark, sf_dir):
    target = fresh_path(spark, "hits")
    hits = fx.event_hits(_Streamed(spark), sf_dir)
    # The second run meets every link again and adds nothing.
    for _ in range(2):
        streams.merge_stream(hits, target, fresh_path(spark, "progress")).awaitTermination()
    return spark.read.parquet(target).select(
        "file_url", "hash", "seq", "repo_name", "repo_url", "search_query", "keyword", "found_at")


@query(f"""
SELECT batch, count(*) AS rows, count(*) FILTER (first) AS inserted FROM (
  SELECT seq % 5 AS batch, row_number() OVER (PARTITION BY file_url ORDER BY seq % 5, seq) = 1 AS first
  FROM {_HITS}) GROUP BY batch""")
def hits_per_merged_batch(spark, sf_dir):
    """Five batches over one table, with more of them than are kept side by side."""
    hits, target = fx.event_hits(spark, sf_dir), fresh_path(spark, "merged")
    counts = [(n, streams.merge_batch(hits.where(F.col("seq") % 5 == n), target, f"b-{n}", most=3))
              for n in range(5)]
    return spark.createDataFrame([(n, c["rows"], c["inserted"]) for n, c in counts],
                                 "batch long, rows long, inserted long")
