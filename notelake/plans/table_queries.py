"""Queries over sources, sinks, aggregates, rankings and position curves."""

from __future__ import annotations

from pyspark.sql import functions as F

from notelake.operators import aggregates as agg, position, ranking
from notelake.operators.curate import keep_last
from notelake.operators.ordering import with_cell_pos
from notelake.plans.fixtures import conversation_cells, event_hits, page_links, table
from notelake.plans.registry import query
from notelake.session import fresh_path
from notelake.sources import paging, tables

# ---- scans and sinks --------------------------------------------------------------------------


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def csv_round_trip(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    path = fresh_path(spark, "documents") + ".csv"
    tables.write_csv(docs, path)
    return tables.read_csv_table(
        spark, path, "doc_id long, text string, lang string, source string, n_chars long")


@query("SELECT o_orderkey, o_orderpriority FROM orders")
def csv_pruned_scan(spark, sf_dir):
    path = fresh_path(spark, "orders") + ".csv"
    orders = table(spark, sf_dir, "orders")
    tables.write_csv(orders, path)
    return tables.read_csv_table(spark, path, orders.schema, multiline=False).select(
        "o_orderkey", "o_orderpriority")


@query("""
SELECT 'csv' AS form, c_custkey, c_mktsegment FROM customer
UNION ALL SELECT 'parquet', c_custkey, c_mktsegment FROM customer""")
def read_table_by_suffix(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    path = fresh_path(spark, "customer")
    tables.write_csv(customers, path + ".csv")
    tables.write_parquet_gzip(customers, path + ".parquet.gzip")
    text = tables.read_table(spark, path + ".csv", "c_custkey long, c_mktsegment string")
    binary = tables.read_table(spark, path + ".parquet.gzip")
    return text.withColumn("form", F.lit("csv")).unionByName(
        binary.withColumn("form", F.lit("parquet")))


@query("SELECT * FROM part")
def parquet_gzip_sink(spark, sf_dir):
    path = fresh_path(spark, "part") + ".parquet.gzip"
    tables.write_parquet_gzip(table(spark, sf_dir, "part"), path)
    return tables.read_table(spark, path)


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def convert_there_and_back(spark, sf_dir):
    path = fresh_path(spark, "supplier")
    suppliers = table(spark, sf_dir, "supplier")
    tables.write_csv(suppliers, path + ".csv")
    packed = tables.convert(spark, path + ".csv", schema=suppliers.schema)
    unpacked = tables.convert(spark, packed, path + "-back")
    return tables.read_table(spark, unpacked, suppliers.schema)


@query("""
SELECT function, arg_max(category, line) AS category
FROM (SELECT trim(p_name) AS function, trim(p_type) AS category, p_partkey AS line FROM part)
WHERE function <> '' GROUP BY function""")
def load_vocabulary(spark, sf_dir):
    lines = table(spark, sf_dir, "part").select(
        F.concat(F.lit(" "), "p_name").alias("function"), F.col("p_type").alias("category"),
        "p_partkey")
    return tables.load_vocab(lines, with_category=True, order="p_partkey")


@query("""
SELECT 'nl_customer' AS name, 'exported' AS status, count(*) AS rows FROM customer
UNION ALL SELECT 'nl_orders', 'exported', count(*) FROM orders
UNION ALL SELECT 'nl_absent', 'missing', NULL""")
def export_catalog_tables(spark, sf_dir):
    for name in ("customer", "orders"):
        table(spark, sf_dir, name).createOrReplaceTempView(f"nl_{name}")
    report = tables.export_tables(
        spark, ["nl_customer, nl_orders", "nl_customer,nl_absent"], fresh_path(spark, "export"))
    return report.select("name", "status", "rows")


@query("""
SELECT 'customer' AS name, c_custkey AS key, c_name AS text, c_acctbal AS amount FROM customer
UNION ALL SELECT 'orders', o_orderkey, o_orderpriority, o_totalprice FROM orders
UNION ALL SELECT 'supplier', s_suppkey, s_name, s_acctbal FROM supplier""")
def exported_tables_read_back(spark, sf_dir):
    """Three tables, written side by side."""
    columns = {"customer": "c_custkey, c_name, c_acctbal", "supplier": "s_suppkey, s_name, s_acctbal",
               "orders": "o_orderkey, o_orderpriority, o_totalprice"}
    for name, listed in columns.items():
        table(spark, sf_dir, name).selectExpr(*[
            f"{c} as {alias}" for c, alias in zip(listed.split(", "), ("key", "text", "amount"))
        ]).createOrReplaceTempView(f"nl_back_{name}")
    path = fresh_path(spark, "export")
    tables.export_tables(spark, [f"nl_back_{name}" for name in columns], path)
    read = [tables.read_csv_table(spark, f"{path}/nl_back_{name}.csv",
                                  "key long, text string, amount double").withColumn("name", F.lit(name))
            for name in columns]
    return read[0].unionByName(read[1]).unionByName(read[2])


@query("""
SELECT event_id AS id, 'u' || user_id || '/r' AS repo_name,
       'https://github.com/u' || user_id || '/r/blob/main/' || event_type || '.ipynb' AS file_url,
       event_type AS keyword
FROM events ORDER BY event_id LIMIT 100 OFFSET 50""")
def page_of_hits(spark, sf_dir):
    return tables.page(event_hits(spark, sf_dir), limit=100, offset=50)


@query("""
SELECT event_id AS id, 'u' || user_id || '/r' AS repo_name,
       'https://github.com/u' || user_id || '/r/blob/main/' || event_type || '.ipynb' AS file_url,
       event_type AS keyword
FROM events ORDER BY event_id OFFSET 500""")
def page_to_the_end(spark, sf_dir):
    return tables.page(event_hits(spark, sf_dir), limit=0, offset=500)


_PAGED = """
SELECT {} AS page, event_id AS id, 'u' || user_id || '/r' AS repo_name,
       'https://github.com/u' || user_id || '/r/blob/main/' || event_type || '.ipynb' AS file_url,
       event_type AS keyword
FROM (SELECT * FROM events ORDER BY event_id LIMIT {} OFFSET {})"""
_PAGES = ((1, 100, 50), (2, 700, 300), (3, 0, 900))


@query(" UNION ALL ".join(_PAGED.format(n, limit or "NULL", offset) for n, limit, offset in _PAGES))
def pages_of_stored_hits(spark, sf_dir):
    """Stored in two runs: hits after the middle, about, are appended to a table that is there."""
    hits, path = event_hits(spark, sf_dir), fresh_path(spark, "paged")
    size = paging.rows_per_folder(hits.count(), 256)
    # Any id parts the runs as well as the exact middle, which would gather all ids in one task.
    middle = F.lit(next(iter(hits.approxQuantile("id", [0.5], 0.01)), None))
    paging.write_paged(hits.where(F.col("id") <= middle), path, size)
    paging.append_paged(hits.where(F.col("id") > middle), path, size)
    pages = [paging.read_page(spark, path, limit, offset, size).withColumn("page", F.lit(n))
             for n, limit, offset in _PAGES]
    return pages[0].unionByName(pages[1]).unionByName(pages[2])


@query("""
SELECT event_id, user_id, event_type, props FROM events
UNION ALL SELECT event_id, user_id, event_type, props FROM events""")
def append_after_truncate(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "props")
    path = fresh_path(spark, "events") + ".csv"
    for mode in ("overwrite", "overwrite", "append"):
        tables.write_csv(events, path, mode)
    return tables.read_csv_table(spark, path, events.schema)


@query("""
SELECT doc_id, lang FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def skip_existing_rows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return tables.skip_existing(docs, table(spark, sf_dir, "labels"), "doc_id")


@query("""
SELECT count(*) FILTER (l.doc_id IS NOT NULL) AS skipped,
       count(*) FILTER (l.doc_id IS NULL) AS written
FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON l.doc_id = d.doc_id""")
def skipped_rows(spark, sf_dir):
    return tables.skipped_count(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id")


@query("""
SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders""")
def missing_keys(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return tables.missing_names(table(spark, sf_dir, "customer"), orders, "c_custkey")


@query("SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def documents_without_labels(spark, sf_dir):
    return tables.missing_names(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id")


# ---- aggregates -------------------------------------------------------------------------------

LINE_METRICS = ["quantity", "linenumber", "cents"]
_LINES = """
(SELECT cast(l_orderkey AS VARCHAR) AS notebook_hash, cast(l_partkey AS VARCHAR) AS cell_id,
        cast(l_quantity AS BIGINT) AS quantity, cast(l_linenumber AS BIGINT) AS linenumber,
        cast(round(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem)"""


def line_cells(spark, sf_dir):
    """Line items as metric rows: the order is the notebook, integer columns the metrics."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("notebook_hash"),
        F.col("l_partkey").cast("string").alias("cell_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("l_linenumber").cast("bigint").alias("linenumber"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"),
    )


@query(f"""
SELECT notebook_hash, count(cell_id) AS n_cells, cast(sum(quantity) AS BIGINT) AS quantity,
       max(linenumber) AS linenumber, cast(sum(cents) AS BIGINT) AS cents
FROM {_LINES} GROUP BY notebook_hash""")
def notebook_rollup_lines(spark, sf_dir):
    return agg.notebook_rollup(line_cells(spark, sf_dir), LINE_METRICS, peaks=["linenumber"])


def _describe_sql(source, columns):
    return " UNION ALL ".join(f"""
SELECT '{c}' AS "column", count({c}) AS "count", round(avg({c}), 6) AS mean,
       round(stddev_samp({c}), 4) AS std, cast(min({c}) AS DOUBLE) AS "min",
       quantile_cont(cast({c} AS DOUBLE), 0.25) AS q25,
       quantile_cont(cast({c} AS DOUBLE), 0.5) AS q50,
       quantile_cont(cast({c} AS DOUBLE), 0.75) AS q75, cast(max({c}) AS DOUBLE) AS "max"
FROM {source}""" for c in columns)


@query(_describe_sql(_LINES, LINE_METRICS))
def describe_lines(spark, sf_dir):
    stats = agg.describe(line_cells(spark, sf_dir), LINE_METRICS)
    return stats.withColumns({"mean": F.round("mean", 6), "std": F.round("std", 4)})


_ROLLED = """(SELECT cast(l_orderkey AS VARCHAR) AS nb, count(*) AS n_cells,
        cast(sum(cast(l_quantity AS BIGINT)) AS BIGINT) AS quantity
        FROM lineitem GROUP BY l_orderkey)"""


@query(f"""
SELECT "statistic", max(CASE WHEN c = 'n_cells' THEN v END) AS n_cells,
       max(CASE WHEN c = 'quantity' THEN v END) AS quantity
FROM (UNPIVOT ({"UNION ALL ".join(f"""
  SELECT '{c}' AS c, cast(count(*) AS DOUBLE) AS "count", round(avg({c}), 6) AS mean,
         round(stddev_samp({c}), 4) AS std, cast(min({c}) AS DOUBLE) AS "min",
         quantile_cont(cast({c} AS DOUBLE), 0.25) AS q25,
         quantile_cont(cast({c} AS DOUBLE), 0.5) AS q50,
         quantile_cont(cast({c} AS DOUBLE), 0.75) AS q75, cast(max({c}) AS DOUBLE) AS "max"
  FROM {_ROLLED} """ for c in ("n_cells", "quantity"))})
  ON "count", mean, std, "min", q25, q50, q75, "max" INTO NAME "statistic" VALUE v)
GROUP BY "statistic" """)
def describe_notebooks_wide(spark, sf_dir):
    rolled = agg.notebook_rollup(line_cells(spark, sf_dir), ["quantity"], peaks=[])
    wide = agg.describe_wide(rolled, ["n_cells", "quantity"])
    rounded = {c: F.when(F.col("statistic") == "std", F.round(c, 4)).otherwise(F.round(c, 6))
               for c in ("n_cells", "quantity")}
    return wide.withColumns(rounded)


@query(" UNION ALL ".join(f"""
SELECT 'price' AS "column", cast({p} AS DOUBLE) AS p,
       round(quantile_cont(l_extendedprice, {p}), 6) AS value FROM lineitem"""
                          for p in agg.QUARTILES))
def price_quartiles(spark, sf_dir):
    prices = table(spark, sf_dir, "lineitem").select(F.col("l_extendedprice").alias("price"))
    return agg.quartiles(prices, ["price"]).withColumn("value", F.round("value", 6))


_FENCES = """
SELECT q25, q50, q75, q25 - 1.5 * (q75 - q25) AS lower, q75 + 1.5 * (q75 - q25) AS upper,
       greatest(q25 - 1.5 * (q75 - q25), 0.0) AS lower_shown
FROM (SELECT quantile_cont(v, 0.25) AS q25, quantile_cont(v, 0.5) AS q50,
             quantile_cont(v, 0.75) AS q75
      FROM (SELECT cast(floor(value) AS DOUBLE) AS v FROM events))"""


def _event_values(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", F.floor("value").alias("value"))


@query(_FENCES)
def outlier_fences(spark, sf_dir):
    return agg.iqr_fences(_event_values(spark, sf_dir), "value")


@query(f"""
SELECT event_id, cast(floor(value) AS BIGINT) AS value FROM events, ({_FENCES}) f
WHERE floor(value) BETWEEN f.lower AND f.upper""")
def inside_fences(spark, sf_dir):
    return agg.iqr_filter(_event_values(spark, sf_dir), "value")


@query("""
SELECT count(*) AS "rows", count(*) FILTER (c_acctbal > 0) AS c_acctbal_positive,
       count(*) FILTER (c_nationkey > 0) AS c_nationkey_positive FROM customer""")
def positive_rows(spark, sf_dir):
    return agg.positive_count(table(spark, sf_dir, "customer"), ["c_acctbal", "c_nationkey"])


@query(f"""
SELECT cast(sum(quantity) AS BIGINT) AS quantity_total, cast(sum(cents) AS BIGINT) AS cents_total
FROM {_LINES}""")
def metric_totals(spark, sf_dir):
    return agg.totals(line_cells(spark, sf_dir), ["quantity", "cents"])


@query("""
SELECT count(*) AS "rows", round(avg(l_linenumber / l_quantity), 9) AS mean_ratio
FROM lineitem WHERE l_quantity > 0""")
def mean_of_ratios(spark, sf_dir):
    ratio = agg.mean_ratio(table(spark, sf_dir, "lineitem"), "l_linenumber", "l_quantity")
    return ratio.withColumn("mean_ratio", F.round("mean_ratio", 9))


@query("SELECT count(DISTINCT o_custkey) AS repositories FROM orders")
def distinct_repositories(spark, sf_dir):
    return agg.distinct_count(table(spark, sf_dir, "orders"), "o_custkey", "repositories")


_PART_COUNTS = """(SELECT cast(l_partkey AS VARCHAR) AS "function", count(*) AS "count"
                   FROM lineitem GROUP BY l_partkey)"""


def part_counts(spark, sf_dir):
    """Line items per part, in the role of calls per function."""
    return table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_partkey").cast("string").alias("function")).agg(F.count(F.lit(1)).alias("count"))


@query(f"""
SELECT "function", "count",
       round_even("count" / (SELECT sum("count") FROM {_PART_COUNTS}) * 100 * 100, 0) / 100
         AS percentage
FROM {_PART_COUNTS}""")
def share_of_calls(spark, sf_dir):
    return agg.share_of_total(part_counts(spark, sf_dir), "count")


@query("""
SELECT CASE role WHEN 'user' THEN 'code' WHEN 'assistant' THEN 'markdown' ELSE 'raw' END AS cell_type,
       count(*) AS n FROM conversations GROUP BY 1""")
def cells_per_type(spark, sf_dir):
    return agg.cell_type_counts(conversation_cells(spark, sf_dir))


def _histogram_sql(source, x):
    return f"""
SELECT bin, lo + bin * (hi - lo) / b AS "left", lo + (bin + 1) * (hi - lo) / b AS "right",
       count(*) AS n
FROM (SELECT cast(least(floor((x - lo) * b / (hi - lo)), b - 1) AS BIGINT) AS bin, lo, hi, b
      FROM (SELECT cast({x} AS DOUBLE) AS x FROM {source}),
           (SELECT cast(min({x}) AS DOUBLE) AS lo, cast(max({x}) AS DOUBLE) AS hi,
                   floor(max({x})) AS b FROM {source}))
GROUP BY bin, lo, hi, b"""


def _edges(hist):
    return hist.withColumns({"left": F.round("left", 9), "right": F.round("right", 9)})


def _rounded_edges(sql):
    return f'SELECT bin, round("left", 9) AS "left", round("right", 9) AS "right", n FROM ({sql})'


@query(_rounded_edges(_histogram_sql("part", "p_size")))
def size_histogram(spark, sf_dir):
    return _edges(agg.histogram(table(spark, sf_dir, "part"), "p_size"))


@query(_rounded_edges(_histogram_sql("lineitem", "l_quantity")))
def quantity_histogram(spark, sf_dir):
    return _edges(agg.histogram(table(spark, sf_dir, "lineitem"), "l_quantity"))


@query(" UNION ALL ".join(f"""
SELECT '{c}' AS "column", '{t}' AS "type", count({c}) AS non_null, count(*) AS "rows" FROM orders"""
                          for c, t in (("o_orderkey", "bigint"), ("o_custkey", "bigint"),
                                       ("o_orderstatus", "string"), ("o_totalprice", "double"),
                                       ("o_orderdate", "date"), ("o_orderpriority", "string"))))
def orders_profile(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    # Stored as a time without a zone, shown as the day it names.
    return agg.table_profile(orders.withColumn("o_orderdate", F.to_date("o_orderdate")))


# ---- position in the notebook -----------------------------------------------------------------

_BINS = """
FROM (SELECT p, n, flag, unnest(range((p * 100 + n - 1) // n, ((p + 1) * 100 + n - 1) // n)) AS bin
      FROM (SELECT flag, row_number() OVER (PARTITION BY conv_id ORDER BY turn, flag) - 1 AS p,
                   count(*) OVER (PARTITION BY conv_id) AS n
            FROM (SELECT conv_id, turn, cast({flag} AS BIGINT) AS flag FROM conversations
                  WHERE role IN ('user', 'assistant'))))
GROUP BY bin"""
_CURVE = """SELECT bin, cast(sum(flag) AS BIGINT) AS text_count,
       cast(sum(1 - flag) AS BIGINT) AS code_count,
       cast(sum(flag) AS BIGINT) / count(*) * 100 AS text_pct """ + _BINS.replace(
    "{flag}", "role = 'assistant'")


def conversation_sides(spark, sf_dir):
    cells = conversation_cells(spark, sf_dir).withColumn(
        "long", (F.length("source") > 400).cast("int"))
    of = lambda kind: cells.where(F.col("cell_type") == kind)
    return of("code"), of("markdown")


@query("""SELECT bin, cast(sum(flag) AS BIGINT) AS hits, count(*) AS notebooks,
       cast(sum(flag) AS BIGINT) / count(*) * 100 AS pct """ + _BINS.replace(
    "{flag}", "role = 'user' AND length(text) > 400"))
def long_code_curve(spark, sf_dir):
    return position.position_curve(*conversation_sides(spark, sf_dir), "long")


@query(_CURVE)
def type_ratio(spark, sf_dir):
    return position.type_ratio_curve(*conversation_sides(spark, sf_dir))


@query(_CURVE)
def type_ratio_without_positions(spark, sf_dir):
    """Code cells have NULL positions, markdown cells no such column: the ids order them."""
    code, md = conversation_sides(spark, sf_dir)
    bare = lambda df: df.withColumn("cell_pos", F.lit(None).cast("int"))
    return position.type_ratio_curve(bare(code), md.drop("cell_pos"))


@query(f"SELECT median(text_pct) AS median FROM ({_CURVE})")
def type_ratio_median(spark, sf_dir):
    return position.curve_median(position.type_ratio_curve(*conversation_sides(spark, sf_dir)))


@query("""
SELECT bin, cast(sum(flag) AS BIGINT) AS hits, count(*) AS notebooks,
       cast(sum(flag) AS BIGINT) / count(*) * 100 AS pct
FROM (SELECT flag, unnest(range((p * 100 + n - 1) // n, ((p + 1) * 100 + n - 1) // n)) AS bin
      FROM (SELECT cast(o_totalprice > 200000 AS BIGINT) AS flag,
                   row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS p,
                   count(*) OVER (PARTITION BY o_custkey) AS n FROM orders))
GROUP BY bin""")
def order_position_curve(spark, sf_dir):
    cells = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("notebook_hash"), F.col("o_orderkey").alias("cell_pos"),
        (F.col("o_totalprice") > 200000).cast("int").alias("dear"))
    return position.position_curve(cells, cells.limit(0), "dear")


@query("""
SELECT conv_id || '' AS notebook_hash, turn || '' AS cell_id,
       row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS cell_pos
FROM conversations""")
def cells_ordered_by_id(spark, sf_dir):
    ids = conversation_cells(spark, sf_dir).select("notebook_hash", "cell_id")
    return with_cell_pos(ids)


# ---- rankings ---------------------------------------------------------------------------------


@query(f"""
SELECT "function", "count", row_number() OVER (ORDER BY "count" DESC, "function") AS "rank"
FROM {_PART_COUNTS}""")
def ranked_calls(spark, sf_dir):
    return ranking.rank_ops(part_counts(spark, sf_dir))


@query(f'SELECT * FROM {_PART_COUNTS} ORDER BY "count" DESC, "function" LIMIT 15')
def most_called(spark, sf_dir):
    return ranking.top_k(part_counts(spark, sf_dir), "count", 15, ["function"])


@query(f'SELECT * FROM {_PART_COUNTS} ORDER BY "count", "function" DESC LIMIT 15')
def least_called(spark, sf_dir):
    return ranking.bottom_k(part_counts(spark, sf_dir), "count", 15, ["function"])


@query(f'SELECT * FROM {_PART_COUNTS} ORDER BY "function"')
def calls_by_name(spark, sf_dir):
    return ranking.by_name(part_counts(spark, sf_dir))


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders "
       "ORDER BY o_totalprice DESC, o_orderkey LIMIT 1")
def peak_order(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return ranking.argmax_row(orders, "o_totalprice", ["o_orderkey"])


@query("""
SELECT l_orderkey, l_partkey, l_extendedprice FROM lineitem WHERE l_orderkey =
  (SELECT l_orderkey FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey LIMIT 1)""")
def peak_notebook_cells(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    peak = ranking.argmax_row(lines, "l_extendedprice", ["l_orderkey"])
    return ranking.drill_down(lines, peak, "l_orderkey")


@query("SELECT conv_id, turn, role, text FROM conversations ORDER BY conv_id, turn LIMIT 5")
def preview_cells(spark, sf_dir):
    cells = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return ranking.preview(cells, ["conv_id", "turn"])


@query("SELECT conv_id, turn, role FROM conversations ORDER BY conv_id, turn, role")
def sorted_cells(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role").orderBy(
        "conv_id", "turn", "role")


# ---- joins ------------------------------------------------------------------------------------


@query("""
SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def documents_with_labels(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return docs.join(
        table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"), "doc_id", "left")


@query("""
SELECT n_name, count(*) AS orders FROM orders
JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY n_name""")
def orders_per_nation(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey")
    # Orders shrink to one row per customer before they meet the other tables.
    per_customer = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("orders"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return (per_customer.join(customers, "c_custkey").join(nations, "c_nationkey")
            .groupBy("n_name").agg(F.sum("orders").alias("orders")))


@query("""
SELECT doc_id FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def vocabulary_members(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id").join(
        table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")


@query("""
SELECT n_nationkey AS k FROM nation UNION SELECT cast(c_nationkey AS INTEGER) FROM customer""")
def union_of_keys(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"))
    customers = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k"))
    return nations.union(customers).distinct()


@query("""
SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id
FROM events GROUP BY user_id""")
def last_event_per_user(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id")
    return keep_last(events, ["user_id"], ["event_id"])
