"""The whole way from notebook files to corpus statistics.

Every step writes a table and the next one reads it: a lost executor costs a task, a lost driver
costs the step it was in, and cells are parsed exactly once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from notelake.operators.aggregates import describe, notebook_rollup, op_summary
from notelake.operators.cells import explode_cells
from notelake.operators.curate import parse_repo_url
from notelake.operators.metrics import cell_facts, metrics_of, vocabulary
from notelake.operators.position import position_curves, type_ratio_curve
from notelake.plans import jobs
from notelake.schemas import METRICS, OP_COUNTS
from notelake.sources.notebooks import scan_notebooks
from notelake.sources.tables import load_vocab, read_csv_table, write_csv

CURVES = ("I", "V", "TC")


def flatten(spark: SparkSession, notebooks: str, out: str,
            mode: str = "errorifexists") -> dict[str, int]:
    """Notebook files -> ``cells``, one folder per cell type; one pass over the files.

    Returns the cells per type, counted by the job that writes them.
    """
    seen = Observation()
    cells = explode_cells(scan_notebooks(spark, notebooks))
    kept = cells.where(F.col("cell_type").isin("code", "markdown")).observe(seen, *[
        F.count_if(F.col("cell_type") == kind).alias(kind) for kind in ("code", "markdown")])
    kept.write.mode(mode).partitionBy("cell_type").parquet(f"{out}/cells")
    return dict(seen.get)


def cells_of(spark: SparkSession, out: str, kind: str) -> DataFrame:
    return spark.read.parquet(f"{out}/cells").where(F.col("cell_type") == kind).drop("cell_type")


def measure(spark: SparkSession, out: str, pandas: DataFrame, mpl: DataFrame, seaborn: DataFrame,
            mode: str = "errorifexists") -> dict[str, int]:
    """``cells`` -> ``code_cells_metrics`` (with the called operations) and the operation summary.

    Returns the rows and parse errors, counted by the job that writes the metrics.
    """
    seen = Observation()
    facts = cell_facts(cells_of(spark, out, "code"), vocabulary(pandas, mpl, seaborn))
    measured = metrics_of(facts, extra=[F.col("facts.op").alias("ops")]).observe(
        seen, F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("parse_error").isNotNull()).alias("parse_errors"))
    measured.write.mode(mode).parquet(f"{out}/code_cells_metrics")
    counts = (
        metrics_table(spark, out).select(F.explode("ops").alias("op"))
        .groupBy(F.col("op.name").alias("function")).agg(F.sum("op.times").alias("count"))
    )
    write_csv(op_summary(load_vocab(pandas, with_category=True), counts), f"{out}/pandas_ops_count.csv", mode)
    return dict(seen.get)


def metrics_table(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(f"{out}/code_cells_metrics")


def summarise(spark: SparkSession, out: str, mode: str = "errorifexists") -> None:
    """Roll-up per notebook, distributions, chain lengths, call ranks, the peak notebook, curves."""
    measured = metrics_table(spark, out)
    notebook_rollup(measured).write.mode(mode).parquet(f"{out}/notebook_metrics")
    notebooks = spark.read.parquet(f"{out}/notebook_metrics")
    stats = describe(measured, METRICS, 2).withColumn("per", F.lit("cell")).unionByName(
        describe(notebooks, ["n_cells", *METRICS], 2).withColumn("per", F.lit("notebook")))
    write_csv(stats, f"{out}/statistics.csv", mode)
    md = cells_of(spark, out, "markdown")
    curves = position_curves(measured, md, CURVES)
    write_csv(curves.orderBy("metric", "bin"), f"{out}/position_curves.csv", mode)
    write_csv(jobs.chain_numbers(measured), f"{out}/chain_lengths.csv", mode)
    calls = read_csv_table(spark, f"{out}/pandas_ops_count.csv", OP_COUNTS, multiline=False)
    write_csv(jobs.call_ranking(calls), f"{out}/call_ranking.csv", mode)
    for name, table in zip(("fences", "histogram"), jobs.size_distribution(notebooks)):
        write_csv(table, f"{out}/cells_per_notebook_{name}.csv", mode)
    peak = jobs.peak_notebook(notebooks, measured, "PO")
    peak.drop("ops").write.mode(mode).parquet(f"{out}/peak_notebook")
    ratio = type_ratio_curve(cells_of(spark, out, "code"), md)
    write_csv(ratio.orderBy("bin"), f"{out}/type_ratio.csv", mode)


def check_sources(spark: SparkSession, out: str, links: DataFrame, responses: DataFrame,
                  mode: str = "errorifexists") -> None:
    """Links and captured trees -> ``csv_counts``, ``csv_files`` and the sizes of the corpus."""
    counts, files = jobs.check_repositories(links, responses)
    counts.write.mode(mode).parquet(f"{out}/csv_counts")
    files.write.mode(mode).parquet(f"{out}/csv_files")
    sizes = jobs.corpus_sizes(
        spark.read.parquet(f"{out}/notebook_metrics"),
        parse_repo_url(links).where("repo_name is not null"), spark.read.parquet(f"{out}/csv_counts"))
    write_csv(sizes.orderBy("name"), f"{out}/corpus_sizes.csv", mode)


def build_corpus(spark: SparkSession, notebooks: str, out: str, pandas: DataFrame, mpl: DataFrame,
                 seaborn: DataFrame, mode: str = "errorifexists", links: DataFrame | None = None,
                 responses: DataFrame | None = None) -> dict[str, int]:
    """All steps; with links (repo_url) and captured trees the repositories are checked as well.

    Returns what the writing jobs counted: code and markdown cells, rows measured, parse errors.
    """
    counted = flatten(spark, notebooks, out, mode)
    counted |= measure(spark, out, pandas, mpl, seaborn, mode)
    summarise(spark, out, mode)
    if links is not None and responses is not None:
        check_sources(spark, out, links, responses, mode)
    return counted
