"""Table sources and sinks: CSV, Parquet, vocabularies, export, paging."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from notelake.operators.ordering import global_index
from notelake.sources.paging import PAGE_TEXTS, page_columns

# CSV dialect (minimal quoting, doubled quotes) that returns every text unchanged.
DIALECT = {
    "header": True, "quote": '"', "escape": '"', "nullValue": r"\N",
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}
READING = {**DIALECT, "emptyValue": "", "multiLine": True}
# Texts that look like the mark of a missing value are written with one more backslash.
MARKED = r"^\\+N\z"


def _schema(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names in the header line of a CSV table."""
    return spark.read.options(**READING).csv(path).columns


def read_csv_table(
    spark: SparkSession, path: str, schema: T.StructType | str,
    required: Sequence[str] | None = None, multiline: bool = True,
) -> DataFrame:
    """CSV with a header and quoted multi-line cells; missing required columns are an error.

    Columns are found by name. Those of the schema that the file lacks are NULL, unless required.
    Without ``multiline`` no text may hold a line break, and a large file is read by many tasks.
    """
    wanted = _schema(schema)
    header = csv_header(spark, path)
    missing = sorted(set(wanted.names if required is None else required) - set(header))
    if missing:
        raise ValueError(f"missing columns {missing} in {path}")
    types = {f.name: f.dataType for f in wanted.fields}
    as_stored = T.StructType([
        T.StructField(name, types.get(name, T.StringType())) for name in header
    ])
    table = spark.read.schema(as_stored).options(**READING | {"multiLine": multiline}).csv(path)

    def as_written(field: T.StructField) -> Column:
        if field.name not in header:
            return F.lit(None).cast(field.dataType).alias(field.name)
        text = F.col(f"`{field.name}`")
        if not isinstance(field.dataType, T.StringType):
            return text
        return F.when(text.rlike(MARKED), F.substr(text, F.lit(2))).otherwise(text).alias(field.name)

    return table.select(*map(as_written, wanted.fields))


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """CSV when the name ends so, else Parquet; a missing path is an error.

    CSV columns are text unless a schema is given.
    """
    if not path.rstrip("/").lower().endswith(".csv"):
        return spark.read.parquet(path)
    if schema is not None:
        return read_csv_table(spark, path, schema)
    text = T.StructType([T.StructField(n, T.StringType()) for n in csv_header(spark, path)])
    return read_csv_table(spark, path, text)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    def marked(field: T.StructField) -> Column:
        text = F.col(f"`{field.name}`")
        if not isinstance(field.dataType, T.StringType):
            return text
        return F.when(text.rlike(MARKED), F.concat(F.lit("\\"), text)).otherwise(text).alias(
            field.name)

    df.select(*map(marked, df.schema.fields)).write.mode(mode).options(**DIALECT).csv(path)


def write_parquet_gzip(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("compression", "gzip").parquet(path)


def convert(
    spark: SparkSession, src: str, dst: str | None = None,
    schema: T.StructType | str | None = None,
) -> str:
    """CSV to gzip Parquet or back; the output name follows from ``dst`` or the input name."""
    if src.lower().endswith(".csv"):
        out = (dst or src[: -len(".csv")]) + ".parquet.gzip"
        write_parquet_gzip(read_table(spark, src, schema), out)
    else:
        out = (dst or src.removesuffix(".parquet.gzip")) + ".csv"
        write_csv(read_table(spark, src), out)
    return out


def load_vocab(df: DataFrame, with_category: bool = False, order: str | None = None) -> DataFrame:
    """Trimmed, non-empty, distinct functions; the last line of a function sets its category."""
    function = F.trim(F.coalesce("function", F.lit(""))).alias("function")
    if not with_category:
        return df.select(function).where("function != ''").distinct()
    line = F.monotonically_increasing_id() if order is None else F.col(order)
    return (
        df.select(function, F.trim(F.coalesce("category", F.lit(""))).alias("category"),
                  line.alias("line"))
        .where("function != ''")
        .groupBy("function").agg(F.max_by("category", "line").alias("category"))
    )


def table_names(names: Iterable[str] | None) -> list[str] | None:
    """Names from comma lists: trimmed, without blanks and repeats, in order."""
    if names is None:
        return None
    listed = (part.strip() for entry in names for part in str(entry).split(","))
    return list(dict.fromkeys(name for name in listed if name))


def export_tables(
    spark: SparkSession, names: Iterable[str] | None, directory: str, overwrite: bool = False,
    include_views: bool = False, at_once: int = 4,
) -> DataFrame:
    """Write catalog tables as CSV; one report row (name, status, rows, error) per name.

    Without names all tables are exported, and views too if asked for. A missing name or a failed
    export is reported and does not stop the others. ``at_once`` tables are written side by side, each
    in a pool of its own, so with ``spark.scheduler.mode=FAIR`` a large one does not hold up the rest.
    The report keeps the order of the names.
    """
    catalog = {t.name: t.tableType for t in spark.catalog.listTables()}
    wanted = table_names(names) or sorted(
        n for n, kind in catalog.items() if include_views or kind not in ("VIEW", "TEMPORARY")
    )

    def export(name: str) -> tuple:
        if name not in catalog:
            return name, "missing", None, None
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"export-{name}")
        seen = Observation()
        try:
            table = spark.table(f"`{name}`").observe(seen, F.count(F.lit(1)).alias("rows"))
            write_csv(table, f"{directory.rstrip('/')}/{name}.csv",
                      "overwrite" if overwrite else "errorifexists")
            return name, "exported", seen.get["rows"], None
        except Exception as problem:  # reported per table, whatever the cause
            text = str(problem)
            if isinstance(problem, AnalysisException):
                text = problem.getCondition() or text
            return name, "failed", None, text
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    # Each thread has its own copy of the caller's properties.
    with ThreadPoolExecutor(max(1, at_once)) as pool:
        jobs = [pool.submit(inheritable_thread_target(spark)(export), name) for name in wanted]
        report = [job.result() for job in jobs]
    return spark.createDataFrame(report, "name string, status string, rows long, error string")


def page(hits: DataFrame, limit: int | None = None, offset: int = 0) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` by id, in order; no limit when it is missing or not
    positive.

    Rows without a link are dropped after paging; other NULL texts become "". For more than a page or
    two of one table, store it with ``paging.write_paged``.
    """
    # One plan for every page: a plain OFFSET or a large LIMIT would send all rows through one task.
    at = F.col("_index")
    inside = at >= offset
    if limit is not None and limit > 0:
        inside &= at < offset + limit
    rows = global_index(hits.select("id", *PAGE_TEXTS), [F.col("id")], "_index").where(inside)
    return page_columns(rows.orderBy("_index"))


def skip_existing(
    df: DataFrame, target: DataFrame | None, key: str = "hash", overwrite: bool = False
) -> DataFrame:
    """Rows whose key the target does not hold; with ``overwrite`` all rows."""
    if overwrite or target is None:
        return df
    return df.join(target.select(key), key, "left_anti")


def skipped_count(df: DataFrame, target: DataFrame, key: str = "hash") -> DataFrame:
    """How many rows were already there and how many are new."""
    # One row per key on both sides of the join, however often a key occurs.
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    known = target.select(key).distinct().withColumn("known", F.lit(True))
    sums = {"skipped": F.col("known"), "written": F.col("known").isNull()}
    return per_key.join(known, key, "left").agg(*[
        F.coalesce(F.sum(F.when(which, F.col("n"))), F.lit(0)).alias(name)
        for name, which in sums.items()
    ])


def missing_names(wanted: DataFrame, present: DataFrame, col: str) -> DataFrame:
    """Distinct values of ``col`` that ``present`` lacks."""
    return wanted.select(col).subtract(present.select(col))


def write_notebooks(df: DataFrame, directory: str, documents: bool = False) -> None:
    """Rebuilt notebooks as Parquet rows, or with ``documents`` as one folder of text per notebook.

    The lines of a folder, files in order of their names, are the document. A large notebook may
    have several files, none of which is gathered from more than a range of lines.
    """
    ranged = df.repartitionByRange("notebook_hash", "line").sortWithinPartitions(
        "notebook_hash", "line")
    if not documents:
        ranged.write.mode("errorifexists").parquet(directory)
        return
    ranged.select("notebook_hash", F.col("json").alias("value")).write.mode(
        "errorifexists").partitionBy("notebook_hash").text(directory)
