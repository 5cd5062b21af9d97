"""Scan of notebook files, as a batch or as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Fixed value: the rows of Spark's binary file source; a stream needs them spelled out.
FILE_ROWS = "path string, modificationTime timestamp, length long, content binary"


def resolved_root(spark: SparkSession, directory: str) -> str:
    """The folder as the file system names it, without "." and ".."; of a pattern its fixed part."""
    path = spark._jvm.org.apache.hadoop.fs.Path(directory)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    full = path.makeQualified(system.getUri(), system.getWorkingDirectory()).toString()
    fixed = []
    for part in full.split("/"):
        if any(mark in part for mark in "*?[{"):
            break
        fixed.append(part)
    return "/".join(fixed)


def relative_name(path: Column, root: str) -> Column:
    """Path below the resolved ``root``; the base name where the file lies elsewhere."""
    folder = root.rstrip("/") + "/"
    return F.when(F.startswith(path, F.lit(folder)), F.substr(path, F.lit(len(folder) + 1))
                  ).otherwise(F.substring_index(path, "/", -1))


def scan_notebooks(spark: SparkSession, directory: str, streaming: bool = False,
                   max_files: int | None = None, pattern: str = "*.ipynb") -> DataFrame:
    """(notebook_hash, content) of all notebook files below ``directory``, at any depth.

    ``notebook_hash`` is the relative path. ``content`` is binary, so that text that is no valid
    UTF-8 can be told apart later.
    """
    reader = spark.readStream if streaming else spark.read
    if streaming and max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    files = (
        reader.format("binaryFile")
        .schema(FILE_ROWS)
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(directory)
    )
    return files.select(
        relative_name(F.col("path"), resolved_root(spark, directory)).alias("notebook_hash"),
        "content")
