"""Syntax facts stored by the content of a cell: every different text is parsed once, ever.

Cells repeat within a corpus and from run to run. The facts of a cell depend on its code (without magic
lines), the vocabulary and the Python version alone, so they are kept in a table keyed by the hash of the
code, in a folder per vocabulary and version. ``add`` finds the codes that are not there yet (counted once
per task before they are shuffled, so ``df.head()`` in a third of all cells is one row of each task), parses
those and appends them; ``facts_of`` joins all cells with the table. Without a new code no parser is started.

The join is on the hash. A code that fills much of a corpus makes a skewed partition on the side of the
cells, which adaptive execution splits (``spark.sql.adaptive.skewJoin``); the table has each key once.
One run writes a table at a time.
"""

from __future__ import annotations

import hashlib
import sys

from pyspark.sql import DataFrame, functions as F

from notelake.functions.cellsyntax import KINDS, RESULT, Vocabulary, facts_udf
from notelake.operators.metrics import line_metrics, metrics_of
from notelake.session import fresh_path


def fingerprint(vocab: Vocabulary) -> str:
    """Names what facts depend on besides the code."""
    parts = [sys.version_info[:2], KINDS, *map(sorted, (vocab.pandas, vocab.mpl, vocab.seaborn))]
    return hashlib.sha1(repr(parts).encode()).hexdigest()[:16]


class FactsTable:
    def __init__(self, spark, path: str, vocab: Vocabulary):
        self.spark, self.vocab = spark, vocab
        self.folder = f"{path.rstrip('/')}/facts-{fingerprint(vocab)}"
        kind = RESULT if isinstance(RESULT, str) else RESULT.simpleString()
        self.schema = f"key string, facts {kind}"

    def read(self) -> DataFrame:
        """(key, facts); empty before the first run."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        if not hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(hadoop):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.folder)

    def add(self, cells: DataFrame) -> int:
        """Parse the codes of ``cells`` that the table does not have; returns how many."""
        codes = line_metrics(cells).select(F.sha1("code").alias("key"), "code")
        missing = codes.groupBy("key").agg(F.first("code").alias("code")).join(
            self.read().select("key"), "key", "left_anti")
        path = fresh_path(self.spark, "codes")
        missing.write.parquet(path)
        new = self.spark.read.schema("key string, code string").parquet(path)
        count = new.count()
        if count:
            new.select("key", facts_udf(self.vocab)(F.col("code")).alias("facts")).write.mode(
                "append").parquet(self.folder)
        return count

    def facts_of(self, cells: DataFrame) -> DataFrame:
        """What ``cell_facts`` gives, for cells whose codes have been added."""
        keyed = line_metrics(cells).withColumn("_key", F.sha1("code")).drop("code")
        stored = self.read().select(F.col("key").alias("_key"), "facts")
        return keyed.join(stored, "_key", "left").drop("_key").withColumn(
            "parse_error", F.col("facts.error"))


def cell_metrics_once(cells: DataFrame, vocab: Vocabulary, path: str) -> tuple[DataFrame, int]:
    """(metrics of all cells, number of codes that had to be parsed), with the facts table at ``path``."""
    table = FactsTable(cells.sparkSession, path, vocab)
    parsed = table.add(cells)
    return metrics_of(table.facts_of(cells)), parsed
