"""Session settings shared by the operators: the shared folder and fresh paths inside it."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder; on a cluster a missing setting
    is an error, because a machine-local folder would not survive the loss of an executor.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="notelake-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no earlier run has used."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


# So many rows at most, about, make a task of ``spread``.
ROWS_PER_TASK = 50_000


def spread(scan: DataFrame) -> DataFrame:
    """Deal the rows of a scan evenly, ahead of work that is heavy on the CPU.

    There is a partition per core at least, and one per ``ROWS_PER_TASK`` rows, so that no task grows
    with the table, however its files and row groups are cut. Meant for frames read straight from
    files, whose rows are counted from the footers.
    """
    if scan.isStreaming:
        return scan
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(max(cores, -(-scan.count() // ROWS_PER_TASK)))
