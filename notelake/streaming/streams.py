"""Incremental forms of the batch operators, as Structured Streaming queries.

Each function starts a query and returns it. State and progress live under the checkpoint path
the caller names, which has to be shared by all executors.
"""

from __future__ import annotations

import json
import sys
import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from notelake.functions.cellsyntax import Vocabulary
from notelake.functions.links import link_key
from notelake.operators.aggregates import op_counts, op_summary
from notelake.operators.cells import explode_cells
from notelake.operators.curate import insert_or_ignore
from notelake.operators.factstore import cell_metrics_once
from notelake.operators.metrics import cell_facts, metrics_of
from notelake.sources.keyindex import may_hold, stored_filters, write_filter
from notelake.sources.notebooks import scan_notebooks
from notelake.sources.tables import load_vocab

# The setting of the state store and its form on disk.
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Functions that run on the executors travel by value, the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _write(df: DataFrame, target: str, checkpoint: str, *folders: str) -> StreamingQuery:
    return (
        df.writeStream.format("parquet").partitionBy(*folders).outputMode("append")
        .option("path", target).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


@contextmanager
def _on_disk(spark: SparkSession):
    """A query that starts in here keeps its state in RocksDB."""
    name, before = STATE_STORE, spark.conf.get(STATE_STORE, None)
    spark.conf.set(name, ROCKS_DB)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


class RunTotals(StreamingQueryListener):
    """Adds up what running streams observe, by name: {"ingested": {"cells": 12, ...}, ...}.

    Register it with ``spark.streams.addListener``; counts come from the batches themselves, no second
    pass is made. A batch that is replayed after a failure counts each time it runs.
    """

    def __init__(self):
        self.totals: dict[str, dict[str, int]] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        for name, row in event.progress.observedMetrics.items():
            sums = self.totals.setdefault(name, {})
            for key, value in row.asDict().items():
                sums[key] = sums.get(key, 0) + (value or 0)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def ingest_stream(
    spark: SparkSession, directory: str, target: str, checkpoint: str,
    max_files: int | None = None, pattern: str = "*.ipynb",
) -> StreamingQuery:
    """New notebook files -> cells, in folders by cell type (code and markdown only)."""
    cells = explode_cells(scan_notebooks(spark, directory, True, max_files, pattern))
    kept = cells.where(F.col("cell_type").isin("code", "markdown")).observe("ingested", *[
        F.count_if(F.col("cell_type") == kind).alias(kind) for kind in ("code", "markdown")])
    return _write(kept, target, checkpoint, "cell_type")


def metrics_stream(
    cells: DataFrame, vocab: Vocabulary, target: str, checkpoint: str, facts: str | None = None
) -> StreamingQuery:
    """Stream of code cells -> appended metric rows; no state.

    With the path of a facts table codes are parsed only if it lacks them (see ``factstore``); each
    batch then has a folder of its own, which a replay overwrites.
    """
    if facts is None:
        measured = metrics_of(cell_facts(cells, vocab)).observe(
            "measured", F.count(F.lit(1)).alias("total_rows"),
            F.count_if(F.col("parse_error").isNotNull()).alias("parse_errors"))
        return _write(measured, target, checkpoint)

    def measure(batch: DataFrame, number: int) -> None:
        found, _ = cell_metrics_once(batch, vocab, facts)
        found.write.mode("overwrite").parquet(f"{target}/batch={number}")

    return (cells.writeStream.option("checkpointLocation", checkpoint).foreachBatch(measure)
            .trigger(availableNow=True).start())


# Rows and bytes in which repeated links are thinned out together; a task holds so many at a time.
THINNED_ROWS, THINNED_BYTES = 200_000, 64 << 20


def _gathered(batches):
    """The rows of Arrow batches in fewer ones."""
    held, rows, size = [], 0, 0
    for batch in batches:
        held.append(batch)
        rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows >= THINNED_ROWS or size >= THINNED_BYTES:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, rows, size = [], 0, 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _first_of_each_hash(order: str | None):
    """Keep one row per hash of the rows gathered: the first, or the first by ``order``."""
    def run(batches):
        for batch in _gathered(batches):
            rows = np.arange(batch.num_rows)
            if order is not None:
                rows = pc.sort_indices(batch.column(order), null_placement="at_end").to_numpy()
            numbered = pa.table({"hash": batch.column("hash").take(pa.array(rows)),
                                 "at": np.arange(len(rows))})
            first = numbered.group_by("hash", use_threads=False).aggregate([("at", "min")])
            kept = rows[first.column("at_min").combine_chunks().to_numpy()]
            yield batch.take(pa.array(kept))
    return run


class _FirstSeen(StatefulProcessor):
    """State of a link hash: when to forget it (0: never). Known hashes come in as initial state."""

    def __init__(self, order: str | None, delay_ms: int | None):
        self.order, self.delay_ms = order, delay_ms

    def init(self, handle):
        self.handle, self.seen = handle, handle.getValueState("seen", "until long")

    def _remember(self, found_at) -> None:
        until = 0
        if self.delay_ms is not None and found_at is not None:
            until = int(found_at.timestamp() * 1000) + self.delay_ms
            self.handle.registerTimer(until)
        self.seen.update((until,))

    def handleInitialState(self, key, initialState, timerValues):
        self._remember(initialState["found_at"])

    def handleInputRows(self, key, rows, timerValues):
        if self.seen.exists():
            return
        first = None
        for row in rows:
            if first is None or (self.order is not None and row[self.order] is not None and (
                    first[self.order] is None or row[self.order] < first[self.order])):
                first = row
        self._remember(first["found_at"] if self.delay_ms is not None else None)
        yield first

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.seen.clear()
        return iter(())


def _milliseconds(delay: str) -> int:
    span = F.expr(f"unix_millis(timestamp_seconds(0) + interval {delay})")
    return SparkSession.active().range(1).select(span).first()[0]


def first_seen_stream(
    links: DataFrame, target: str, checkpoint: str, delay: str | None = None,
    known: DataFrame | None = None, order: str | None = None,
) -> StreamingQuery:
    """Stream of ``file_url`` rows -> the first row of each link hash.

    State keeps every hash, on disk (RocksDB) rather than in memory. With ``delay`` hashes are
    forgotten once ``found_at`` is that far behind; a link that comes back later is then a first
    one again. The hashes of ``known`` (a link map, read when the query first starts) count as seen,
    until ``delay`` after their ``found_at`` if the map has one. Of a link's rows in one batch the
    least by ``order`` is kept, or without it any.
    """
    hashed = links.withColumn("hash", link_key(F.col("file_url")))
    # A link that fills much of the input is thinned out before it meets the one task that keeps
    # its state.
    keyed = hashed.mapInArrow(_first_of_each_hash(order), hashed.schema)
    if delay is not None:
        keyed = keyed.withWatermark("found_at", delay)
    if known is None and order is None:
        first = (keyed.dropDuplicates(["hash"]) if delay is None
                 else keyed.dropDuplicatesWithinWatermark(["hash"]))
    else:
        last = F.max("found_at") if known is not None and "found_at" in known.columns else F.lit(None)
        seen = None if known is None else known.where("hash is not null").groupBy("hash").agg(
            last.cast("timestamp").alias("found_at")).groupBy("hash")
        milliseconds = None if delay is None else _milliseconds(delay)
        first = keyed.groupBy("hash").transformWithState(
            _FirstSeen(order, milliseconds), hashed.schema, "append",
            "none" if delay is None else "eventTime", seen)
    with _on_disk(links.sparkSession):
        return _write(first, target, checkpoint)


def op_count_stream(
    cells: DataFrame, vocab: Vocabulary, vocab_table: DataFrame, target: str, checkpoint: str
) -> StreamingQuery:
    """Stream of code cells -> the whole operation summary after each batch.

    Per-batch counts are added up by the streaming aggregation; its state is one row per function.
    Every batch writes a folder of its own, so that a complete summary is there at any time; read
    it with ``latest_summary``.
    """
    counts = op_counts(cell_facts(cells, vocab))
    listed = load_vocab(vocab_table, with_category=True)

    def write_summary(batch: DataFrame, number: int) -> None:
        op_summary(listed, batch).write.mode("overwrite").parquet(f"{target}/batch={number}")
        # The one before stays for readers that have just begun with it.
        store, folders = _summaries(batch.sparkSession, target)
        for old, path in folders.items():
            if old < number - 1:
                store.delete(path, True)

    return (
        counts.writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
        .foreachBatch(write_summary).trigger(availableNow=True).start()
    )


def _summaries(spark: SparkSession, target: str):
    """The file system, and the folders of summaries that are complete by their number."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    store = hadoop.Path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    found = [f.getPath() for f in store.listStatus(hadoop.Path(target))]
    return store, {int(p.getName().removeprefix("batch=")): p for p in found
                   if p.getName().startswith("batch=") and store.exists(hadoop.Path(p, "_SUCCESS"))}


def latest_summary(spark: SparkSession, target: str) -> DataFrame:
    """The summary of the last batch that was written in full."""
    _, folders = _summaries(spark, target)
    return spark.read.parquet(folders[max(folders)].toString())


class HitsTable:
    """The hits table at ``path``: a folder per batch, and per batch the Bloom filter of its link hashes.

    ``batch=<label>`` holds the rows, ``_filters/<label>`` the filter; the rows of a batch count once its
    filter is complete. ``_merging`` is the record of a merge under way. One query writes a table at a
    time; readers of ``path`` see the batches and nothing of the rest.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.hadoop = spark._jvm.org.apache.hadoop.fs
        self.store = self.hadoop.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.hadoop.Path(f"{self.path}/{name}")

    def _listed(self, folder: str) -> list[str]:
        if not self.store.exists(self._at(folder)):
            return []
        return sorted(f.getPath().getName() for f in self.store.listStatus(self._at(folder)))

    def _complete(self, folder: str) -> bool:
        return self.store.exists(self._at(f"{folder}/_SUCCESS"))

    def rows_folder(self, label: str) -> str:
        return f"{self.path}/batch={label}"

    def labels(self) -> list[str]:
        return sorted(n for n in self._listed("_filters") if self._complete(f"_filters/{n}"))

    def read(self, labels: list[str], columns: str) -> DataFrame:
        """The named columns of the rows of some batches; no other file is read."""
        if not labels:
            return self.spark.createDataFrame([], columns)
        return self.spark.read.schema(columns).parquet(*map(self.rows_folder, labels))

    def filters(self, labels: list[str]) -> DataFrame:
        return stored_filters(self.spark, {n: f"{self.path}/_filters/{n}" for n in labels})

    def put(self, rows: DataFrame, label: str) -> int:
        """Write a batch, rows first; their number is read from the footers of the files."""
        hashed = rows.withColumn("hash", link_key(F.col("file_url")))
        hashed.sortWithinPartitions("hash").write.mode("overwrite").parquet(self.rows_folder(label))
        keys = self.read([label], "hash string")
        write_filter(keys, "hash", f"{self.path}/_filters/{label}")
        return keys.count()

    def remove(self, label: str) -> None:
        for folder in (f"_filters/{label}", f"batch={label}"):
            self.store.delete(self._at(folder), True)

    def merge_small(self, most: int, kept: str) -> None:
        """With more than ``most`` batches put the smaller half of them (but ``kept``) into one.

        The new batch is written under a hidden name and recorded with what it replaces; from the record
        on a merge that was cut off is finished, before it is undone.
        """
        self.finish_merge()
        labels = self.labels()
        if len(labels) <= most:
            return
        size = {n: self.store.getContentSummary(self._at(f"batch={n}")).getLength() for n in labels}
        old = sorted((n for n in labels if n != kept), key=lambda n: (size[n], n))[:-(most // 2) or None]
        schema = self.spark.read.parquet(*map(self.rows_folder, old)).schema
        rows = self.spark.read.schema(schema).parquet(*map(self.rows_folder, old))
        new = f"merged-{uuid.uuid4().hex}"
        rows.sortWithinPartitions("hash").write.parquet(f"{self.path}/_merging/rows")
        write_filter(self.spark.read.parquet(f"{self.path}/_merging/rows"), "hash",
                     f"{self.path}/_merging/filter")
        self.spark.createDataFrame([(n, new) for n in old], "old string, new string").write.parquet(
            f"{self.path}/_merging/record")
        self.finish_merge()

    def repair(self) -> None:
        """Finish what a lost driver left: a merge on record, rows without their filter."""
        self.finish_merge()
        known = set(self.labels())
        for folder in self._listed("."):
            label = folder.removeprefix("batch=")
            if label != folder and label not in known and self._complete(folder):
                write_filter(self.read([label], "hash string"), "hash", f"{self.path}/_filters/{label}")

    def finish_merge(self) -> None:
        if self._complete("_merging/record"):
            record = self.spark.read.parquet(f"{self.path}/_merging/record").collect()
            new = record[0]["new"]
            for row in record:
                self.remove(row["old"])
            self.store.mkdirs(self._at("_filters"))
            for part, end in (("rows", f"batch={new}"), ("filter", f"_filters/{new}")):
                if self.store.exists(self._at(f"_merging/{part}")):
                    self.store.rename(self._at(f"_merging/{part}"), self._at(end))
        self.store.delete(self._at("_merging"), True)


# So many batches are kept side by side before the smaller ones are merged.
MOST_BATCHES = 32


def merge_batch(batch: DataFrame, target: str, label: str, most: int = MOST_BATCHES) -> dict[str, int]:
    """Add the unseen links of a batch to the hits table at ``target``; returns rows read and inserted.

    Every batch has a folder of its own, named by ``label``, which a repeated run overwrites;
    links stored by other batches are left out. A replay therefore changes nothing. Of the stored rows
    only batches are read whose Bloom filter a link of this batch passes, and only their hashes.
    """
    table = HitsTable(batch.sparkSession, target)
    table.repair()
    others = [n for n in table.labels() if n != label]
    rows = batch.withColumn("_hash", link_key(F.col("file_url")))
    keys = rows.select("_hash").where("_hash is not null").distinct()
    maybe = [r["batch"] for r in may_hold(keys, table.filters(others), "_hash").select(
        "batch").distinct().collect()] if others else []
    stored = table.read(sorted(maybe), "hash string").select(F.col("hash").alias("_hash"))
    fresh = rows.join(stored, "_hash", "left_anti").drop("_hash")
    _, inserted = insert_or_ignore(fresh.where("false"), fresh)
    count = table.put(inserted, label)
    table.merge_small(most, label)
    return {"rows": batch.count(), "inserted": count, "read_batches": len(maybe)}


def merge_stream(hits: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Stream of hits -> hits table without repeated links; safe to restart at any point.

    Folders are named by the id that the checkpoint stores: the same after a restart, another one
    for a fresh checkpoint at an old path.
    """
    def merge(batch: DataFrame, number: int) -> None:
        stored = batch.sparkSession.read.text(f"{checkpoint}/metadata").first()[0]
        merge_batch(batch, target, f"{json.loads(stored)['id']}-{number}")

    return (
        hits.writeStream.option("checkpointLocation", checkpoint).foreachBatch(merge)
        .trigger(availableNow=True).start()
    )
