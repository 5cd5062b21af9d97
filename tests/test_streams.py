"""Streams give what the batch operators give, also when continued and replayed."""

import json
import time

import pyarrow as pa
from pyspark.sql import functions as F

from notelake.operators import metrics
from notelake.operators.aggregates import op_counts, op_summary
from notelake.plans.fixtures import pandas_vocab
from notelake.sources import keyindex
from notelake.sources.keyindex import build_filter
from notelake.streaming import streams

CELLS = "notebook_hash string, cell_id string, source string"


def run(query):
    query.awaitTermination()
    assert query.exception() is None


def test_ingest_continues_where_it_stopped(spark, tmp_path):
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    (tmp_path / "in").mkdir()

    def add(name):
        nb = {"cells": [{"cell_type": t, "source": name} for t in ("code", "markdown", "raw")]}
        (tmp_path / "in" / name).write_text(json.dumps(nb))

    seen = []
    for name in ("a.ipynb", "b.ipynb"):
        add(name)
        seen += [(name, "0", "code"), (name, "1", "markdown")]
        for _ in range(2):
            run(streams.ingest_stream(spark, source, target, progress, max_files=1))
        rows = spark.read.parquet(target).select("notebook_hash", "cell_id", "cell_type").collect()
        assert sorted(map(tuple, rows)) == sorted(seen)


def test_totals_come_from_the_running_batches(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for n in range(3):
        cells = [{"cell_type": t, "source": "x"} for t in ["code"] * n + ["markdown", "raw"]]
        (tmp_path / "in" / f"{n}.ipynb").write_text(json.dumps({"cells": cells}))
    totals = streams.RunTotals()
    spark.streams.addListener(totals)
    try:
        run(streams.ingest_stream(
            spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "p"), max_files=1))
        _, stream = cells_in_files(spark, str(tmp_path / "cells"))
        vocab = metrics.vocabulary(pandas_vocab(spark))
        run(streams.metrics_stream(stream(), vocab, str(tmp_path / "m"), str(tmp_path / "mp")))
        wanted = {"ingested": {"code": 3, "markdown": 3},
                  "measured": {"total_rows": 30, "parse_errors": 0}}
        for _ in range(100):  # progress is reported a moment after a batch
            if totals.totals == wanted:
                break
            time.sleep(0.1)
        assert totals.totals == wanted
    finally:
        spark.streams.removeListener(totals)


def cells_in_files(spark, path):
    rows = [("n", str(i), "df.head()" + ".sum()" * (i % 3)) for i in range(30)]
    cells = spark.createDataFrame(rows, CELLS)
    cells.repartition(5).write.parquet(path)
    reader = spark.readStream.schema(CELLS).option("maxFilesPerTrigger", 2)
    return cells, lambda: reader.parquet(path)


def test_metrics_and_counts(spark, tmp_path):
    batch, stream = cells_in_files(spark, str(tmp_path / "cells"))
    vocab_table = pandas_vocab(spark)
    vocab = metrics.vocabulary(vocab_table)
    paths = [str(tmp_path / n) for n in ("m", "mp", "s", "sp")]
    run(streams.metrics_stream(stream(), vocab, paths[0], paths[1]))
    wanted = metrics.cell_metrics(batch, vocab)
    found = spark.read.parquet(paths[0]).select(wanted.columns)
    assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))
    for _ in range(2):
        run(streams.op_count_stream(stream(), vocab, vocab_table, paths[2], paths[3]))
    summary = op_summary(vocab_table, op_counts(metrics.cell_facts(batch, vocab)))
    assert sorted(map(tuple, streams.latest_summary(spark, paths[2]).collect())) == sorted(
        map(tuple, summary.collect()))


def hits_in_files(spark, path, start, stop):
    hits = spark.range(start, stop).select(
        F.col("id").alias("seq"), F.lit("o/r").alias("repo_name"), F.lit("u").alias("repo_url"),
        F.concat(F.lit("f"), F.col("id") % 7).alias("file_url"), F.lit("k").alias("keyword"),
        F.timestamp_seconds("id").alias("found_at"))
    hits.repartition(3).write.mode("append").parquet(path)
    return lambda: spark.readStream.schema(hits.schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_first_seen_links(spark, tmp_path):
    path = str(tmp_path / "hits")
    stream = hits_in_files(spark, path, 0, 20)
    for delay in (None, "1 hour"):
        out, progress = str(tmp_path / f"o{delay}"), str(tmp_path / f"p{delay}")
        run(streams.first_seen_stream(stream(), out, progress, delay))
        assert sorted(r.file_url for r in spark.read.parquet(out).collect()) == [
            f"f{i}" for i in range(7)]
    hits_in_files(spark, path, 20, 40)
    out, progress = str(tmp_path / "oNone"), str(tmp_path / "pNone")
    run(streams.first_seen_stream(stream(), out, progress))
    assert spark.read.parquet(out).count() == 7


def test_links_are_thinned_across_arrow_batches(monkeypatch):
    rows = [(f"h{n % 7}", -n) for n in range(1000)]
    batch = pa.RecordBatch.from_pylist([{"hash": h, "seq": n} for h, n in rows])
    small = [batch.slice(at, 10) for at in range(0, 1000, 10)]
    for order, wanted in ((None, rows[:7]), ("seq", rows[-7:])):
        out = [(r["hash"], r["seq"]) for b in streams._first_of_each_hash(order)(iter(small))
               for r in b.to_pylist()]
        assert sorted(out) == sorted(wanted)
        assert list(streams._first_of_each_hash(order)(iter([batch.slice(0, 0)]))) == []
    monkeypatch.setattr(streams, "THINNED_ROWS", 500)
    held = [b.num_rows for b in streams._gathered(iter(small))]
    assert held == [500, 500]


def test_first_seen_links_with_a_known_map(spark, tmp_path):
    """Links mapped by an earlier run are not first again, nor after a restart."""
    path, out, progress = (str(tmp_path / n) for n in ("hits", "out", "progress"))
    stream = hits_in_files(spark, path, 0, 20)
    known = spark.createDataFrame([("f1",), ("f5",), ("f1",), ("f99",), (None,)], "url string").select(
        F.sha1("url").alias("hash"))
    for stop in (20, 40):
        run(streams.first_seen_stream(stream(), out, progress, known=known, order="seq"))
        found = spark.read.parquet(out).collect()
        # One file is one batch here, so which row comes first depends on the files.
        assert sorted(r.file_url for r in found) == ["f0", "f2", "f3", "f4", "f6"]
        assert all(r.seq < 20 and r.file_url == f"f{r.seq % 7}" for r in found)
        hits_in_files(spark, path, stop, stop + 20)


def test_known_links_are_forgotten_after_the_delay(spark, tmp_path):
    path, out, progress = (str(tmp_path / n) for n in ("hits", "out", "progress"))
    known = spark.createDataFrame([("f0", 0), ("f3", 9_000)], "url string, at long").select(
        F.sha1("url").alias("hash"), F.timestamp_seconds("at").alias("found_at"))
    stream = hits_in_files(spark, path, 0, 7)
    seen = []
    for start in (0, 5_000, 20_000, 30_000):
        if start:
            hits_in_files(spark, path, start, start + 7)
        run(streams.first_seen_stream(stream(), out, progress, "1 hour", known, "seq"))
        seen.append(sorted(r.file_url for r in spark.read.parquet(out).collect()))
    assert seen[0] == ["f1", "f2", "f4", "f5", "f6"]
    # Files of one run may come in any order; a run starts with the watermark of the run before.
    assert not {"f0", "f3"} & set(seen[1])
    assert seen[3].count("f0") >= 1 and seen[3].count("f3") >= 1


def test_replayed_batches_change_nothing(spark, tmp_path):
    path, out = str(tmp_path / "hits"), str(tmp_path / "table")
    stream = hits_in_files(spark, path, 0, 30)
    run(streams.merge_stream(stream(), out, str(tmp_path / "p")))
    rows = lambda: sorted(map(str, spark.read.parquet(out).drop("batch", "hash").collect()))
    before = rows()
    assert len(before) == 7
    run(streams.merge_stream(stream(), out, str(tmp_path / "p")))
    run(streams.merge_stream(stream(), out, str(tmp_path / "fresh")))
    label = next(r.batch for r in spark.read.parquet(out).collect())
    streams.merge_batch(
        spark.read.parquet(out).where(F.col("batch") == label).drop("batch", "hash").checkpoint(),
        out, label)
    assert rows() == before


def test_a_fresh_checkpoint_at_an_old_path_loses_nothing(spark, tmp_path):
    out, progress = str(tmp_path / "table"), tmp_path / "p"
    run(streams.merge_stream(hits_in_files(spark, str(tmp_path / "a"), 0, 5)(), out, str(progress)))
    progress.rename(tmp_path / "gone")
    run(streams.merge_stream(hits_in_files(spark, str(tmp_path / "b"), 5, 7)(), out, str(progress)))
    found = spark.read.parquet(out)
    assert sorted(r.file_url for r in found.collect()) == [f"f{i}" for i in range(7)]


def links(spark, start, stop):
    return spark.range(start, stop).select(
        F.col("id").alias("seq"), F.lit("o/r").alias("repo_name"), F.lit("u").alias("repo_url"),
        F.concat(F.lit("f"), "id").alias("file_url"), F.lit("k").alias("keyword"),
        F.timestamp_seconds("id").alias("found_at"))


def test_new_links_read_no_stored_rows(spark, tmp_path):
    """Twenty batches of new links: none reads a stored batch, however many there are."""
    target = str(tmp_path / "hits")
    for n in range(20):
        found = streams.merge_batch(links(spark, 500 * n, 500 * n + 500), target, f"b-{n}", most=6)
        assert found == {"rows": 500, "inserted": 500, "read_batches": 0}, n
        assert len(streams.HitsTable(spark, target).labels()) <= 6
    # Links of one earlier batch are looked up in the batches that may hold them, and in no other.
    label = spark.read.parquet(target).where("file_url = 'f9700'").first()["batch"]
    found = streams.merge_batch(links(spark, 9700, 9710), target, "again", most=6)
    assert (found["rows"], found["inserted"], found["read_batches"]) == (10, 0, 1), label
    rows = spark.read.parquet(target)
    assert rows.count() == rows.select("file_url").distinct().count() == 10_000


def test_filters_pass_every_key_and_few_others(spark):
    keys = links(spark, 0, 3000).select(F.sha1("file_url").alias("hash"))
    filters = build_filter(keys, "hash").withColumn("batch", F.lit("a"))
    assert filters.count() == 3 and keyindex.may_hold(keys, filters, "hash").count() == 3000
    others = links(spark, 3000, 53_000).select(F.sha1("file_url").alias("hash"))
    assert keyindex.may_hold(others, filters, "hash").count() <= 3
    nothing = build_filter(keys.where("false"), "hash")
    assert nothing.count() == 0
    assert keyindex.may_hold(keys, nothing.withColumn("batch", F.lit("b")), "hash").count() == 0


def test_a_merge_that_was_cut_off_is_finished_or_undone(spark, tmp_path):
    target = str(tmp_path / "hits")
    for n in range(4):
        streams.merge_batch(links(spark, 10 * n, 10 * n + 10), target, f"b-{n}")
    table = streams.HitsTable(spark, target)
    state = lambda: sorted(r.seq for r in spark.read.parquet(target).collect())
    # Before the record: nothing has happened.
    table.read(["b-0"], "hash string").write.parquet(f"{target}/_merging/rows")
    table.repair()
    assert state() == list(range(40)) and len(table.labels()) == 4
    # After the record: the driver is lost between removing the old rows and naming the new ones.
    finish, table.finish_merge = table.finish_merge, lambda: None
    table.merge_small(1, "b-3")
    table.remove("b-1")
    table.finish_merge = finish
    (tmp_path / "hits" / "_filters" / "b-3" / "_SUCCESS").unlink()
    table.repair()
    assert state() == list(range(40)) and len(table.labels()) == 2 and "b-3" in table.labels()
    assert not (tmp_path / "hits" / "_merging").exists()
    assert streams.merge_batch(links(spark, 0, 45), target, "b-4")["inserted"] == 5
