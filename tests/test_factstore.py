"""Facts stored by content: same metrics, and no parser for codes that are known."""

import pytest

from notelake.operators import factstore, metrics
from notelake.plans.fixtures import pandas_vocab
from notelake.streaming import streams

CELLS = "notebook_hash string, cell_id string, source string"


@pytest.fixture(scope="module")
def vocab(spark):
    return metrics.vocabulary(pandas_vocab(spark))


def cells_of(spark, start, stop):
    texts = ["df.head()", "%magic\ndf.head()", "df.groupby('a').sum()", "def f(:", None, "", "x = [1, 2]"]
    rows = [("n", str(i), texts[i % 7] if i % 2 else f"df.head({i % 40}).sum()") for i in range(start, stop)]
    return spark.createDataFrame(rows, CELLS)


def rows(frame):
    return sorted(map(str, frame.collect()))


def test_same_metrics_and_each_code_once(spark, tmp_path, vocab):
    path = str(tmp_path / "facts")
    first, second = cells_of(spark, 0, 200), cells_of(spark, 100, 400)
    found, parsed = factstore.cell_metrics_once(first, vocab, path)
    codes = {r.code for r in metrics.line_metrics(first).select("code").collect()}
    assert parsed == len(codes) and rows(found) == rows(metrics.cell_metrics(first, vocab))
    found, parsed = factstore.cell_metrics_once(second, vocab, path)
    assert parsed == 0 and rows(found) == rows(metrics.cell_metrics(second, vocab))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "InArrow" not in plan
    table = factstore.FactsTable(spark, path, vocab)
    assert table.read().count() == table.read().select("key").distinct().count() == len(codes)


def test_a_second_run_starts_no_parser(spark, tmp_path, vocab, monkeypatch):
    path, cells = str(tmp_path / "facts"), cells_of(spark, 0, 50)
    factstore.cell_metrics_once(cells, vocab, path)
    monkeypatch.setattr(factstore, "facts_udf", None)
    found, parsed = factstore.cell_metrics_once(cells, vocab, path)
    assert parsed == 0 and found.count() == 50
    with pytest.raises(TypeError):
        factstore.cell_metrics_once(spark.createDataFrame([("n", "0", "new()")], CELLS), vocab, path)


def test_another_vocabulary_has_facts_of_its_own(spark, tmp_path, vocab):
    path, cells = str(tmp_path / "facts"), cells_of(spark, 0, 20)
    other = metrics.vocabulary(spark.createDataFrame([("nothing",)], "function string"))
    assert factstore.fingerprint(vocab) != factstore.fingerprint(other)
    for v in (vocab, other):
        found, parsed = factstore.cell_metrics_once(cells, v, path)
        assert parsed > 0 and rows(found) == rows(metrics.cell_metrics(cells, v))


def test_streams_share_the_table(spark, tmp_path, vocab):
    cells = cells_of(spark, 0, 60)
    cells.repartition(3).write.parquet(str(tmp_path / "cells"))
    path = str(tmp_path / "facts")
    factstore.cell_metrics_once(cells, vocab, path)
    stream = spark.readStream.schema(CELLS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "cells"))
    query = streams.metrics_stream(stream, vocab, str(tmp_path / "out"), str(tmp_path / "p"), path)
    query.awaitTermination()
    assert query.exception() is None
    wanted = metrics.cell_metrics(cells, vocab)
    found = spark.read.parquet(str(tmp_path / "out"))
    assert found.select("batch").distinct().count() == 3
    assert rows(found.select(wanted.columns)) == rows(wanted)
