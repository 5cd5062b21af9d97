"""One file per notebook: read back by the library's own scan, nothing left of failed jobs."""

import json
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from notelake.operators import cells as cellops
from notelake.plans.fixtures import conversation_cells
from notelake.plans import notebook_queries
from notelake.plans.queries import QUERIES
from notelake.sources.notebook_files import scan_packed, write_notebook_files
from notelake.sources.notebooks import scan_notebooks

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rebuilt(spark):
    code, md = cellops.split_cells(conversation_cells(spark, SF))
    named = lambda df: df.withColumn("notebook_hash", F.concat(
        F.when(F.col("notebook_hash").cast("int") % 2 == 0, "even/é ").otherwise("odd/"), "notebook_hash"))
    return cellops.rebuild_notebooks(named(code), named(md)).checkpoint()


def documents(rebuilt):
    lines = {}
    for r in rebuilt.collect():
        lines.setdefault(r.notebook_hash, []).append((r.line, r.json))
    return {f"{name}.ipynb": "".join(text for _, text in sorted(rows)) for name, rows in lines.items()}


def texts(frame):
    return {r.notebook_hash: bytes(r.content).decode() for r in frame.select(
        "notebook_hash", F.col("content").cast("binary").alias("content")).collect()}


@pytest.mark.parametrize("buckets", [None, 3])
def test_read_back_under_the_same_names(spark, tmp_path, rebuilt, buckets):
    target = str(tmp_path / "out" / "notebooks")
    wanted = documents(rebuilt)
    assert len(wanted) > 10
    for name, attempt in ((target, {}), (f"file://{target}", {"overwrite": True})):
        write_notebook_files(rebuilt, name, buckets, **attempt)
        scan = scan_notebooks if buckets is None else scan_packed
        assert texts(scan(spark, target)) == wanted
        assert os.listdir(tmp_path / "out") == ["notebooks"]
    files = [f for _, _, names in os.walk(target) for f in names]
    assert len(files) == (buckets or len(wanted))
    with pytest.raises(FileExistsError):
        write_notebook_files(rebuilt, target, buckets)
    cells = cellops.explode_cells(scan(spark, target))
    assert cells.count() == sum(len(json.loads(text)["cells"]) for text in wanted.values())


@pytest.mark.parametrize("buckets", [None, 2])
def test_a_failed_task_leaves_nothing(spark, tmp_path, rebuilt, buckets):
    target = tmp_path / "notebooks"
    write_notebook_files(rebuilt, str(target), buckets)
    before = {f: os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(target) for f in names}
    broken = rebuilt.withColumn("json", F.when(
        (F.col("line") == 2) & F.col("notebook_hash").startswith("odd"),
        F.raise_error(F.lit("lost"))).otherwise(F.col("json")))
    for bad in (broken, rebuilt.withColumn("notebook_hash", F.concat(F.lit("../"), "notebook_hash"))):
        with pytest.raises(Exception):
            write_notebook_files(bad, str(target), buckets, overwrite=True)
        assert os.listdir(tmp_path) == ["notebooks"]
        assert {f: os.path.getmtime(os.path.join(d, f))
                for d, _, names in os.walk(target) for f in names} == before


def test_no_notebooks(spark, tmp_path, rebuilt):
    write_notebook_files(rebuilt.where("false"), str(tmp_path / "none"))
    assert os.listdir(tmp_path) == ["none"] and scan_notebooks(spark, str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("name", ["scanned_notebook_files", "streamed_notebook_files"])
def test_folders_do_not_grow_with_the_notebooks(spark, monkeypatch, name):
    monkeypatch.setattr(notebook_queries, "FOLDERS", 3, raising=False)
    roots, made = [], notebook_queries._notebook_files
    monkeypatch.setattr(notebook_queries, "_notebook_files",
                        lambda *args: roots.append(made(*args)) or roots[-1])
    found = QUERIES[name](spark, "/root/testdata/sf0.01")
    files = [f for f in Path(roots[0]).rglob("*") if f.is_file() and not f.name.startswith((".", "_"))]
    notebooks = found.select("notebook_hash").distinct().count()
    assert len(files) >= notebooks > 3
    assert len({f.parent for f in files}) == 3
