"""Pages of a stored table: the rows of ``page``, from the files that hold them."""

import pytest
from pyspark.sql import functions as F

from notelake.plans.queries import QUERIES
from notelake.sources import paging, tables


def hits_of(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "id bigint").select(
        "id", F.when(F.col("id") % 5 > 0, F.concat(F.lit("r"), "id")).alias("repo_name"),
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("f"), "id")).alias("file_url"),
        F.lit("k").alias("keyword"), F.lit("not shown").alias("search_query"))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("paged") / "hits")
    ids = [3 * i for i in range(1000)]
    paging.write_paged(hits_of(spark, ids[400:0:-1] + ids[:1]).repartition(7), path, 64)
    paging.append_paged(hits_of(spark, ids[401:700]), path, 64)
    paging.append_paged(hits_of(spark, ids[700:]), path, 64)
    return hits_of(spark, ids), path


@pytest.mark.parametrize("limit, offset", [(10, 0), (64, 64), (100, 350), (0, 990), (None, 700),
                                           (5, 5000), (300, 399), (-1, 0)])
def test_same_rows_as_page(spark, stored, limit, offset):
    hits, path = stored
    found = paging.read_page(spark, path, limit, offset, 64).collect()
    assert found == tables.page(hits, limit, offset).collect()


def test_a_page_reads_the_files_that_hold_it(spark, stored):
    _, path = stored
    every = {r.file for r in spark.read.parquet(path).select(
        F.col("_metadata.file_path").alias("file")).distinct().collect()}
    for offset in (0, 512):
        page = paging.page_rows(spark, path, 10, offset, 64)
        plan = page._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(chunk" in plan and "GreaterThanOrEqual(position" in plan
        read = page.select(F.col("_metadata.file_path").alias("file")).distinct().count()
        assert page.count() == 10 and read <= 2 < len(every)
        assert "Sort" not in plan and "Exchange" not in plan


def test_positions_have_no_gaps_and_ids_have_to_follow(spark, stored, tmp_path):
    hits, path = stored
    rows = spark.read.parquet(path).orderBy("position").select("id", "position", "chunk").collect()
    assert [tuple(r) for r in rows] == [(3 * i, i, i // 64) for i in range(1000)]
    assert paging.stored_rows(spark, path) == (1000, 2997)
    with pytest.raises(ValueError):
        paging.append_paged(hits_of(spark, [2997]), path, 64)
    paging.append_paged(hits_of(spark, []).where("false"), path, 64)
    assert spark.read.parquet(path).count() == 1000
    empty = str(tmp_path / "empty")
    paging.write_paged(hits_of(spark, [1]).where("false"), empty)
    assert paging.read_page(spark, empty, 5).collect() == []
    paging.append_paged(hits_of(spark, [4, 2]), empty)
    assert [r.id for r in paging.read_page(spark, empty, 5).collect()] == [2, 4]


def test_folders_do_not_grow_with_the_table(spark, monkeypatch):
    paths, write = [], paging.write_paged
    monkeypatch.setattr(paging, "MOST_CHUNKS", 5, raising=False)
    monkeypatch.setattr(paging, "write_paged",
                        lambda hits, path, *rest: (paths.append(path), write(hits, path, *rest)))
    events = "/root/testdata/sf0.01"
    total = spark.read.parquet(f"{events}/events.parquet").count()
    found = QUERIES["pages_of_stored_hits"](spark, events)
    assert found.where("page = 3").count() == total - 900
    assert spark.read.parquet(*paths).select("chunk").distinct().count() <= 5
    assert paging.rows_per_folder(100, 256) == 256
