"""What the physical plans must and must not contain."""

import pytest

from notelake.operators import aggregates, cells, curate, metrics, position
from notelake.plans import fixtures as fx
from notelake.plans.notebook_queries import case_vocabulary

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def vocab(spark):
    return case_vocabulary(spark)


def test_documents_are_parsed_once(spark):
    talks, parts = fx.conversation_notebooks(spark, SF), fx.part_notebooks(spark, SF)
    for df in (curate.qualify(parts).where("kept"),
               cells.explode_cells(talks).where("cell_type = 'code' and source like '%x%'"),
               cells.slim_or_raw(talks).where("fallback"),
               cells.code_text(talks).where("length(code_text) > 3")):
        # All but one see a document only if it has a source that no variant holds.
        text = plan(df)
        assert sum(n in text for n in ("_parsed", "_texts")) == 2
        assert text.count("from_json(") == 6


def test_cells_are_parsed_once(spark, vocab):
    facts = metrics.cell_facts(fx.part_cells(spark, SF), vocab)
    for df in (metrics.metrics_of(facts).where("PO > 0 and CO > 0"),
               aggregates.op_counts(facts), metrics.cell_fact_rows(facts).where("kind = 'op'"),
               aggregates.run_totals(metrics.metrics_of(facts)),
               aggregates.notebook_rollup(metrics.metrics_of(facts)).where("PO > 1")):
        assert plan(df).count("ArrowEvalPython") == 1


def test_metrics_need_no_shuffle_and_filters_on_keys_reach_the_scan(spark, vocab, tmp_path):
    spark.range(10).selectExpr(
        "cast(id as string) notebook_hash", "'0' cell_id", "'x' source", "1 other"
    ).write.parquet(str(tmp_path / "c"))
    stored = spark.read.parquet(str(tmp_path / "c"))
    text = plan(metrics.cell_metrics(stored, vocab).where("notebook_hash = '3' and S > 0"))
    assert "Exchange" not in text
    assert "EqualTo(notebook_hash,3)" in text
    assert "other" not in text


def test_no_window_over_whole_groups(spark):
    code = fx.order_cells(spark, SF).selectExpr("notebook_hash", "cell_pos", "1 as I")
    text = plan(position.position_curve(code, code.limit(0), "I"))
    ranked = next(line for line in text.splitlines() if "row_number()" in line)
    assert "_block" in ranked
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_rebuilt_texts_of_a_notebook_do_not_meet(spark):
    code, md = cells.split_cells(fx.conversation_cells(spark, SF))
    text = plan(cells.rebuild_notebooks(code, md))
    assert "collect_list" not in text
    ranked = next(line for line in text.splitlines() if "row_number()" in line)
    assert "_block" in ranked


def test_trees_are_filtered_before_the_shuffle(spark):
    text = plan(curate.choose_tree(fx.part_trees(spark, SF)))
    below = text[text.rindex("Exchange hashpartitioning(repo_name"):]
    assert "EndsWith" in below or "endswith" in below.lower()


def test_only_hashes_of_the_named_batches_are_read(spark, tmp_path):
    from notelake.streaming import streams

    hits = fx.event_hits(spark, SF)
    for n, part in enumerate(hits.randomSplit([0.5, 0.5], 1)):
        streams.merge_batch(part, str(tmp_path / "hits"), f"a-{n}")
    table = streams.HitsTable(spark, str(tmp_path / "hits"))
    stored = table.read(["a-1"], "hash string")
    assert "ReadSchema: struct<hash:string>" in plan(stored)
    assert stored.inputFiles() and all("batch=a-1/" in name for name in stored.inputFiles())
    assert spark.read.parquet(str(tmp_path / "hits")).groupBy("file_url").count().where(
        "count > 1").count() == 0


def test_no_cross_joins_in_any_query(spark):
    from notelake.plans.queries import QUERIES

    for name, query in QUERIES.items():
        if name.startswith("streamed"):
            continue
        text = plan(query(spark, SF))
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name
