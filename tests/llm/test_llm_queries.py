"""The registered queries and the pipeline, over whole tables of the smallest scale."""

import pytest

import corpus_pipeline
from compare import differences, duck
from notelake.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    found = QUERIES[name](spark, SF)
    if name in ORACLES:
        assert differences(found, duck(SF), ORACLES[name]) == ""
    else:
        assert found.count() > 0


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, SF).checkpoint()
        assert docs.dtypes == before.dtypes, name
        assert docs.subtract(before).count() == 0, name
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0.5 * sizes[0]
    ids = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in ids.select("doc_id").collect()} == {
        r.doc_id for r in docs.select("doc_id").collect()}


def test_pipeline_of_odd_tables(spark, tmp_path):
    """Nulls, empty and repeated texts, columns with names of the stages; empty tables beside them."""
    good = " ".join(f"{a}{b}" for a in ("some", "plain", "common", "words") for b in ("", "s", "ed", "ing"))
    rows = [(1, f"the first text has {good}", "en"), (1, f"the first text has {good}", "en"),
            (2, None, None), (3, "", "en"), (None, f"a text without an id but with {good}", None),
            (4, f"another of the texts that hold {good} and end so", "xx")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").selectExpr(
        "*", "'web' as source", "7L as n_chars", "1 as kept", "2 as digest", "3 as row", "4 as group")
    labels = spark.createDataFrame([(1, 0, 1), (None, 1, None)], "doc_id bigint, toxic int, quality int")
    items = spark.createDataFrame([(1, None), (2, "")], "item_id bigint, text string")
    for name, some in (("odd", 100), ("none", 0)):
        for table, frame in (("documents", docs), ("labels", labels), ("benchmark", items)):
            frame.limit(some).write.parquet(str(tmp_path / name / f"{table}.parquet"))
        found = corpus_pipeline.run(spark, str(tmp_path / name)).collect()
        ids = [r.doc_id for r in found]
        assert len(ids) == len(set(ids)) and set(ids) <= ({1, 4, None} if some else set())
        assert all(r.n_tokens > 0 for r in found)
