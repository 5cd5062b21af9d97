import pytest
from pyspark.errors import AnalysisException

from notelake.sources import tables

TEXTS = ["  x = 1\n", "\n\nimport a\r\nb ", "", 'a,"b"\n\\', "NA", None, "# c", "\tpad\t", '"q"',
         "a\rb", "\\N x", "\\N", "\\\\N"]


def test_csv_returns_every_text(spark, tmp_path):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, source string")
    path = str(tmp_path / "t.csv")
    tables.write_csv(df, path)
    back = tables.read_csv_table(spark, path, "i int, source string")
    assert [r.source for r in back.orderBy("i").collect()] == TEXTS
    with pytest.raises(AnalysisException):
        tables.write_csv(df, path)


def test_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text('b,extra,a\n"x\ny",1,2\n')
    path = str(tmp_path / "a.csv")
    assert tuple(tables.read_csv_table(spark, path, "a int, b string").first()) == (2, "x\ny")
    assert tuple(tables.read_csv_table(spark, path, "a int, z string", ["a"]).first()) == (2, None)
    with pytest.raises(ValueError, match="z"):
        tables.read_csv_table(spark, path, "a int, z string")


def test_convert_names_and_contents(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    tables.write_csv(spark.createDataFrame([("a ", 1)], "s string, n int"), path)
    packed = tables.convert(spark, path, schema="s string, n int")
    assert packed == str(tmp_path / "t.parquet.gzip")
    assert tables.convert(spark, packed, str(tmp_path / "u")) == str(tmp_path / "u.csv")
    assert tuple(tables.read_table(spark, str(tmp_path / "u.csv")).first()) == ("a ", "1")
    with pytest.raises(AnalysisException):
        tables.read_table(spark, str(tmp_path / "missing.parquet"))


def test_vocabulary_keeps_last_category(spark):
    lines = spark.createDataFrame(
        [(" a ", "x", 0), ("b", None, 1), ("a", "y", 2), ("  ", "z", 3), (None, "z", 4)],
        "function string, category string, line int").coalesce(1)
    for order in ("line", None):
        vocab = tables.load_vocab(lines, True, order)
        assert sorted(map(tuple, vocab.collect())) == [("a", "y"), ("b", "")]
    assert sorted(r[0] for r in tables.load_vocab(lines).collect()) == ["a", "b"]


def test_table_names():
    assert tables.table_names(None) is None
    assert tables.table_names(["b, a", "", "a,b ,c"]) == ["b", "a", "c"]


def test_export_reports_each_table(spark, tmp_path):
    spark.range(3).createOrReplaceTempView("three")
    spark.range(3).selectExpr("raise_error('no') x").createOrReplaceTempView("failing")
    out = str(tmp_path / "out")
    run = lambda **kw: {r.name: (r.status, r.rows) for r in tables.export_tables(
        spark, ["three,failing", "absent"], out, **kw).collect()}
    wanted = {"three": ("exported", 3), "failing": ("failed", None), "absent": ("missing", None)}
    assert run() == wanted
    assert run()["three"] == ("failed", None)
    assert run(overwrite=True) == wanted
    assert tables.export_tables(spark, None, out).count() == 0  # views only on request
    views = tables.export_tables(spark, None, out, overwrite=True, include_views=True)
    assert {"three", "failing"} <= {r.name for r in views.collect()}


def test_pages(spark):
    hits = spark.createDataFrame(
        [(i, None if i == 3 else f"r{i}", None if i % 4 == 0 else f"u{i}", "k")
         for i in range(30, 0, -1)], "id long, repo_name string, file_url string, keyword string")
    ids = lambda *a: [r.id for r in tables.page(hits, *a).collect()]
    assert ids(5, 2) == [3, 5, 6, 7]
    assert ids(None, 0) == ids(0, 0) == ids(-1, 0) == [i for i in range(1, 31) if i % 4]
    assert ids(0, 26) == [27, 29, 30]
    assert ids(10_000, 27) == [29, 30]
    assert {r.repo_name for r in tables.page(hits, 1, 2).collect()} == {""}


def test_skip_existing(spark):
    new = spark.createDataFrame([("a",), ("b",)], "hash string")
    old = spark.createDataFrame([("a",), ("a",)], "hash string")
    names = lambda df: sorted(r.hash for r in df.collect())
    assert names(tables.skip_existing(new, old)) == ["b"]
    assert names(tables.skip_existing(new, old, overwrite=True)) == ["a", "b"]
    assert names(tables.skip_existing(new, None)) == ["a", "b"]
    assert tuple(tables.skipped_count(new, old).first()) == (1, 1)
