import json
import os

from pyspark.sql import functions as F

from notelake.operators import cells as cellops, curate
from notelake.sources.notebooks import scan_notebooks
from notelake.sources.tables import write_notebooks

SOURCES = {
    "listed": {"cells": [{"cell_type": "code", "id": "x1", "outputs": [{"a": float("nan")}],
                          "source": ["import pandas as pd\n", "pd.read_csv('x')"]}]},
    "quoted": {"cells": [{"cell_type": "markdown", "source": '["a"]'}]},
    "raw": {"cells": [{"cell_type": "raw", "source": "r"}]},
    "odd": {"cells": [{"cell_type": "code", "id": "", "source": None},
                      {"cell_type": "code", "id": "", "source": 5}, {"cell_type": "code"},
                      {"cell_type": "code", "source": True}]},
    "none": {}, "null": {"cells": None},
}
TEXTS = {name: json.dumps(nb) for name, nb in SOURCES.items()} | {
    "broken": '{"cells": [{"cell_type": "code"}', "empty": "", "list": "[1,2]",
    "trailing": '{"cells": [{"cell_type": "code", "source": "a"}]} x',
    "object behind": '{"cells": [{"cell_type": "code", "source": "a"}]} {}',
    "brace behind": '{"cells": [{"cell_type": "code", "source": "a"}]} junk}',
    "one more": '{"cells": [{"cell_type": "code", "source": "a"}]}, {}',
    "bom": '\ufeff{"cells": [{"cell_type": "code", "source": "a"}]}',
    "single": "{'cells': [{'cell_type': 'code', 'source': 'a'}]}",
}


def frame(spark, texts):
    return spark.createDataFrame(list(texts.items()), "notebook_hash string, content string")


def test_flatten(spark):
    cells = cellops.explode_cells(frame(spark, TEXTS))
    code, md = cellops.split_cells(cells)
    rows = sorted(map(tuple, code.collect()))
    assert rows == [
        ("listed", "x1", 0, "import pandas as pd\npd.read_csv('x')"),
        ("odd", "0", 0, ""), ("odd", "1", 1, "5"), ("odd", "2", 2, ""), ("odd", "3", 3, "True")]
    assert list(map(tuple, md.collect())) == [("quoted", "0", 0, '["a"]')]


def test_long_sources_and_outputs_are_kept(spark):
    big = "x" * 25_000_000
    nb = {"cells": [{"cell_type": "code", "source": big, "outputs": [big]}]}
    row = cellops.explode_cells(frame(spark, {"n": json.dumps(nb)})).select(
        F.length("source").alias("n")).first()
    assert row.n == len(big)


def test_numbers_print_as_in_python(spark):
    values = [5, 5.0, 0.1, 1e20, -2.5e-7, True, None]
    nb = {"cells": [{"cell_type": "code", "source": v} for v in values]}
    cells = cellops.explode_cells(frame(spark, {"n": json.dumps(nb)})).orderBy("cell_pos")
    assert [r.source for r in cells.collect()] == [
        "" if v is None else str(v) for v in json.loads(json.dumps(values))]


def test_members_beyond_the_size_of_a_variant(spark, tmp_path):
    """Documents are built by Spark: a source, or metadata, of 135 MiB beside an ordinary cell."""
    size = 135 << 20
    big = F.repeat(F.lit("x"), (F.col("id") + size).cast("int"))
    start = '{"cells":[{"cell_type":"code","source":["a","b"]},{"cell_type":"code","source":"'
    text = F.concat(F.lit(start), big, F.lit('"},{"cell_type":"markdown"}]}'))
    nb = spark.range(1).select(F.lit("n").alias("notebook_hash"), text.alias("content"))
    cells = cellops.explode_cells(nb).select("cell_pos", F.length("source").alias("n"))
    assert [tuple(r) for r in cells.orderBy("cell_pos").collect()] == [(0, 2), (1, size), (2, 0)]
    meta = F.concat(
        F.lit('{"metadata":{"widgets":"'), big,
        F.lit('","kernelspec":{"name":"p"}},"cells":[{"cell_type":"code","source":["a"]}]}'))
    nb = spark.range(1).select(F.lit("n").alias("notebook_hash"), meta.alias("content"))
    slim = json.loads(cellops.slim_notebooks(nb).select("slim").first()[0])
    assert slim["metadata"] == {"kernelspec": {"name": "p"}}
    assert slim["cells"] == [{"cell_type": "code", "source": ["a"], "metadata": {}, "outputs": []}]


def test_padded_documents_are_read_alike(spark):
    """The size of a document changes nothing: same cells, code text and slim form."""
    values = [5, 5.0, True, None, {"a": 1}, "5", '["a"]', ["a", "b"], 1e20, "x=1"]
    nb = {"cells": [{"cell_type": "code", "source": v} for v in values]}
    padding = "y" * 17_000_000
    texts = {"small": json.dumps(nb), "large": json.dumps(nb | {"padding": padding})}
    df = frame(spark, texts).checkpoint()
    for form, columns in ((cellops.explode_cells, ["cell_pos", "cell_type", "source"]),
                          (cellops.code_text, ["code_text"]), (cellops.slim_notebooks, ["slim"])):
        rows = {}
        for r in form(df).select("notebook_hash", F.struct(columns).alias("row")).collect():
            rows.setdefault(r.notebook_hash, []).append(str(r.row))
        assert sorted(rows["small"]) == sorted(rows["large"]), form
    assert {r.code_text for r in cellops.code_text(df).select("code_text").collect()} == {
        '5\n["a"]\nab\nx=1'}


def test_sources_beyond_the_size_of_a_variant_keep_their_form(spark):
    """A list, a text and an object of 135 MiB each, beside cells whose form has to stay."""
    big = F.repeat(F.lit("x"), (F.col("id") + (135 << 20)).cast("int"))
    cell = '{"cell_type":"code","source":%s}'
    small = F.lit(",".join(cell % v for v in ("5", "true", '"NaN"', '["a"]')))
    for opening, closing, form, size in (('["', '","b"]', "list", 1), ('"[', '"', "text", 1),
                                         ('{"a":"', '"}', "other", 8)):
        text = F.concat(
            F.lit('{"cells":['), small, F.lit(',{"cell_type":"code","source":' + opening), big,
            F.lit(closing + "}]}"))
        nb = spark.range(1).select(F.lit("n").alias("notebook_hash"), text.alias("content"))
        doc = cellops.parse_notebooks(nb).select(F.posexplode("doc.cells").alias("i", "c")).select(
            "i", "c.form", F.length(cellops.source_text(F.col("c"))).alias("n"))
        assert [tuple(r) for r in doc.orderBy("i").collect()] == [
            (0, "other", 1), (1, "other", 4), (2, "text", 3), (3, "list", 1),
            (4, form, (135 << 20) + size)]
    broken = nb.withColumn("content", F.concat("content", F.lit("]")))
    assert cellops.parse_notebooks(broken).where("doc is not null").count() == 0


def test_names_are_relative_to_the_resolved_root(spark, tmp_path):
    for folder in ("nbs/a", "nbs/b", "nbs/nbs/a"):
        os.makedirs(tmp_path / folder)
        (tmp_path / folder / "same.ipynb").write_text(TEXTS["quoted"])
    wanted = {"a/same.ipynb", "b/same.ipynb", "nbs/a/same.ipynb"}
    root = str(tmp_path)
    for start in (f"{root}/nbs", f"{root}/./nbs/", f"{root}/nbs/../nbs", f"{root}/nbs/*",
                  f"file://{root}/nbs"):
        found = scan_notebooks(spark, start)
        assert {r.notebook_hash for r in found.collect()} == wanted, start


def test_scan_finds_nested_files_and_drops_bad_bytes(spark, tmp_path):
    text = TEXTS["quoted"]
    names = ["a.ipynb", "d/e f/b+c%20.ipynb", "d/note.txt"]
    for name in names:
        os.makedirs(os.path.dirname(tmp_path / name), exist_ok=True)
        (tmp_path / name).write_text(text)
    (tmp_path / "bad.ipynb").write_bytes(text.replace("a", "é").encode("latin-1"))
    found = scan_notebooks(spark, str(tmp_path))
    assert {r.notebook_hash for r in found.collect()} == {*names[:2], "bad.ipynb"}
    assert {r.notebook_hash for r in cellops.explode_cells(found).collect()} == set(names[:2])


def test_slim(spark):
    nb = {"cells": [
        {"cell_type": "code", "source": ["é\n", "b"], "outputs": [{"big": 1}], "metadata": {"t": 1},
         "execution_count": 3},
        {"cell_type": "markdown", "source": 7}, {"cell_type": "markdown"}],
        "metadata": {"kernelspec": {"name": "p", "display_name": "P", "x": 1},
                     "language_info": {"version": "3", "y": {}}, "z": 1},
        "orig_nbformat": 2, "nbformat_minor": 5}
    other = {"cells": [], "metadata": {"kernelspec": 5, "language_info": {"y": 1}}, "nbformat": 3}
    texts = {"n": json.dumps(nb), "o": json.dumps(other), "bad": "{"}
    rows = {r.notebook_hash: r for r in cellops.slim_or_raw(frame(spark, texts)).collect()}
    assert "é" in rows["n"].slim and ": " not in rows["n"].slim
    assert json.loads(rows["n"].slim) == {
        "nbformat": 4, "nbformat_minor": 5,
        "metadata": {"kernelspec": {"name": "p", "display_name": "P"},
                     "language_info": {"version": "3"}, "orig_nbformat": 2},
        "cells": [{"cell_type": "code", "source": ["é\n", "b"], "metadata": {}, "outputs": []},
                  {"cell_type": "markdown", "source": "", "metadata": {}},
                  {"cell_type": "markdown", "source": [], "metadata": {}}]}
    assert json.loads(rows["o"].slim) == {
        "nbformat": 3, "nbformat_minor": 2, "metadata": {}, "cells": []}
    assert rows["bad"].slim is None and rows["bad"].stored == "{" and rows["bad"].fallback


def code_notebook(*sources):
    return json.dumps({"cells": [{"cell_type": "code", "source": s} for s in sources]})


def test_qualify(spark):
    good = ("import pandas as pd", "pd.read_csv (1).head\t(2)")
    cases = [
        (code_notebook(*good), "head", (True, True, True)),
        (code_notebook(*good), "hea", (True, True, False)),
        (code_notebook(*good), None, (True, True, False)),
        (code_notebook("import pandasx", ".read_()"), "a", (False, True, False)),
        (code_notebook("x\r import pandas"), "a", (False, False, False)),
        (code_notebook("x", " import pandas as pd"), "a", (True, False, False)),
        (code_notebook("\x1cimport\x1fpandas"), "a", (True, False, False)),
        (code_notebook("x.a\x1d(1)"), "a", (False, False, True)),
        (code_notebook("\xa0from\u2003pandas\nimport x"), "a", (True, False, False)),
        (code_notebook("x.a+b(1)"), "a+b", (False, False, True)),
        (code_notebook("x.a\\Eb(1)"), "a\\Eb", (False, False, True)),
        ("{", "head", (False, False, False)),
    ]
    nb = spark.createDataFrame([(i, c, k) for i, (c, k, _) in enumerate(cases)],
                               "i int, content string, keyword string")
    for r in curate.qualify(nb).collect():
        wanted = cases[r.i][2]
        assert (r.import_pandas, r.has_read_call, r.has_op_call) == wanted, cases[r.i]
        assert r.kept == all(wanted)


def document(rows):
    return json.loads("".join(r.json for r in sorted(rows, key=lambda r: r.line)))


def test_rebuilt_lines_are_the_documents(spark, tmp_path):
    cells = spark.range(50).selectExpr(
        "if(id < 40, 'big', 'small') notebook_hash", "cast(id as string) cell_id",
        "cast(id as int) cell_pos", "if(id % 3 = 0, 'code', 'markdown') cell_type",
        "if(id = 4, null, concat('s\"', id, '\n')) source")
    code, md = cellops.split_cells(cells)
    rebuilt = cellops.rebuild_notebooks(code, md)
    write_notebooks(rebuilt, str(tmp_path / "rows"))
    write_notebooks(rebuilt, str(tmp_path / "text"), documents=True)
    stored = spark.read.parquet(str(tmp_path / "rows")).collect()
    for name, ids in (("big", range(40)), ("small", range(40, 50))):
        own = [r for r in stored if r.notebook_hash == name]
        assert sorted(r.line for r in own) == list(range(len(ids) + 2))
        nb = document(own)
        assert [c["source"] for c in nb["cells"]] == ["" if i == 4 else f's"{i}\n' for i in ids]
        assert nb["cells"][0].keys() == (
            {"cell_type", "execution_count", "metadata", "outputs", "source"}
            if ids[0] % 3 == 0 else {"cell_type", "metadata", "source"})
        assert (nb["nbformat"], nb["nbformat_minor"]) == (4, 5)
        folder = tmp_path / "text" / f"notebook_hash={name}"
        files = sorted(f for f in os.listdir(folder) if f.startswith("part-"))
        assert json.loads("".join((folder / f).read_text() for f in files)) == nb
    alone = cellops.rebuild_notebooks(*(d.where("notebook_hash = 'small'") for d in (code, md)))
    assert sorted(alone.collect()) == sorted(r for r in stored if r.notebook_hash == "small")


def test_rebuild_orders_by_number_without_positions(spark):
    cells = spark.createDataFrame(
        [("n", str(i), f"s{i}") for i in (10, 9, 2, 1)] + [("n", "zz", "last")],
        "notebook_hash string, cell_id string, source string")
    rows = cellops.rebuild_notebooks(cells, cells.limit(0)).collect()
    assert [c["source"] for c in document(rows)["cells"]] == [
        "s1", "s2", "s9", "s10", "last"]
