"""Notebook documents to cells and back."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from notelake.functions.once import add_once
from notelake.operators.ordering import number_in_notebook

# Only the members in use are materialised; cell outputs are skipped while parsing. Variants stand
# for what may have several forms: a source is text or a list of texts.
CELLS_MEMBER = "cells:array<struct<cell_type:string,id:string,source:variant>>"
OTHER_MEMBERS = {
    "metadata": "struct<kernelspec:variant,language_info:variant>", "nbformat": "variant",
    "nbformat_minor": "variant", "orig_nbformat": "variant"}
# Strict JSON, texts of any length.
PARSING = {"columnNameOfCorruptRecord": "_malformed", "allowSingleQuotes": "false",
           "maxStringLen": "2147483647"}
# A variant holds at most so many bytes. The rare larger source is missing from the parsed document and
# read again as text, which a row holds up to 2 GB of.
LARGEST_VARIANT = 1 << 27

# Metadata of a rebuilt notebook.
REBUILT_TAIL = (
    '],"metadata":{"kernelspec":{"display_name":"Python 3","language":"python",'
    '"name":"python3"},"language_info":{"name":"python"}},"nbformat":4,"nbformat_minor":5}'
)
SLIM_KERNEL = ("name", "display_name")
SLIM_LANGUAGE = ("name", "version")


def _wrapped(text: Column, members: str) -> Column:
    """The text as the one element of a list: whatever stands behind it is an error or an element."""
    return F.from_json(F.concat(F.lit('{"d":['), text, F.lit("]}")),
                       f"struct<d:array<struct<{members}>>,_malformed:string>", PARSING)


def _document(parsed: str) -> Column:
    """The one object, NULL for anything else."""
    whole = F.col(f"{parsed}._malformed").isNull() & (F.size(f"{parsed}.d") == 1)
    return F.when(whole, F.get(f"{parsed}.d", F.lit(0)))


def _kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def _number_text(value: Column) -> Column:
    """A number as Python prints it: 5.0 stays 5.0, 1e20 is 1e+20."""
    plain = F.try_variant_get(value, "$", "string")
    exponent = F.regexp_replace(plain, r"(\.0)?E(-?)(\d+)$", "e$2$3")
    signed = F.regexp_replace(F.regexp_replace(exponent, r"e(\d)", "e+$1"), r"e([+-])(\d)$", "e$10$2")
    fraction = _kind(value).startswith("DECIMAL") & ~F.contains(plain, F.lit("."))
    return F.when(fraction, F.concat(plain, F.lit(".0"))).otherwise(signed)


def _from_variant(cell: Column) -> Column:
    source, kind = cell["source"], _kind(cell["source"])
    plain = F.try_variant_get(source, "$", "string")
    return F.struct(
        cell["cell_type"].alias("cell_type"), cell["id"].alias("id"),
        F.when(kind.startswith("ARRAY"), "list").when(kind == "STRING", "text")
        .when(source.isNull(), "none").otherwise("other").alias("form"),
        F.when(kind == "BOOLEAN", F.initcap(plain))
        .when(kind.startswith("DECIMAL") | (kind == "DOUBLE"), _number_text(source))
        .when(~kind.startswith("ARRAY"), plain).alias("text"),
        F.when(kind.startswith("ARRAY"), F.try_variant_get(source, "$", "array<string>"))
        .alias("lines"),
    )


def _from_views(cell: Column, source: dict[str, Column], small: Column) -> Column:
    """A cell by what its source can be read as; ``small`` is the same cell with a variant, if any.

    What is read as a number, a truth value or an object is no text; it is a variant of its own.
    """
    odd = F.when(source["double"].isNotNull() | source["boolean"].isNotNull()
                 | source["map<string,string>"].isNotNull(), F.try_parse_json(cell["source"]))
    lines, text = source["array<string>"], cell["source"]
    form = (F.when(lines.isNotNull(), "list").when(source["map<string,string>"].isNotNull(), "other")
            .when(text.isNotNull(), "text").otherwise("none"))
    names = [cell["cell_type"].alias("cell_type"), cell["id"].alias("id")]
    large = F.struct(*names, form.alias("form"), F.when(lines.isNull(), text).alias("text"),
                     lines.alias("lines"))
    return (F.when(small["source"].isNotNull(), _from_variant(small))
            .when(odd.isNotNull(), _from_variant(F.struct(*names, odd.alias("source"))))
            .otherwise(large))


def parse_notebooks(
    nb: DataFrame, content: str = "content", members: Mapping[str, str] = {}
) -> DataFrame:
    """Add ``doc``: the cells and the named members, or NULL where the text is no JSON object.

    A cell has its cell_type, id, and source: ``form`` (list, text, none, other), ``text``, ``lines``.
    One parse serves documents of any size; only one with a source above ``LARGEST_VARIANT`` is read
    again, with sources of one type at a time.
    """
    text = F.col(content)
    if dict(nb.dtypes)[content] == "binary":
        text = F.try_validate_utf8(text.cast("string"))
    rest = "".join(f",{name}:{kind}" for name, kind in members.items())
    again = F.col("_again")
    views = {kind: f"_view{i}" for i, kind in enumerate(
        ("array<string>", "map<string,string>", "double", "boolean"))}
    steps = nb.withColumn("_parsed", _wrapped(text, CELLS_MEMBER + rest)).withColumn(
        "_again", F.when(F.col("_parsed._malformed").isNotNull()
                         & (F.octet_length(text) > LARGEST_VARIANT), text)).withColumns({
        "_texts": _wrapped(again, "cells:array<struct<cell_type:string,id:string,source:string>>" + rest),
        **{name: F.from_json(again, f"struct<cells:array<struct<source:{kind}>>>",
                             PARSING | {"allowNonNumericNumbers": "false"})["cells"]
           for kind, name in views.items()}})
    steps = steps.withColumns({"_small": F.get("_parsed.d", F.lit(0)), "_doc": _document("_parsed"),
                               "_long": _document("_texts")}).drop("_parsed", "_texts", "_again")
    cells = F.when(F.col("_long").isNull(), F.transform("_doc.cells", _from_variant)).otherwise(
        F.transform("_long.cells", lambda cell, i: _from_views(
            cell, {k: F.get(v, i)["source"] for k, v in views.items()}, F.get("_small.cells", i))))
    doc = F.when(F.col("_doc").isNotNull() | F.col("_long").isNotNull(), F.struct(
        cells.alias("cells"),
        *[F.coalesce(f"_doc.{n}", f"_small.{n}", f"_long.{n}").alias(n) for n in members]))
    return add_once(steps, "doc", doc).select(*nb.columns, "doc")


def source_text(cell: Column) -> Column:
    """Text of a cell source: null is empty, a list is joined, any other value as text."""
    return F.coalesce(
        F.when(cell["form"] == "list", F.array_join(cell["lines"], "")).otherwise(cell["text"]),
        F.lit(""))


def explode_cells(nb: DataFrame, key: str = "notebook_hash", content: str = "content") -> DataFrame:
    """(notebook_hash, cell_id, cell_pos, cell_type, source): one row per cell of ``nb``."""
    return (
        parse_notebooks(nb, content)
        .select(F.col(key).alias("notebook_hash"), F.posexplode("doc.cells").alias("cell_pos", "c"))
        .select(
            "notebook_hash",
            F.coalesce(F.nullif(F.col("c.id"), F.lit("")), F.col("cell_pos").cast("string"))
            .alias("cell_id"),
            "cell_pos",
            F.col("c.cell_type").alias("cell_type"),
            source_text(F.col("c")).alias("source"),
        )
    )


def split_cells(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(code, markdown); other cell types are dropped."""
    of = lambda kind: cells.where(F.col("cell_type") == kind).drop("cell_type")
    return of("code"), of("markdown")


def _code_cells(doc: str) -> Column:
    return F.filter(
        F.col(f"{doc}.cells"), lambda c: (c["cell_type"] == "code") & (c["form"] != "other"))


def code_text(nb: DataFrame, content: str = "content") -> DataFrame:
    """Add ``code_text``: all code cells of a notebook, one after the other; NULL if malformed."""
    return (
        parse_notebooks(nb, content)
        .withColumn("code_text", F.array_join(
            F.transform(_code_cells("doc"), source_text), "\n"))
        .withColumn("code_text", F.when(F.col("doc").isNotNull(),
                                        F.coalesce("code_text", F.lit(""))))
        .drop("doc")
    )


def _json_text(text: Column) -> Column:
    return F.regexp_replace(F.to_json(F.array(text)), r"(?s)^\[(.*)\]$", "$1")


def _slim_cell(cell: Column) -> Column:
    """A cell as JSON; only list and text sources stay, a missing one is an empty list."""
    source = (
        F.when(cell["form"] == "list", F.to_json(cell["lines"]))
        .when(cell["form"] == "text", _json_text(cell["text"]))
        .when(cell["form"] == "none", "[]").otherwise('""')
    )
    outputs = F.when(cell["cell_type"] == "code", ',"outputs":[]').otherwise("")
    kind = F.coalesce(F.concat(F.lit('"cell_type":'), _json_text(cell["cell_type"]), F.lit(",")),
                      F.lit(""))
    return F.concat(F.lit("{"), kind, F.lit('"source":'), source, F.lit(',"metadata":{}'), outputs,
                    F.lit("}"))


def _allowed(group: str, names: tuple[str, ...]) -> Column:
    """The named entries of a metadata group; NULL when it has none or is no object."""
    entries = F.try_variant_get(f"doc.metadata.{group}", "$", "map<string,variant>")
    kept = F.map_filter(entries, lambda name, _: name.isin(*names))
    return F.when(F.size(kept) > 0, kept).alias(group)


def slim_notebooks(nb: DataFrame, content: str = "content") -> DataFrame:
    """Add ``slim``: the notebook as compact JSON without outputs and spare metadata.

    NULL where the document is malformed.
    """
    number = lambda name, default: F.coalesce(
        F.col(f"doc.{name}"), F.parse_json(F.lit(default))).alias(name)
    head = F.struct(
        number("nbformat", "4"),
        number("nbformat_minor", "2"),
        F.struct(
            _allowed("kernelspec", SLIM_KERNEL), _allowed("language_info", SLIM_LANGUAGE),
            F.col("doc.orig_nbformat").alias("orig_nbformat"),
        ).alias("metadata"),
    )
    cells = F.array_join(F.coalesce(F.transform("doc.cells", _slim_cell), F.array()), ",")
    opening = F.regexp_replace(F.to_json(head), r"\}$", "")
    return (
        parse_notebooks(nb, content, OTHER_MEMBERS)
        .withColumn("slim", F.when(F.col("doc").isNotNull(), F.concat(
            opening, F.lit(',"cells":['), cells, F.lit("]}"))))
        .drop("doc")
    )


def slim_or_raw(nb: DataFrame, content: str = "content") -> DataFrame:
    """Add ``stored`` (slim form, else the content itself) and ``fallback``."""
    return slim_notebooks(nb, content).select(
        "*",
        F.coalesce(F.col("slim"), F.col(content).cast("string")).alias("stored"),
        F.col("slim").isNull().alias("fallback"),
    )


def fallback_counts(stored: DataFrame) -> DataFrame:
    return stored.agg(
        F.count_if(~F.col("fallback")).alias("converted"),
        F.count_if(F.col("fallback")).alias("raw_fallback"),
    )


def _rebuilt_cell() -> Column:
    source = F.coalesce("source", F.lit(""))
    empty = F.create_map().cast("map<string,string>").alias("metadata")
    code = F.struct(
        F.lit("code").alias("cell_type"), F.lit(None).cast("int").alias("execution_count"), empty,
        F.array().cast("array<string>").alias("outputs"), source.alias("source"),
    )
    text = F.struct(F.lit("markdown").alias("cell_type"), empty, source.alias("source"))
    return F.when(
        F.col("cell_type") == "code", F.to_json(code, {"ignoreNullFields": "false"})
    ).otherwise(F.to_json(text, {"ignoreNullFields": "false"}))


def rebuild_notebooks(code: DataFrame, md: DataFrame) -> DataFrame:
    """(notebook_hash, line, json): each notebook as the lines of its JSON text.

    Line 0 opens the document, every cell is a line, the last line closes it; joined in order they
    are the document. Nothing is gathered, whatever the size of a notebook.
    """
    tagged = [df.withColumn("cell_type", F.lit(kind)) for df, kind in ((code, "code"),
                                                                      (md, "markdown"))]
    names = ["notebook_hash", "cell_id", "cell_pos", "cell_type", "source"]
    shared = [n for n in names if any(n in df.columns for df in tagged)]
    cells = tagged[0].unionByName(tagged[1], allowMissingColumns=True).select(shared)
    numbered = number_in_notebook(cells, ["cell_type", "source"]).withColumn("json", F.concat(
        _rebuilt_cell(), F.when(F.col("position") + 1 < F.col("n_cells"), ",").otherwise("")))
    line = lambda number, text: F.struct(
        number.cast("bigint").alias("line"), text.alias("json"))
    lines = F.filter(F.array(
        F.when(F.col("position") == 0, line(F.lit(0), F.lit('{"cells":['))),
        line(F.col("position") + 1, F.col("json")),
        F.when(F.col("position") + 1 == F.col("n_cells"),
               line(F.col("n_cells") + 1, F.lit(REBUILT_TAIL))),
    ), lambda x: x.isNotNull())
    return numbered.select("notebook_hash", F.inline(lines))
