"""Notebook-shaped inputs which Spark derives from the provided tables.

The provided tables hold no code, notebooks or repository links. Cells, documents, hits and links
are built here from their rows, one for one, so that work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from notelake.session import spread

# The vocabularies used by the derived cells.
PANDAS_OPS = {"read_csv": "io", "head": "select", "groupby": "group", "sum": "math",
              "merge": "join", "replace": "value", "dropna": "missing", "pivot": "reshape"}
MPL_OPS = ("plot", "hist", "scatter", "title")
SEABORN_OPS = ("heatmap", "boxplot")

# Cell sources with their metrics worked out by hand; metrics not named are 0.
# $x and $y stand for two different texts from the row.
CELL_CASES = [
    ("import pandas as pd\ndf = pd.read_csv('$x')\ndf.head()",
     dict(LOC=3, S=3, I=1, OPRND=1, UOPRND=1, OPRAT=1, UOPRAT=1, ID=4, PO=2, CO=2, LCO=1, TCO=2),
     dict(read_csv=1, head=1)),
    ("df.dropna().groupby('$x')['$y'].sum()",
     dict(LOC=1, S=1, OPRND=2, UOPRND=2, ID=3, PO=3, CO=2, LCO=2, TCO=3, CI=1, LCI=1, TCI=1),
     dict(dropna=1, groupby=1, sum=1)),
    ("df['$x'].head().str.replace('x', 'y')",
     dict(LOC=1, S=1, OPRND=3, UOPRND=3, ID=3, PO=2, CO=1, LCO=2, TCO=2, CI=1, LCI=1, TCI=1),
     dict(head=1, replace=1)),
    ("df.merge(df.head().values)",
     dict(LOC=1, S=1, ID=4, PO=2, CO=1, LCO=1, TCO=1), dict(merge=1, head=1)),
    ("%matplotlib inline\n!ls $x\n\nprint \"hi\"",
     dict(LOC=4, BLC=1, MSC=2, S=1, OPRND=1, UOPRND=1), {}),
    ("for i in range(3:", dict(LOC=1), {}),
    ("def f(a, *args, b=1, **kw):\n    if a:\n        pass\n    elif b:\n"
     "        for i in a:\n            x = -1\n    return [1, 2]",
     dict(LOC=7, S=7, UDF=1, P=4, NBD=3, OPRND=3, UOPRND=2, OPRAT=2, UOPRAT=2, ID=7), {}),
    ("plt.plot(x); ax.hist(y); axes[0].plot(z); sns.heatmap(c); model.fit(X, y)",
     dict(LOC=1, S=5, OPRND=1, UOPRND=1, ID=14, V=3, TC=1, CI=1, LCI=1, TCI=1), {}),
    ("df.loc[1].iloc[0]['a'] = b = df[df['x'] > 1]",
     dict(LOC=1, S=1, OPRND=5, UOPRND=4, OPRAT=3, UOPRAT=2, ID=4, CI=3, LCI=3, TCI=5), {}),
    ("", {}, {}),
    ("x = {'$x': [1, (2,)], '$y': {}}",
     dict(LOC=1, S=1, OPRND=1, UOPRND=1, OPRAT=1, UOPRAT=1, ID=1), {}),
    ("x = [-1, 2]", dict(LOC=1, S=1, OPRND=2, UOPRND=2, OPRAT=2, UOPRAT=2, ID=1), {}),
    ("async def g(a, /, b, *, c=None):\n    async with a as z:\n        await b\n    match c:\n"
     "        case [1, x]:\n            pass\n        case _:\n            return lambda q: q + a",
     dict(LOC=8, S=6, UDF=1, P=3, NBD=2, OPRND=2, UOPRND=2, OPRAT=1, UOPRAT=1, ID=6), {}),
    ("try:\n    x = {1, 2}\nexcept* ValueError:\n    for i in x:\n        if i:\n"
     "            pass\nelse:\n    while x:\n        x -= 1",
     dict(LOC=9, S=7, NBD=1, OPRND=2, UOPRND=2, OPRAT=2, UOPRAT=2, ID=2), {}),
    ("x = 5 if (n := 3) and not b or c else None\nprint 'a', x\nprinter = x",
     dict(LOC=3, S=3, OPRND=4, UOPRND=4, OPRAT=5, UOPRAT=5, ID=4), {}),
    ("import matplotlib.pyplot as p\nfrom matplotlib import pyplot\n"
     "p.plot(a); pyplot.hist(b); q.plot(c)\nimport seaborn as q\nq.boxplot(d); heatmap(e)",
     dict(LOC=5, S=8, I=3, V=4, ID=12), {}),
]
UNPARSABLE_CASES = (5,)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _columns(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table, spread over the cores when the table is one small file."""
    return spread(table(spark, sf_dir, name).select(*columns))


def pandas_vocab(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(PANDAS_OPS.items()), "function string, category string")


def functions_table(spark: SparkSession, names) -> DataFrame:
    return spark.createDataFrame([(n,) for n in names], "function string")


def _pick(values, index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), index.cast("int") + 1)


def part_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One code cell per part: notebook by brand, case by key."""
    case = F.pmod("p_partkey", F.lit(len(CELL_CASES)))
    filled = _pick([source for source, _, _ in CELL_CASES], case)
    for mark, col in (("$x", "p_brand"), ("$y", "p_type")):
        filled = F.replace(filled, F.lit(mark), F.col(col))
    parts = _columns(spark, sf_dir, "part", "p_partkey", "p_brand", "p_type")
    return parts.select(
        F.col("p_brand").alias("notebook_hash"), F.col("p_partkey").cast("string").alias("cell_id"),
        F.col("p_partkey").alias("cell_pos"), filled.alias("source"),
    )


def sized_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One code cell per part whose sizes follow from ``p_size``."""
    many = lambda text: F.repeat(F.lit(text), F.col("p_size"))
    index = F.repeat(F.concat(F.lit("['"), "p_brand", F.lit("']")), F.col("p_size"))
    source = F.concat(many("x = 1\n"), F.lit("df"), many(".head()"), F.lit(".dropna()\na"), index)
    parts = _columns(spark, sf_dir, "part", "p_partkey", "p_brand", "p_type", "p_size")
    return parts.select(
        F.col("p_type").alias("notebook_hash"), F.col("p_partkey").cast("string").alias("cell_id"),
        source.alias("source"),
    )


def order_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One code cell per order; the notebook is the customer."""
    source = F.format_string(
        "df = pd.read_csv('%s')\nif df['price'].sum() > %d:\n    df.groupby('%s').head(%d)",
        "o_orderpriority", F.floor("o_totalprice"), "o_orderstatus", "o_custkey")
    orders = _columns(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus",
                      "o_totalprice", "o_orderpriority")
    return orders.select(
        F.col("o_custkey").cast("string").alias("notebook_hash"),
        F.col("o_orderkey").cast("string").alias("cell_id"),
        F.col("o_orderkey").alias("cell_pos"), source.alias("source"),
    )


def conversation_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One cell per turn: user turns are code, assistant turns markdown, others raw."""
    kind = (F.when(F.col("role") == "user", "code")
            .when(F.col("role") == "assistant", "markdown").otherwise("raw"))
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("notebook_hash"),
        F.col("turn").cast("string").alias("cell_id"), F.col("turn").alias("cell_pos"),
        kind.alias("cell_type"), F.col("text").alias("source"),
    )


# Turns per derived document: no document grows with the length of a conversation.
TURNS_PER_NOTEBOOK = 64


def conversation_notebooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(notebook_hash, conv_id, content): notebook documents of up to 64 turns.

    Even conversations have list sources, odd ones text sources; cells carry outputs and ids.
    """
    cells = conversation_cells(spark, sf_dir)
    outputs = F.array(F.struct(F.lit("display_data").alias("output_type"),
                               F.lit("iVBORw0KGgo=").alias("image/png"))).alias("outputs")
    head = [F.col("cell_type"),
            F.concat_ws("-", "notebook_hash", "cell_id").alias("id"), outputs]
    pieces = F.array(F.substring("source", 1, 10), F.expr("substring(source, 11)"))
    as_json = F.when(
        F.col("notebook_hash").cast("bigint") % 2 == 0,
        F.to_json(F.struct(*head, pieces.alias("source"))),
    ).otherwise(F.to_json(F.struct(*head, F.col("source"))))
    documents = (
        cells.select(
            "notebook_hash", F.expr(f"cell_pos div {TURNS_PER_NOTEBOOK}").alias("chunk"),
            F.struct("cell_pos", as_json.alias("json")).alias("cell"))
        .groupBy("notebook_hash", "chunk")
        .agg(F.array_sort(F.collect_list("cell")).alias("cells"))
    )
    tail = ('],"metadata":{"kernelspec":{"name":"python3","display_name":"Python 3","env":"x"},'
            '"language_info":{"name":"python","version":"3.11","codemirror_mode":{"version":3}},'
            '"widgets":{}},"nbformat":4,"nbformat_minor":4}')
    return documents.select(
        F.concat_ws("-", "notebook_hash", F.col("chunk").cast("string")).alias("notebook_hash"),
        F.col("notebook_hash").cast("bigint").alias("conv_id"),
        F.concat(F.lit('{"cells":['), F.array_join(F.transform("cells", lambda c: c["json"]), ","),
                 F.lit(tail)).alias("content"),
    )


# Notebooks to qualify, as code texts; $k is the keyword of the row.
QUALIFY_CASES = [
    ("import pandas as pd\n", "df = pd.read_csv('a').$k()", True, True, True),
    ("  from  pandas import DataFrame", "x.read_json (y)\nx.$k (1)", True, True, True),
    ("import pandasx", "x.read_csv(1).$k()", False, True, True),
    ("import pandas", "x.$k_all()", True, False, False),
]


def part_notebooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(notebook_hash, keyword, content): one notebook of two code cells per part."""
    case = F.pmod("p_partkey", F.lit(len(QUALIFY_CASES)))
    keyword = F.split("p_name", " ")[0]
    second = F.replace(_pick([c[1] for c in QUALIFY_CASES], case), F.lit("$k"), keyword)
    cells = F.array(*[
        F.struct(F.lit("code").alias("cell_type"), source.alias("source"))
        for source in (_pick([c[0] for c in QUALIFY_CASES], case), second)])
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("notebook_hash"), keyword.alias("keyword"),
        F.to_json(F.struct(cells.alias("cells"))).alias("content"),
    )


def event_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One search hit per event; hits of a user and type share one link."""
    user = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    repo = F.concat(F.lit("https://github.com/"), user, F.lit("/r"))
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.col("event_id").alias("seq"),
        F.concat(user, F.lit("/r")).alias("repo_name"), repo.alias("repo_url"),
        F.concat(repo, F.lit("/blob/main/"), "event_type", F.lit(".ipynb")).alias("file_url"),
        F.col("props").alias("search_query"), F.col("event_type").alias("keyword"),
        F.col("ts").alias("found_at"), "value",
    )


def raw_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search responses: two text fragments per event, one of which may call the keyword."""
    hits = event_hits(spark, sf_dir)
    shown = F.when(F.col("value") >= 10, F.concat(F.lit("df."), "keyword", F.lit("(x)"))).otherwise(
        F.concat(F.lit("df."), "keyword", F.lit("_x(")))
    return hits.select(
        "seq", F.lit("asc").alias("sort_order"),
        F.struct(F.col("repo_name").alias("full_name"),
                 F.col("repo_url").alias("html_url")).alias("repository"),
        F.col("file_url").alias("html_url"),
        F.array(F.struct(F.col("search_query").alias("fragment")),
                F.struct(shown.alias("fragment"))).alias("text_matches"),
        "search_query", "keyword", "found_at",
    )


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as links: file links where the address has two folders, else other links."""
    link = F.regexp_replace(
        "url", r"^https?://([^/]+)/([^/?#]+)/", "https://github.com/$1/$2/blob/main/")
    repo = F.regexp_replace(link, r"/blob/main/.*$", "")
    ending = _pick(["", "/", ".git", ".git/"], F.pmod("page_id", F.lit(4)))
    return table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("seq"), link.alias("file_url"),
        F.concat(F.lit(" "), repo, ending, F.lit("\t")).alias("repo_url"),
    )


def part_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captured file trees: 50 parts make a repository with answers for three references.

    The default reference never answers; ``main`` does for two thirds of the repositories.
    """
    parts = table(spark, sf_dir, "part")
    path = F.concat("p_type", F.lit("/"), F.replace("p_name", F.lit(" "), F.lit("_")),
                    F.lit("_"), F.col("p_partkey").cast("string"),
                    F.when(F.col("p_size") % 2 == 0, ".CSV").otherwise(".ipynb"))
    entry = F.struct(F.when(F.col("p_size") % 5 == 0, "tree").otherwise("blob").alias("type"),
                     path.alias("path"))
    trees = parts.groupBy(F.expr("p_partkey div 50").alias("number")).agg(
        F.collect_list(entry).alias("tree"))
    answers = [("dev", 0, F.lit(False)), ("main", 1, F.col("number") % 3 != 0),
               ("master", 2, F.col("number") % 6 != 0)]
    responses = F.array(*[
        F.struct(F.lit(ref).alias("ref"), F.lit(priority).alias("priority"),
                 F.when(answered, F.col("tree")).alias("tree"))
        for ref, priority, answered in answers])
    return trees.select(
        F.concat(F.lit("o/r"), F.col("number").cast("string")).alias("repo_name"),
        F.inline(responses))
