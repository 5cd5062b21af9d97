"""Cell metrics: worked examples, real code against plain definitions, and invariants."""

import ast
import glob
import os
import random
import warnings
from collections import Counter
from functools import partial

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from notelake import session
from notelake.functions import cellsyntax
from notelake.functions.cellsyntax import Vocabulary, cell_facts
from notelake.operators import metrics
from notelake.operators.aggregates import notebook_rollup, op_counts, op_summary, run_totals
from notelake.plans.fixtures import (
    CELL_CASES, MPL_OPS, PANDAS_OPS, SEABORN_OPS, UNPARSABLE_CASES, pandas_vocab,
)
from notelake.plans import fixtures as fx
from notelake.schemas import METRICS

VOCAB = Vocabulary(frozenset(fx.PANDAS_OPS), frozenset(fx.MPL_OPS), frozenset(fx.SEABORN_OPS))


def measure(spark, sources, vocab=VOCAB):
    cells = spark.createDataFrame(
        [("nb", str(i), s) for i, s in enumerate(sources)],
        "notebook_hash string, cell_id string, source string")
    facts = metrics.cell_facts(cells, vocab)
    rows = metrics.metrics_of(facts).collect()
    return {int(r.cell_id): r for r in rows}, facts


def test_worked_examples(spark):
    sources = [s.replace("$x", "one").replace("$y", "two") for s, _, _ in CELL_CASES]
    rows, facts = measure(spark, sources)
    for i, (source, wanted, _) in enumerate(CELL_CASES):
        found = {m: rows[i][m] for m in METRICS if rows[i][m]}
        assert found == wanted, source
        assert (rows[i].parse_error is not None) == (i in UNPARSABLE_CASES)
    counted = sum((Counter(ops) for _, _, ops in CELL_CASES), Counter())
    assert {r.function: r["count"] for r in op_counts(facts).collect()} == dict(counted)
    summary = op_summary(pandas_vocab(spark), op_counts(facts)).collect()
    assert [(r.category, r.function, r["count"]) for r in summary] == [
        (PANDAS_OPS[f], f, counted[f]) for f in sorted(PANDAS_OPS)]


# (source, metrics that matter)
SMALL = [
    ("df.head().str.strip().sum()", dict(PO=2, CO=2, TCO=2, LCO=1)),
    ("df.head().str.sum()", dict(PO=2, CO=1, TCO=2)),
    ("df.head().dt.cat.sum().merge(x)", dict(PO=3, CO=1, LCO=3)),
    ("df.merge(df.head())", dict(PO=2, CO=2, TCO=2)),
    ("df.merge(right=df.head().values)", dict(PO=2, CO=2)),
    ("df.merge(df.head().str)", dict(PO=2, CO=2)),
    ("df.merge(*df.head().values)", dict(PO=2, CO=2)),
    ("foo(df.head().values)", dict(PO=1, CO=1)),
    ("head(df)", dict(PO=0)),
    ("df['a'].head()", dict(CI=1, PO=1)),
    ("df['a'].head()['b']", dict(CI=2, LCI=1)),
    ("df['a'].values['b']", dict(CI=2)),
    ("df['a'].loc['b'].iloc[0]", dict(CI=1, LCI=3)),
    ("df[df['a'][0]]", dict(CI=2, TCI=3)),
    ("from seaborn import heatmap\nseaborn.heatmap(1)", dict(V=1, I=1)),
    ("seaborn.heatmap(1)\nimport seaborn", dict(V=0)),
    ("import matplotlib.pyplot\nmatplotlib.pyplot.plot(1)", dict(V=0, ID=3)),
    ("import seaborn as plt\nplt.plot(1); plt.heatmap(1)", dict(V=2)),
    ("axes[0].plot(z)", dict(V=0)),
    ("x.fit(y).train(z); fit_transform(x)", dict(TC=3)),
    ("a < b < c", dict(OPRAT=2, UOPRAT=1)),
    ("a = b = c\nd: int = 1", dict(OPRAT=2, UOPRAT=1)),
    ("a += 1; b -= 1; a + b - c", dict(OPRAT=4, UOPRAT=4)),
    ("f'{x!r:>{w}} y'", dict(OPRND=2, ID=2)),
    ("{**{'a': 1}}", dict(OPRND=1)),
    ("[*[1]]", dict(OPRND=1)),
    ("(1, [2, x])", dict(OPRND=2, UOPRND=2)),
    ("1; True; 1.0; 1", dict(OPRND=4, UOPRND=3)),
    ("lambda a, b=1: c", dict(P=0, UDF=0, ID=1)),
    ("from m import *", dict(ID=1, I=1)),
    ("import a.b.c as d, e.f", dict(ID=2, I=1)),
    ("try:\n  x\nexcept E:\n  if a:\n    pass", dict(NBD=2)),
    ("if a:\n  x\nelse:\n  if b:\n    y\n  z", dict(NBD=2)),
    ("if a:\n  x\nelif b:\n  y\nelif c:\n  if d:\n    pass", dict(NBD=2)),
    ("class A:\n  @d\n  def f(self): return 1", dict(NBD=2, P=1, S=3)),
    ("print >>f, 1", dict()),
    ("print 'a'\nprint\nprint >>f, 'b'", dict(S=3, OPRND=2)),
    ("def f():\n  print 'a'", dict(S=2, UDF=1)),
    ("print 'a', (", dict(LOC=1)),
    ("x = 0x" + "f" * 6000, dict(OPRND=1)),
]


def test_small_cells(spark):
    rows, _ = measure(spark, [s for s, _ in SMALL])
    for i, (source, wanted) in enumerate(SMALL):
        assert {m: rows[i][m] for m in wanted} == wanted, source


def test_unreadable_cells_keep_their_lines(spark):
    sources = ["a\x00b", "(" * 300 + ")" * 300, "x" + "+x" * 100_000, "-" * 50_000 + "1", "a b"]
    rows, facts = measure(spark, sources)
    assert all(rows[i].LOC == 1 for i in range(5))
    for i in (0, 1, 4):
        assert rows[i].parse_error.startswith("SyntaxError")
        assert all(rows[i][m] == 0 for m in METRICS if m not in ("LOC", "BLC", "MSC"))
    totals = run_totals(metrics.metrics_of(facts)).first()
    assert totals.total_rows == 5 and totals.parse_errors >= 3


# ---- plain definitions, by search over the whole tree -------------------------------------------


def plain_metrics(code):
    tree = ast.parse(code)
    nodes = list(ast.walk(tree))
    parent = {child: node for node in nodes for child in ast.iter_child_nodes(node)
              if not isinstance(child, (ast.expr_context, ast.operator, ast.unaryop, ast.cmpop,
                                        ast.boolop))}
    of = lambda *kinds: [n for n in nodes if isinstance(n, kinds)]
    defs = of(ast.FunctionDef, ast.AsyncFunctionDef)
    params = [a for d in defs for a in ast.walk(d.args)
              if isinstance(a, ast.arg) and parent[a] is d.args]
    named = lambda c: isinstance(c, ast.Call) and isinstance(c.func, ast.Attribute)
    ops = [c for c in of(ast.Call) if named(c) and c.func.attr in VOCAB.pandas]

    def next_op(call):
        base = call.func.value
        while isinstance(base, ast.Attribute) and base.attr in ("str", "dt", "cat"):
            base = base.value
        return base if base in ops else None

    def is_tail(call):
        here = call
        while (isinstance(parent[here], ast.Attribute)
               and parent[here].attr in ("str", "dt", "cat")):
            here = parent[here]
        above = parent[here]
        if not isinstance(above, ast.Attribute):
            return True
        return parent[above] not in ops

    def run(call):
        return 0 if call is None else 1 + run(next_op(call))

    def base_of(sub):
        base = sub.value
        while isinstance(base, ast.Attribute) and base.attr in ("loc", "iloc", "at", "iat"):
            base = base.value
        return base if isinstance(base, ast.Subscript) else None

    subs = of(ast.Subscript)
    bases = {base_of(s) for s in subs}
    depth_of = lambda s: 0 if s is None else 1 + depth_of(base_of(s))
    chains = [run(c) for c in ops if is_tail(c)]
    index = [depth_of(s) for s in subs if s not in bases]
    containers = of(ast.List, ast.Tuple, ast.Set, ast.Dict)

    def literal(node):
        if isinstance(node, ast.Constant):
            return True
        if isinstance(node, ast.Dict):
            return all(k is None or literal(k) for k in node.keys) and all(
                map(literal, node.values))
        return isinstance(node, (ast.List, ast.Tuple, ast.Set)) and all(map(literal, node.elts))

    whole = {c for c in containers if literal(c)}

    def in_whole(node):
        while node in parent:
            node = parent[node]
            if node in whole:
                return True
        return False

    operands = [type(n).__name__ for n in whole if not in_whole(n)] + [
        "=" + repr(n.value) for n in of(ast.Constant) if not in_whole(n)]
    return dict(
        S=len(of(ast.stmt)), I=len(of(ast.Import, ast.ImportFrom)), UDF=len(defs), P=len(params),
        PO=len(ops), CO=len(chains), TCO=sum(chains), LCO=max(chains, default=0),
        CI=len(index), TCI=sum(index), LCI=max(index, default=0),
        OPRND=len(operands), UOPRND=len(set(operands)),
        OPRAT=(len(of(ast.BinOp, ast.UnaryOp, ast.AugAssign, ast.NamedExpr))
               + sum(len(n.values) - 1 for n in of(ast.BoolOp))
               + sum(len(n.ops) for n in of(ast.Compare))
               + sum(len(n.targets) for n in of(ast.Assign))),
    )


def folded(code, vocab=VOCAB):
    error, facts = cell_facts(code, vocab)
    assert error is None
    times = lambda kind: sum(facts[kind].values())
    sizes = lambda kind: [v for (_, v), n in facts[kind].items() for _ in range(n)]
    return dict(
        S=times("stmt"), I=times("import"), UDF=times("def"), P=sum(sizes("def")), PO=times("op"),
        CO=times("chain"), TCO=sum(sizes("chain")), LCO=max(sizes("chain"), default=0),
        CI=times("index"), TCI=sum(sizes("index")), LCI=max(sizes("index"), default=0),
        OPRND=times("operand"), UOPRND=len(facts["operand"]), OPRAT=times("operator"))


def library_files():
    folder = os.path.dirname(os.__file__)
    files = sorted(glob.glob(f"{folder}/*.py") + glob.glob(f"{folder}/test/test_*.py"))
    small = [f for f in files if os.path.getsize(f) < 30_000]
    return random.Random(3).sample(small, min(60, len(small)))


@pytest.mark.parametrize("path", library_files())
def test_real_code_agrees_with_plain_definitions(path):
    with open(path, encoding="utf-8", errors="replace") as handle:
        code = handle.read()
    try:
        ast.parse(code)
    except SyntaxError:
        pytest.skip("not for this interpreter")
    # Common method names as vocabulary, so that chains occur.
    assert folded(code) == plain_metrics(code)


def random_chain(rng, depth=0):
    parts = [rng.choice(["df", "x", "pd"])]
    for _ in range(rng.randrange(6)):
        inner = random_chain(rng, depth + 1) if depth < 3 and rng.random() < 0.4 else "1"
        parts.append(rng.choice([
            f".head({inner})", f".merge({inner}, k={inner})", ".str", ".dt", ".cat", ".values",
            f"[{inner}]", ".loc", ".iloc", f".foo({inner})", f".sum(*[{inner}])"]))
    return "".join(parts)


def test_random_chains_agree_with_plain_definitions():
    rng = random.Random(11)
    for _ in range(3000):
        code = random_chain(rng)
        assert folded(code) == plain_metrics(code), code


def test_invariants_and_rollup(spark):
    rng = random.Random(5)
    rows, facts = measure(spark, [random_chain(rng) for _ in range(300)])
    for r in rows.values():
        assert r.LCO <= r.TCO <= r.PO and r.CO <= r.PO and r.LCI <= r.TCI
        assert r.UOPRND <= r.OPRND and r.UOPRAT <= r.OPRAT and r.BLC <= r.LOC >= r.MSC
    total = notebook_rollup(metrics.metrics_of(facts)).first()
    assert total.n_cells == 300
    assert total.PO == sum(r.PO for r in rows.values())
    assert total.LCO == max(r.LCO for r in rows.values())
    counted = op_counts(facts).agg(F.sum("count")).first()[0]
    assert counted == total.PO


def test_long_form_has_every_fact(spark):
    _, facts = measure(spark, ["df.head().head()", ""])
    rows = metrics.cell_fact_rows(facts).collect()
    assert {(r.kind, r.name, r.value, r.times) for r in rows if r.cell_id == "0"} == {
        ("stmt", "Expr", None, 1), ("op", "head", None, 2), ("chain", None, 2, 1),
        ("ident", "df", None, 1), ("ident", "head", None, 2)}


def test_vocabularies_are_trimmed_and_read_whole(spark):
    many = spark.range(150_000).selectExpr("concat(' f', id, ' ') as function")
    found = metrics.vocabulary(many.unionByName(many))
    assert found == metrics.vocabulary(many.selectExpr("trim(function) as function"))
    padded = spark.createDataFrame([(" head ",), ("head",), ("",), (None,)], "function string")
    cells = spark.createDataFrame([("n", "0", "df.head()")],
                                  "notebook_hash string, cell_id string, source string")
    assert metrics.cell_metrics(cells, metrics.vocabulary(padded)).first()["PO"] == 1


LITERAL_CELLS = [
    "a = 'x' + 1", "a = 'y' + 2", "f('a', 'a', 3, 3, 16, 0x10)", "f('it', \"it's\")", "x = ('a' 'b')",
    "x = ('a'\n  'c')", "f'{1}' + '2'", "rb'1'", "u'1' + '1'", "'''a 1'''", '"""it\'s 1"""', "x = 1 # '2'",
    "'# 1'", "x['a'][0]", "[1, 'a']", "{1: 'a', **b}", "x = 1.5 + 1", "1e5, 1j, 1_000, 00, 007", "x1 = 1",
    "x = 'a\\n' + 'b'", "1 .real", "1if x else 2", "'a'if x else'b'", "print 'a', 1", "print('a' 1)", "1 = x",
    "'é' + 'ü'", "é = 'a'", "a·1 = 1", "x = '1\t2'", "match x:\n    case 1: 'a'\n    case -2: 'b'", "f(1, 1)",
    "df.groupby('a').head(1)", "df.head(1).merge(df.head(2), on='k')", "x = 1000000000000000000 + 1",
    "1000000000000000000000 + 5", "x = '⟦0⟧' + y('⟦1⟧')", "a = '1'\nb = 1", "def f(a=1, b='c'):\n    'doc'",
    "def f():\n    'é'\n    return - 1", "x = 'a' % 1", "x = '\x7f'", "'a'\n\n'b'", "1\n2", "x = \"a'b\" + 'c\"d'",
    "f(a='x', b=0)", "x[1:2, ::3]", "lambda x=1: 'a'", "with open('a') as f: 1", "import a.b as c; c('1', 2)",
    "plt.plot(1, 'r'); sns.heatmap(2)", "a = b'x' + b\"y\"", "'unclosed + 1", "x = '\0'", "", "1", "''",
]


def test_templates_give_what_a_parse_gives():
    """Cells that differ in literals only share a parse; names, values, times and order stay the same."""
    vocab = cellsyntax.Vocabulary(frozenset(fx.PANDAS_OPS), frozenset(fx.MPL_OPS), frozenset(fx.SEABORN_OPS))
    made = []

    def template(*key):
        made.append(key)
        return cellsyntax._template(*key, vocab)

    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        for code in LITERAL_CELLS:
            error, facts = cellsyntax._facts_by_template(code, vocab, template)
            wanted, parsed = cellsyntax.cell_facts(code, vocab)
            assert error == wanted, code
            assert {k: list(v.items()) for k, v in facts.items()} == {
                k: list(v.items()) for k, v in parsed.items()}, code
    assert made[0] == made[1] and len(made) > 15


def test_cells_that_differ_in_literals_are_parsed_once(monkeypatch):
    parsed, parse = [], cellsyntax._parse
    monkeypatch.setattr(cellsyntax, "_parse", lambda code: parsed.append(code) or parse(code))
    codes = pa.array([f"df['{n}'].head({n})" for n in range(100)])
    run = partial(cellsyntax.cell_facts, vocab=Vocabulary(frozenset(["head"])))
    shared = cellsyntax.remembering(Vocabulary(frozenset(["head"])))
    facts = cellsyntax._facts_of_batch(codes, shared, run).to_pylist()
    assert len(parsed) == 1
    assert [{o["name"] for o in f["operand"]} for f in facts] == [
        {f"CONST:{n}", f"CONST:'{n}'"} for n in range(100)]


def test_no_task_grows_with_the_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "ROWS_PER_TASK", 100, raising=False)
    spark.range(2000).coalesce(1).write.parquet(str(tmp_path / "t"))
    rows = session.spread(spark.read.parquet(str(tmp_path / "t"))).groupBy(F.spark_partition_id()).count()
    assert max(r["count"] for r in rows.collect()) <= 200
