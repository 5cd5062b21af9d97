"""Python cell text -> syntax facts, as one Arrow UDF.

The UDF only lists what occurs in a cell; every metric is Spark arithmetic over that list
(``operators.metrics``). A fact is (name, value, times): what was seen, a size where the kind
has one (parameters, depth, chain length), and how often it was seen.
"""

from __future__ import annotations

import ast
import re
import sys
import warnings
from dataclasses import dataclass, field
from functools import lru_cache, partial

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F

# The functions below travel to the executors by value, the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Kinds of facts, and the name lists that steer chains and special calls.
KINDS = ("stmt", "import", "def", "block", "operand", "operator", "ident", "op", "chain",
         "index", "visual", "train")
ACCESSORS = ("str", "dt", "cat")
INDEXERS = ("loc", "iloc", "at", "iat")
TRAINING = ("fit", "fit_transform", "partial_fit", "train", "fit_generator")
PLOT_BASES = (("mpl", "plt"), ("mpl", "ax"), ("mpl", "axs"), ("mpl", "axes"), ("mpl", "axis"),
              ("seaborn", "sns"))

FACT = "struct<name:string,value:bigint,times:bigint>"
# Cells up to this length are worth remembering.
SHORT = 200
# Plain literals, whose values show in operands only; all other uses of these marks are odd. The pattern
# begins with a set of characters, which is found fast; what stands before them is looked at afterwards.
_LITERAL = re.compile(
    r"""(['"0-9](?:(?<=')(?<!\w')[^'\\\x00-\x1f]*'|(?<=")(?<!\w")[^"\\\x00-\x1f]*"|"""
    r"""(?<=[1-9])(?<![\w.][1-9])[0-9]{0,17}(?![\w.])|(?<=0)(?<![\w.]0)(?![\w.])))""")
_ODD = re.compile(r"""['"\\#\r\f]""")
RESULT = "struct<error:string," + ",".join(f"`{k}`:array<{FACT}>" for k in KINDS) + ">"

_BLOCKS = frozenset((
    ast.If, ast.For, ast.AsyncFor, ast.While, ast.With, ast.AsyncWith, ast.Try, ast.Match,
    ast.FunctionDef, ast.AsyncFunctionDef, ast.ClassDef))
_NESTING = _BLOCKS | {ast.TryStar}
_LITERAL_PARTS = (ast.Constant, ast.List, ast.Tuple, ast.Set, ast.Dict, ast.expr_context)
# Parts of a syntax node that hold marks or plain values, nothing to walk into.
_PLAIN = {"ctx", "op", "ops", "id", "attr", "asname", "module", "level", "kind", "type_comment",
          "conversion", "simple", "is_async", "kwd_attrs", "rest", "names"}
# Per node type the other parts, last one first.
_PARTS = {node: tuple(part for part in reversed(node._fields) if part not in _PLAIN)
          for node in vars(ast).values()
          if isinstance(node, type) and issubclass(node, ast.AST)
          and (node is ast.Constant or not issubclass(node, ast.Constant))}


@dataclass(frozen=True)
class Vocabulary:
    """Function names of the three libraries whose calls are told apart."""

    pandas: frozenset = field(default_factory=frozenset)
    mpl: frozenset = field(default_factory=frozenset)
    seaborn: frozenset = field(default_factory=frozenset)


def _call_parentheses(line: str) -> str:
    found = re.match(r"(\s*)print(?!\()(.*)\Z", line, re.S)
    if not found or found[2].strip().startswith(">>"):
        return line
    return f"{found[1]}print({found[2].strip()})"


def _parse(code: str):
    """(tree, None) or (None, error text); Python 2 prints get one repair."""
    try:
        return ast.parse(code), None
    except (SyntaxError, ValueError, RecursionError, MemoryError) as problem:
        if "Missing parentheses in call to 'print'" in str(problem):
            repaired = "\n".join(map(_call_parentheses, code.splitlines()))
            try:
                return ast.parse(repaired), None
            except (SyntaxError, ValueError, RecursionError, MemoryError):
                pass
        return None, f"{type(problem).__name__}: {problem}"


def _past(node, attributes):
    """The expression below any of these attribute names."""
    while isinstance(node, ast.Attribute) and node.attr in attributes:
        node = node.value
    return node


def _chain_length(link, below) -> int:
    length = 0
    while link is not None:
        length, link = length + 1, below(link)
    return length


def _plot_aliases(node):
    """(library, alias) pairs which an import statement adds."""
    for item in node.names:
        if isinstance(node, ast.Import):
            if item.name == "pyplot" or item.name.startswith("matplotlib.pyplot"):
                yield "mpl", item.asname or item.name
            elif item.name == "seaborn":
                yield "seaborn", item.asname or item.name
        elif node.module == "matplotlib" and item.name == "pyplot":
            yield "mpl", item.asname or item.name
        elif node.module == "seaborn":
            yield "seaborn", "seaborn"


def _depth_below(node, part: str, value, depth):
    """Block depth of the statements in one part of a block (None hides them)."""
    if depth is None or type(node) is ast.TryStar:
        return None if part == "handlers" else depth
    if type(node) is ast.If and part == "orelse" and len(value) == 1 and type(value[0]) is ast.If:
        return depth
    return depth + 1


class _Cell:
    """What is known so far about one cell while its tree is walked."""

    __slots__ = ("vocab", "facts", "plot_bases", "in_chain", "in_index")

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.facts = {kind: {} for kind in KINDS}
        self.plot_bases = set(PLOT_BASES)
        self.in_chain, self.in_index = set(), set()

    def saw(self, kind, name=None, value=None, times=1):
        seen = self.facts[kind]
        seen[name, value] = seen.get((name, value), 0) + times

    def is_op(self, node) -> bool:
        return (type(node) is ast.Call and type(node.func) is ast.Attribute
                and node.func.attr in self.vocab.pandas)

    def op_below(self, call):
        base = _past(call.func.value, ACCESSORS)
        return base if self.is_op(base) else None


def _index_below(subscript):
    base = _past(subscript.value, INDEXERS)
    return base if type(base) is ast.Subscript else None


# What each kind of node adds. A true result ends the walk at that node.


def _note_constant(cell, node):
    cell.saw("operand", f"CONST:{_constant_text(node.value)}")
    return True


def _note_container(cell, node):
    if all(isinstance(part, _LITERAL_PARTS) for part in ast.walk(node)):
        cell.saw("operand", type(node).__name__)
        return True


def _note_name(cell, node):
    cell.saw("ident", node.id)
    return True


def _note_attribute(cell, node):
    cell.saw("ident", node.attr)


def _note_import(cell, node):
    cell.saw("import", type(node).__name__)
    for item in node.names:
        cell.saw("ident", item.asname or item.name.split(".")[-1])
    cell.plot_bases.update(_plot_aliases(node))


def _note_class(cell, node):
    cell.saw("ident", node.name)


def _note_def(cell, node):
    args = node.args
    named = [*args.posonlyargs, *args.args, *args.kwonlyargs,
             *filter(None, (args.vararg, args.kwarg))]
    cell.saw("def", node.name, len(named))
    for name in (node.name, *(one.arg for one in named)):
        cell.saw("ident", name)


def _note_call(cell, node):
    func, vocab = node.func, cell.vocab
    if type(func) is ast.Name:
        called = func.id
        plots = called in vocab.seaborn or called in vocab.mpl
    elif type(func) is ast.Attribute:
        called = func.attr
        base = func.value.id if type(func.value) is ast.Name else None
        plots = ((called in vocab.mpl and ("mpl", base) in cell.plot_bases)
                 or (called in vocab.seaborn and ("seaborn", base) in cell.plot_bases))
    else:
        return
    if called in TRAINING:
        cell.saw("train", called)
    if plots:
        cell.saw("visual", called)
    if type(func) is ast.Name or called not in vocab.pandas:
        return
    cell.saw("op", called)
    if id(node) not in cell.in_chain:
        cell.saw("chain", None, _chain_length(node, cell.op_below))
    # A call below one of these attributes does not end a chain, even as an argument.
    for part in (func, *node.args):
        if type(part) is ast.Attribute and part.attr not in ACCESSORS:
            cell.in_chain.add(id(_past(part.value, ACCESSORS)))


def _note_subscript(cell, node):
    if id(node) not in cell.in_index:
        cell.saw("index", None, _chain_length(node, _index_below))
    cell.in_index.add(id(_index_below(node)))


def _note_operation(cell, node):
    cell.saw("operator", type(node.op).__name__)


def _note_boolean(cell, node):
    cell.saw("operator", type(node.op).__name__, None, len(node.values) - 1)


def _note_comparison(cell, node):
    for op in node.ops:
        cell.saw("operator", type(op).__name__)


def _note_assignment(cell, node):
    cell.saw("operator", "Assign", None, len(node.targets))


def _note_update(cell, node):
    cell.saw("operator", f"AugAssign_{type(node.op).__name__}")


def _note_walrus(cell, node):
    cell.saw("operator", "NamedExpr")


_NOTES = {
    ast.Constant: _note_constant, ast.List: _note_container, ast.Tuple: _note_container,
    ast.Set: _note_container, ast.Dict: _note_container, ast.Name: _note_name,
    ast.Attribute: _note_attribute, ast.Import: _note_import, ast.ImportFrom: _note_import,
    ast.ClassDef: _note_class, ast.FunctionDef: _note_def, ast.AsyncFunctionDef: _note_def,
    ast.Call: _note_call, ast.Subscript: _note_subscript, ast.BinOp: _note_operation,
    ast.UnaryOp: _note_operation, ast.BoolOp: _note_boolean, ast.Compare: _note_comparison,
    ast.Assign: _note_assignment, ast.AugAssign: _note_update, ast.NamedExpr: _note_walrus,
}


def cell_facts(code: str, vocab: Vocabulary):
    """(error, {kind: {(name, value): times}}) for one cell, in one walk from the top."""
    tree, error = _parse(code)
    cell = _Cell(vocab)
    pending = [(tree, 0)] if tree is not None else []
    while pending:
        node, depth = pending.pop()
        kind = type(node)
        note = _NOTES.get(kind)
        if note is not None and note(cell, node):
            continue
        nests = kind in _NESTING
        if isinstance(node, ast.stmt):
            cell.saw("stmt", kind.__name__)
            if nests and depth is not None and kind in _BLOCKS:
                cell.saw("block", kind.__name__, depth + 1)
        # The last one pushed is the next one walked: children come in the order of the text.
        for part in _PARTS[kind]:
            value = getattr(node, part)
            inner = _depth_below(node, part, value, depth) if nests else depth
            if type(value) is list:
                for child in reversed(value):
                    if isinstance(child, ast.AST):
                        pending.append((child, inner))
            elif isinstance(value, ast.AST):
                pending.append((value, inner))
    return error, cell.facts


def _literals(code: str):
    """(text between the literals, their kinds, literals), or None for a cell that has to be parsed as
    it is: with comments, escapes, long or prefixed strings, or literals side by side."""
    if "\0" in code:
        return None
    parts = _LITERAL.split(code)
    between, literals = "\0".join(parts[::2]), parts[1::2]
    if not literals or not between.isascii() or _ODD.search(between):
        return None
    if any(not part or part.isspace() for part in parts[2:-1:2]):
        return None
    return between, "".join("t" if literal[0] in "'\"" else "n" for literal in literals), literals


def _template(between: str, kinds: str, vocab: Vocabulary):
    """(facts, operands) of all cells that differ in plain literals only; None if they are no such cells.

    Operands are (name, times, number of the literal that gives the name or None), as they come up.
    """
    marks = [f"\u27e6{i}\u27e7" if kind == "t" else str(10**18 + i) for i, kind in enumerate(kinds)]
    shown = [repr(mark) if kind == "t" else mark for mark, kind in zip(marks, kinds)]
    parts = between.split("\0")
    error, facts = cell_facts("".join(x for pair in zip(parts, [*shown, ""]) for x in pair), vocab)
    if error is not None:
        return None
    of = {f"CONST:{text}": i for i, text in enumerate(shown)}
    operands = [(name, times, of.get(name)) for (name, _), times in facts["operand"].items()]
    names = [name for kind in KINDS for name, _ in facts[kind] if name and not (
        kind == "operand" and name in of)]
    if any(times > 1 for _, times, i in operands if i is not None) or any(
            mark in name for name in names for mark in marks):
        return None
    return facts, operands


def _facts_by_template(code: str, vocab: Vocabulary, template):
    """What ``cell_facts`` gives, with one parse for all cells that differ in plain literals only."""
    found = _literals(code)
    known = template(*found[:2]) if found else None
    if known is None:
        return cell_facts(code, vocab)
    facts, operands = known
    seen = {}
    for name, times, i in operands:
        if i is not None:
            literal = found[2][i]
            name = f"CONST:{literal if found[1][i] == 'n' else repr(literal[1:-1])}"
        seen[name, None] = seen.get((name, None), 0) + times
    return None, {**facts, "operand": seen}


def _constant_text(value) -> str:
    try:
        return repr(value)
    except ValueError:  # integers beyond the decimal conversion limit
        return hex(value)


def _facts_of_batch(codes: pa.Array, remembered, fresh) -> pa.Array:
    errors, columns = [], {kind: ([0], [], [], []) for kind in KINDS}
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        for code in codes.to_pylist():
            code = code or ""
            error, facts = (remembered if len(code) <= SHORT else fresh)(code)
            errors.append(error)
            for kind, (offsets, names, values, times) in columns.items():
                for (name, value), count in facts[kind].items():
                    names.append(name)
                    values.append(value)
                    times.append(count)
                offsets.append(len(times))
    lists = [
        pa.ListArray.from_arrays(
            pa.array(offsets, pa.int32()),
            pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(values, pa.int64()),
                 pa.array(times, pa.int64())], ["name", "value", "times"]))
        for offsets, names, values, times in columns.values()
    ]
    return pa.StructArray.from_arrays(
        [pa.array(errors, pa.string()), *lists], ["error", *columns])


def remembering(vocab: Vocabulary):
    """``cell_facts`` of short cells, which remembers cells and templates of cells."""
    template = lru_cache(20_000)(partial(_template, vocab=vocab))
    return lru_cache(20_000)(partial(_facts_by_template, vocab=vocab, template=template))


def facts_udf(vocab: Vocabulary):
    """Arrow UDF ``code -> RESULT``; the vocabulary travels with the closure."""
    per_task = {}  # short cells such as ``df.head()`` come up again and again

    def analyse(codes: pa.Array) -> pa.Array:
        sys.setrecursionlimit(max(sys.getrecursionlimit(), 20_000))
        if not per_task:
            per_task["facts"] = remembering(vocab)
        return _facts_of_batch(codes, per_task["facts"], partial(cell_facts, vocab=vocab))

    return F.arrow_udf(analyse, RESULT)
