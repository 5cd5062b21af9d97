"""Per-cell metrics: line metrics in the JVM, syntax metrics by arithmetic over facts."""

from __future__ import annotations

import builtins
import keyword
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from notelake.functions.cellsyntax import KINDS, Vocabulary, facts_udf
from notelake.functions.once import add_once
from notelake.functions.text import (
    is_blank, is_magic, split_lines, unify_breaks, without_last_break,
)
from notelake.schemas import METRICS
from notelake.sources.tables import load_vocab

# Names that never count as identifiers, as the driver's interpreter knows them.
RESERVED = sorted({*keyword.kwlist, *dir(builtins)})


def line_metrics(cells: DataFrame, source: str = "source") -> DataFrame:
    """Add LOC, BLC, MSC and ``code`` (the source without magic and shell lines)."""
    text = F.coalesce(F.col(source), F.lit(""))
    return (
        cells.withColumn("_text", unify_breaks(text))
        .withColumn("_closed", without_last_break(F.col("_text")))
        .withColumn("_lines", split_lines(F.col("_closed"), F.col("_text")))
        .withColumn("LOC", F.size("_lines").cast("bigint"))
        .withColumn("BLC", F.size(F.filter("_lines", is_blank)).cast("bigint"))
        .withColumn("MSC", F.size(F.filter("_lines", is_magic)).cast("bigint"))
        .withColumn("code", F.when(F.col("MSC") == 0, F.col("_closed")).otherwise(
            F.array_join(F.filter("_lines", lambda line: ~is_magic(line)), "\n")))
        .drop("_text", "_closed", "_lines")
    )


def _names(vocab: DataFrame | None) -> frozenset:
    if vocab is None:
        return frozenset()
    return frozenset(row["function"] for row in load_vocab(vocab).collect())


def vocabulary(
    pandas: DataFrame, mpl: DataFrame | None = None, seaborn: DataFrame | None = None
) -> Vocabulary:
    """Load the vocabulary tables (column ``function``) once, on the driver.

    They list the functions of a library, are read whole and go to every task.
    """
    return Vocabulary(_names(pandas), _names(mpl), _names(seaborn))


def cell_facts(cells: DataFrame, vocab: Vocabulary) -> DataFrame:
    """Line metrics plus ``facts``: one row per cell, no shuffle, one Arrow round trip."""
    lines = line_metrics(cells)
    return (
        add_once(lines, "facts", facts_udf(vocab)(F.col("code")))
        .drop("code")
        .withColumn("parse_error", F.col("facts.error"))
    )


def cell_fact_rows(facts: DataFrame, keys=("notebook_hash", "cell_id")) -> DataFrame:
    """Long form: one row (keys, kind, name, value, times) per fact."""
    def tagged(kind: str) -> Column:
        return F.transform(f"facts.{kind}", lambda fact: F.struct(
            F.lit(kind).alias("kind"), fact["name"].alias("name"),
            fact["value"].alias("value"), fact["times"].alias("times")))

    return facts.select(*keys, F.inline(F.concat(*map(tagged, KINDS))))


def _fold(kind: str, step) -> Column:
    return F.aggregate(F.col(f"facts.{kind}"), F.lit(0).cast("bigint"), step)


def _times(kind: str) -> Column:
    return _fold(kind, lambda total, fact: total + fact["times"])


def _volume(kind: str) -> Column:
    return _fold(kind, lambda total, fact: total + fact["value"] * fact["times"])


def _largest(kind: str) -> Column:
    return _fold(kind, lambda top, fact: F.greatest(top, fact["value"]))


def _distinct(kind: str) -> Column:
    """Facts of one kind already have distinct names."""
    return F.size(f"facts.{kind}").cast("bigint")


def _identifiers() -> Column:
    own = F.filter("facts.ident", lambda fact: ~fact["name"].isin(RESERVED))
    return F.size(own).cast("bigint")


def metric_columns() -> dict[str, Column]:
    """Each syntax metric as an expression over ``facts``."""
    return {
        "S": _times("stmt"),
        "P": _volume("def"),
        "UDF": _times("def"),
        "NBD": _largest("block"),
        "OPRND": _times("operand"),
        "OPRAT": _times("operator"),
        "UOPRND": _distinct("operand"),
        "UOPRAT": _distinct("operator"),
        "ID": _identifiers(),
        "I": _times("import"),
        "PO": _times("op"),
        "LCO": _largest("chain"),
        "CO": _times("chain"),
        "TCO": _volume("chain"),
        "LCI": _largest("index"),
        "CI": _times("index"),
        "TCI": _volume("index"),
        "V": _times("visual"),
        "TC": _times("train"),
    }


def metrics_of(facts: DataFrame, extra: Sequence[Column] = ()) -> DataFrame:
    """All metric columns of a ``cell_facts`` frame; keys and ``parse_error`` are kept."""
    computed = metric_columns()
    kept = [c for c in ("notebook_hash", "cell_id", "cell_pos") if c in facts.columns]
    return facts.select(
        *kept, *[computed.get(m, F.col(m)).alias(m) for m in METRICS], "parse_error", *extra
    )


def cell_metrics(cells: DataFrame, vocab: Vocabulary) -> DataFrame:
    """notebook_hash, cell_id, (cell_pos,) the 22 metrics and ``parse_error`` per code cell."""
    return metrics_of(cell_facts(cells, vocab))
