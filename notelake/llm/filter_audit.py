"""Filter interaction audit: what each filter of a chain removes, in every order of the filters.

A document is reduced to its part and the set of filters it fails. Filters applied so far are a state of
the lattice of subsets; applying one more is an edge, which removes the documents that fail it and
none before. Counting paths forward (orders that reach a state) and backward (orders that leave it for the
full set) gives the number of orders through an edge, so its removals times that number, summed over
the edges of a filter, are the filter's removals over all orders: its Shapley value times the number of
orders. The steps of one order are the edges of its path, read from the same table. No order is run
over the documents: one pass over the texts, then at most 2**filters rows per part.

Edge cases: a null text is empty (and so fails A and, from the second empty one on, E), a null language
is the part "". Every row is a document. Identity is decided by the id: a row without one, or a repeat
of the smallest, is not a later copy. A document is good or toxic if any of its labels says so. An empty
table has no parts and gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window, functions as F

from notelake.llm.components import stored

LETTERS = "ABCDE"
# Orders are listed, so their number has to stay small: 8 filters have 40,320.
MOST_FILTERS = 8
WORD = r"[^\x20\x09-\x0D]+"


def path_counts(n: int) -> tuple[list[int], list[int]]:
    """Per state (a bit per filter): orders that reach it from nothing, and from it the full set."""
    forward, backward = [1] + [0] * (2**n - 1), [0] * (2**n - 1) + [1]
    for state in range(1, 2**n):
        forward[state] = sum(forward[state ^ 1 << f] for f in range(n) if state >> f & 1)
    for state in reversed(range(2**n - 1)):
        backward[state] = sum(backward[state | 1 << f] for f in range(n) if not state >> f & 1)
    return forward, backward


def _removing_edges(n: int) -> list[tuple[int, int, int]]:
    """(mask, state, filter): the edges that remove a document with the failures of ``mask``."""
    return [(mask, state, f) for mask in range(1, 2**n) for state in range(2**n)
            if not state & mask for f in range(n) if mask >> f & 1]


def _steps(letters: str) -> list[tuple[str, int, int, int]]:
    """(filter_order, step, state, filter) of every order."""
    bit = {letter: f for f, letter in enumerate(letters)}
    return [("".join(order), at + 1, sum(1 << bit[x] for x in order[:at]), bit[order[at]])
            for order in permutations(letters) for at in range(len(order))]


def audit(failed: DataFrame, letters: str) -> DataFrame:
    """One row per part, order and step, from (part, mask, n, good, toxic) with any number of rows.

    Bit f of ``mask`` says that filter f fails; n, good and toxic count documents.
    """
    spark, n = failed.sparkSession, len(letters)
    if not 0 < n <= MOST_FILTERS:
        raise ValueError(f"between 1 and {MOST_FILTERS} filters")
    counts = ("n", "good", "toxic")
    cells = failed.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in counts])
    totals = cells.groupBy("part").agg(F.sum("n").alias("total"))
    removing = spark.createDataFrame(_removing_edges(n), "mask int, state int, filter int")
    removals = cells.join(F.broadcast(removing), "mask").groupBy("part", "state", "filter").agg(
        *[F.sum(c).alias(c) for c in counts])
    forward, backward = path_counts(n)
    lattice = F.array(*[
        F.struct(F.lit(s).alias("state"), F.lit(f).alias("filter"),
                 F.lit(forward[s] * backward[s | 1 << f]).cast("bigint").alias("paths"))
        for s in range(2**n) for f in range(n) if not s >> f & 1])
    edges = totals.select("part", "total", F.inline(lattice)).join(
        removals, ["part", "state", "filter"], "left").fillna(0, counts)
    of_filter = Window.partitionBy("part", "filter")
    others = F.lit(2**n - 1).bitwiseXOR(F.call_function("shiftleft", F.lit(1), F.col("filter")))
    edges = edges.withColumns({
        "shapley": F.sum(F.col("n") * F.col("paths")).over(of_filter),
        "failing": F.max(F.when(F.col("state") == 0, F.col("n"))).over(of_filter),
        "unique_fails": F.max(F.when(F.col("state") == others, F.col("n"))).over(of_filter)})
    steps = F.broadcast(spark.createDataFrame(
        _steps(letters), "filter_order string, step int, state int, filter int"))
    so_far = Window.partitionBy("part", "filter_order").orderBy("step").rowsBetween(
        Window.unboundedPreceding, 0)
    return edges.join(steps, ["state", "filter"]).select(
        "part", "filter_order", "step", (F.col("total") - F.sum("n").over(so_far)).alias("kept"),
        F.col("n").alias("removed"), (F.col("failing") - F.col("n")).alias("redundant"),
        "unique_fails", F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"),
        "shapley")


def mask_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a.bitwiseOR(b), [
        F.when(c, F.lit(1 << f)).otherwise(F.lit(0)) for f, c in enumerate(conditions)])


def text_failures(docs: DataFrame, key: str = "doc_id", text: str = "text",
                  part: str = "lang") -> DataFrame:
    """(doc_id, part, digest, mask) with the failures that a text shows by itself (A to D)."""
    rows = docs.select(
        F.col(key).alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    words = rows.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    sizes = words.select(
        "doc_id", "part", F.unhex(F.md5("text")).alias("digest"), F.size("words").alias("n"),
        F.size(F.array_distinct("words")).alias("distinct"),
        F.regexp_count("text", F.lit("[A-Z]")).alias("capitals"),
        F.char_length("text").alias("chars"), F.rlike("text", F.lit(r"[#$%&*|]")).alias("symbols"))
    long = lambda name: F.col(name).cast("bigint")
    return sizes.select("doc_id", "part", "digest", mask_of([
        F.col("n") < 100, 100 * long("distinct") < 80 * long("n"),
        100 * long("capitals") > 10 * long("chars"), F.col("symbols")]).alias("mask"))


def failures(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
             part: str = "lang") -> DataFrame:
    """(part, mask, n, good, toxic) of the five filters; E is failed by later copies of a text.

    The texts are read once; what is shuffled is an id, 16 bytes and a mask per document. Only the
    first document of a text meets its row of the join, so a text with a third of all documents is no
    group of it, and rows are counted per id before they meet their labels.
    """
    found = stored(text_failures(docs, key, text, part), "failures")
    first = found.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn(
        "first", F.lit(True))
    later = F.col("first").isNull() & F.col("doc_id").isNotNull()
    failed = found.join(first, ["digest", "doc_id"], "left").select(
        "doc_id", "part", F.col("mask").bitwiseOR(F.when(later, 16).otherwise(0)).alias("mask"))
    per_id = failed.groupBy("doc_id", "part", "mask").agg(F.count(F.lit(1)).alias("n"))

    def says(name: str) -> Column:
        return F.max(F.when(F.col(name) == 1, 1).otherwise(0)).alias(name)

    known = labels.select(F.col(key).alias("doc_id"), "quality", "toxic").where(
        "doc_id is not null").groupBy("doc_id").agg(says("quality"), says("toxic"))
    counted = lambda name, alias: F.sum(
        F.col("n") * F.coalesce(F.col(name), F.lit(0))).alias(alias)
    return per_id.join(known, "doc_id", "left").groupBy("part", "mask").agg(
        F.sum("n").alias("n"), counted("quality", "good"), counted("toxic", "toxic"))


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return audit(failures(docs, labels), LETTERS)
