"""Quality rules: word rules, and how well a public vocabulary fits a text (its fertility).

Per document: characters per token, share of byte-fallback tokens and entropy of its tokens, under a
public sentencepiece vocabulary whose tokens never reach across a space. Rejection bands are robust
limits per language and octave of the token count (both set the scale of the three measures),
taken from all documents: median -/+ ``spread`` robust deviations.

Every text with a token has a band, however few are like it. Measures are taken as differences from
the median of their octave over all languages (rare octaves lean on the octaves beside them). Then
the middle and the deviation of a language lean on those of the corpus, and those of a language's
octave on the language: with n documents of its own, a middle counts n to ``OWN``, a deviation n to
``least``.

Edge cases: a null or empty text has no words and fails the word rules. A null language is a group
of its own. A language of less than about ``OWN`` documents is judged mostly by the corpus. The
median deviation is at least ``floor`` of each measure, so a group of copies does not reject texts
that differ from the copies by a trace. Repeated rows count as often as they are there.
"""

from __future__ import annotations

from collections import Counter
from functools import lru_cache
from math import log2

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, functions as F

from notelake.llm.components import stored
from notelake.llm.texts import (
    FILTERED, SPACES, Texts, Words, give_back, map_texts, pieces, window_hashes,
)
from notelake.session import fresh_path

# The signs that count as symbols, and the thresholds of the word rules.
SYMBOLS = b"#*$%&|<>"
LEAST_WORDS, REPEAT_PERCENT, WINDOW = 10, 20, 5

IS_SYMBOL = np.zeros(256, bool)
IS_SYMBOL[list(SYMBOLS)] = True

CACHE = 150_000
# So many bands are broadcast (some 50 bytes each).
FEW_BANDS = 20_000
# The smallest deviation that a band assumes, in units of its measure.
FLOOR = {"chars_per_token": 0.03, "byte_share": 0.01, "entropy": 0.1}
# So many documents of its own weigh as much as the wider group in the middle of a band.
OWN = 4
MEASURES = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
            "n_repeat_words bigint, base_failed boolean, n_tokens bigint, chars_per_token double, "
            "byte_share double, entropy double")


def sums_between(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags)])
    return sums[at[1:]] - sums[at[:-1]]


def repeat_words(hashes: np.ndarray, width: int = WINDOW) -> int:
    """Words inside windows of ``width`` words that are found twice or more."""
    windows = window_hashes(hashes, width)
    if len(windows) < 2:
        return 0
    order = np.sort(windows)
    if not (twice := order[1:][order[1:] == order[:-1]]).size:
        return 0
    edges = np.zeros(len(hashes) + 1, np.int64)
    hit = np.flatnonzero(np.isin(windows, twice))
    np.add.at(edges, hit, 1)
    np.add.at(edges, hit + width, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def dup_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split("\n") if line.strip(" \t\n\x0b\x0c\r")]
    return len(lines) - len(set(lines))


class Fertility:
    """Token statistics of words under a sentencepiece file."""

    def __init__(self, path: str):
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.pieces.get_piece_size()
        self.is_byte = {i for i in range(n) if self.pieces.is_byte(i)}
        self.known: dict[bytes, list[int]] = {}

    def measure(self, words: list[bytes], chars: int) -> tuple[int, float, float, float]:
        known, ids = self.known, []
        for word, times in Counter(words).items():
            if (found := known.get(word)) is None:
                if len(known) >= CACHE:
                    known.clear()
                found = self.pieces.encode(word.decode())
                if len(word) < 64:
                    known[word] = found
            ids += found * times
        n = len(ids)
        if not n:
            return 0, 0.0, 0.0, 0.0
        counts = Counter(ids)
        entropy = log2(n) - sum(c * log2(c) for c in counts.values() if c > 1) / n
        in_bytes = sum(c for i, c in counts.items() if i in self.is_byte)
        return n, chars / n, in_bytes / n, entropy


@lru_cache(maxsize=1)
def fertility(path: str) -> Fertility:
    return Fertility(path)


def measure_texts(batch: pa.RecordBatch, vocab: str) -> list:
    texts = Texts(batch.column(1))
    words = Words(texts)
    n_words = np.diff(words.at)
    # Code points: bytes that do not continue one.
    leads = (texts.data & 0xC0) != 0x80
    in_words = sums_between(leads & ~np.isin(texts.data, SPACES), texts.at)
    symbols = sums_between(IS_SYMBOL[texts.data], texts.at)
    hashes = words.hashes()
    repeats = np.array([repeat_words(hashes[a:b]) for a, b in zip(words.at[:-1], words.at[1:])],
                       np.int64)
    strings = [t or "" for t in batch.column(1).to_pylist()]
    lines = np.array([dup_lines(t) for t in strings], np.int64)
    model = fertility(vocab)
    found = [model.measure(t.encode().split(), int(c)) for t, c in zip(strings, in_words)]
    failed = (n_words < LEAST_WORDS) | (100 * repeats > REPEAT_PERCENT * n_words)
    tokens, *rest = (np.array(column) for column in zip(*found)) if found else ([], [], [], [])
    return [n_words.astype(np.int64), in_words, symbols, lines, repeats, failed,
            np.asarray(tokens, np.int64), *(np.asarray(r, float) for r in rest)]


def octave_middles(usable: DataFrame) -> list[tuple]:
    """(octave, middle of each measure) over all languages: a row per octave, at most 64."""
    rows = usable.groupBy("octave").agg(
        F.count(F.lit(1)), *(F.percentile_approx(m, 0.5, 1000) for m in FLOOR)).orderBy("octave")
    found = np.array([list(row) for row in rows.collect()], float).reshape(-1, 2 + len(FLOOR))
    octaves, n = found[:, 0], found[:, 1]
    out = [octaves]
    for middle in found[:, 2:].T:
        others = np.array([
            np.interp(octaves[i], np.delete(octaves, i), np.delete(middle, i))
            if len(octaves) > 1 else middle[i] for i in range(len(octaves))])
        out.append((n * middle + OWN * others) / (n + OWN))
    return [(int(row[0]), *map(float, row[1:])) for row in zip(*out)]


def bands(measured: DataFrame, spread: float, least: int) -> DataFrame:
    """Low and high limits per (group, octave): one row for each, combined before the shuffle."""
    names = list(FLOOR)
    usable = measured.where("n_tokens > 0").select("group", "octave", *names)
    middles = measured.sparkSession.createDataFrame(
        octave_middles(usable), "octave bigint, " + ", ".join(f"{m}_at double" for m in names))
    rest = usable.join(F.broadcast(middles), "octave").select(
        "group", "octave", *((F.col(m) - F.col(f"{m}_at")).alias(m) for m in names))

    def level(rows: DataFrame, *by: str) -> DataFrame:
        quartiles = rows.groupBy(*by).agg(
            F.count(F.lit(1)).alias("n"),
            *(F.percentile_approx(m, [0.25, 0.5, 0.75], 1000).alias(m) for m in names))
        # The quartiles of a normal distribution lie 0.6745 deviations from its median. Rejected
        # texts widen one side, so the narrower side measures the deviation.
        return quartiles.select(
            *by, "n", *(F.col(m)[1].alias(f"{m}_middle") for m in names),
            *((F.least(F.col(m)[1] - F.col(m)[0], F.col(m)[2] - F.col(m)[1]) / 0.6745)
              .alias(f"{m}_side") for m in names))

    def leaning(own: DataFrame, by: list[str], wide: dict[str, Column]) -> list[Column]:
        def mixed(name: str, weight: int) -> Column:
            n = own["n"]
            return ((n * own[name] + weight * wide[name]) / (n + weight)).alias(name)

        return [*(own[c] for c in by), *(mixed(f"{m}_middle", OWN) for m in names),
                *(mixed(f"{m}_side", least) for m in names)]

    parts = [f"{m}_{part}" for m in names for part in ("middle", "side")]
    corpus = level(rest).first()
    languages = level(rest, "group")
    languages = languages.select(leaning(
        languages, ["group"], {p: F.lit(corpus[p] or 0.0) for p in parts}))
    wide = languages.select("group", *(F.col(p).alias(f"wide_{p}") for p in parts))
    both = level(rest, "group", "octave").join(wide, "group")
    both = both.select(leaning(both, ["group", "octave"], {p: both[f"wide_{p}"] for p in parts}))
    both = both.join(F.broadcast(middles), "octave")

    def limit(name: str, sign: int) -> Column:
        side = F.greatest(F.col(f"{name}_side"), F.lit(FLOOR[name]))
        return F.col(f"{name}_at") + F.col(f"{name}_middle") + sign * spread * side

    return both.select(
        "group", "octave", limit("chars_per_token", -1).alias("least_chars"),
        limit("byte_share", 1).alias("most_bytes"), limit("entropy", -1).alias("least_entropy"))


def measure(docs: DataFrame, vocab: str, key: str = "doc_id", text: str = "text",
            lang: str = "lang") -> DataFrame:
    """(key, the measures, group, octave) of every document."""

    def work(batch: pa.RecordBatch):
        return [batch.column(0), *measure_texts(batch, vocab), batch.column(2)]

    kind = docs.schema[key].dataType.simpleString()
    measured = map_texts(docs, key, text, f"{key} {kind}, {MEASURES}, group string", work, [lang],
                         done=lambda: fertility(vocab).known.clear())
    return with_octave(measured.withColumn("group", F.coalesce("group", F.lit(""))))


def with_octave(measured: DataFrame) -> DataFrame:
    return measured.withColumn("octave", F.floor(F.log2(F.greatest("n_tokens", F.lit(1)))))


def judge(measured: DataFrame, limits: DataFrame) -> DataFrame:
    """Add ``kept``. The limits, a few rows per language, are broadcast if they are few indeed.

    Only a text without a token has none; the word rules reject it.
    """
    limits = stored(limits, "bands")
    limits = F.broadcast(limits) if limits.count() <= FEW_BANDS else limits
    inside = (
        (F.col("chars_per_token") >= F.col("least_chars"))
        & (F.col("byte_share") <= F.col("most_bytes"))
        & (F.col("entropy") >= F.col("least_entropy"))
    )
    return measured.join(limits, ["group", "octave"], "left").withColumn(
        "kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(True)))


def assess(docs: DataFrame, vocab: str, key: str = "doc_id", text: str = "text",
           lang: str = "lang", spread: float = 4.5, least: int = 50) -> DataFrame:
    """(key, word measures, base_failed, fertility measures, kept) of every document.

    The measures are written to the shared folder once; the bands and the verdicts read them.
    """
    spark, path = docs.sparkSession, fresh_path(docs.sparkSession, "fertility")
    measure(docs, vocab, key, text, lang).write.parquet(path)
    measured = spark.read.parquet(path)
    return judge(measured, bands(measured, spread, least)).select(
        key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "n_tokens", "chars_per_token", "byte_share", "entropy", "kept")


def keep_good(docs: DataFrame, vocab: str, text: str = "text", lang: str = "lang",
              spread: float = 4.5, least: int = 50) -> DataFrame:
    """The rows of ``docs`` that pass, with the columns of ``docs``.

    Rows and measures are written together, so nothing is joined by a key that may be repeated.
    """
    spark, path = docs.sparkSession, fresh_path(docs.sparkSession, "measured")
    names = [f.split()[0] for f in MEASURES.split(", ")]
    schema = docs.schema
    at = schema.fieldNames()
    columns = [F.col(text).cast("string").alias("_text"), F.col(lang).alias("_lang"),
               F.struct(*(F.col(c) for c in at)).alias("row")]
    row = schema.simpleString()

    def run(batches):
        for batch in batches:
            for part in pieces(batch, 0, FILTERED):
                first = pa.RecordBatch.from_arrays([part.column(0)] * 2, ["a", "b"])
                yield pa.RecordBatch.from_arrays(
                    [part.column(2), part.column(1)]
                    + [a if isinstance(a, pa.Array) else pa.array(a)
                       for a in measure_texts(first, vocab)],
                    ["row", "group", *names])
        fertility(vocab).known.clear()
        give_back()

    measured = docs.select(*columns).mapInArrow(run, f"row {row}, group string, {MEASURES}")
    measured.withColumn("group", F.coalesce("group", F.lit(""))).write.parquet(path)
    measured = with_octave(spark.read.parquet(path))
    kept = judge(measured, bands(measured.drop("row"), spread, least)).where("kept")
    return kept.select("row.*")
