"""Texts of Arrow batches as byte arrays: whole batches are cut into words and hashed at once."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# The bytes that separate words.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

PIECE = 2 << 20
# Filters keep whole rows beside the arrays they make of a slice, so their slices are smaller.
FILTERED = 1 << 19


def give_back() -> None:
    """Return memory that was freed to the system, at the end of a partition.

    Workers outlive their stage; what they hold while idle counts against the executor.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # there with glibc
    if trim is not None:
        trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser: equal inputs stay equal, others spread over all bits."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


# A random-looking value per byte and one odd multiplier make the hash of a word.
BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64))
BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(BASE, -1, 1 << 64)


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64."""
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


class Texts:
    """The texts of a string column: ``data`` holds all bytes, text i is data[at[i]:at[i+1]].

    A null counts as the empty text.
    """

    def __init__(self, column: pa.Array):
        column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(
            column.type) else column
        column = column.fill_null(b"") if column.null_count else column
        bounds = np.frombuffer(column.buffers()[1], np.int64)[
            column.offset:column.offset + len(column) + 1]
        if len(column) == 0:
            bounds = np.zeros(1, np.int64)
        whole = column.buffers()[2]
        data = np.frombuffer(whole, np.uint8) if whole is not None else np.zeros(0, np.uint8)
        self.data = data[bounds[0]:bounds[-1]]
        self.at = bounds - bounds[0]

    def __len__(self) -> int:
        return len(self.at) - 1


class Words:
    """Where the words of ``texts`` begin and end; words of text i are at[i]..at[i+1]."""

    def __init__(self, texts: Texts, lower: bool = False):
        data = texts.data
        inside = ~IS_SPACE[data]
        opens = inside.copy()
        opens[1:] &= ~inside[:-1]
        first = texts.at[:-1][texts.at[:-1] < len(data)]
        opens[first] = inside[first]  # a text opens a word even if the one before ends in one
        closes = inside.copy()
        closes[:-1] &= ~inside[1:]
        last = texts.at[1:][texts.at[1:] > 0] - 1
        closes[last] = inside[last]
        self.start = np.flatnonzero(opens)
        self.end = np.flatnonzero(closes) + 1
        self.at = np.searchsorted(self.start, texts.at)
        self.data = LOWER[data] if lower else data

    def hashes(self) -> np.ndarray:
        """A 64-bit hash per word: the difference of two prefix sums, shifted to position 0."""
        n = len(self.data)
        if n == 0:
            return np.zeros(0, np.uint64)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTE_VALUE[self.data] * powers(BASE, n), out=sums[1:])
        back = powers(_BASE_INVERSE, n)
        return mix((sums[self.end] - sums[self.start]) * back[self.start]
                   + (self.end - self.start).astype(np.uint64))


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of ``width`` consecutive words from every position that has so many to its right."""
    n = max(0, len(words) - width + 1)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = mix(out ^ words[k:k + n]) + np.uint64(k + 1)
    return out


def pieces(batch: pa.RecordBatch, text: int = 1, limit: int = PIECE) -> Iterator[pa.RecordBatch]:
    """Slices of about ``limit`` bytes of text each; a longer text is a slice of its own."""
    at = Texts(batch.column(text)).at
    begin = 0
    while begin < batch.num_rows:
        end = int(np.searchsorted(at, at[begin] + limit, "right")) - 1
        end = min(max(end, begin + 1), batch.num_rows)
        yield batch.slice(begin, end - begin)
        begin = end


def slices(texts: list[str], limit: int = 1 << 20):
    """Runs of texts of about ``limit`` characters, which bounds the arrays made of them."""
    begin, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= limit or i + 1 == len(texts):
            yield begin, i + 1
            begin, size = i + 1, 0


def filter_texts(df: DataFrame, text: str, test: Callable[[list[str]], np.ndarray]) -> DataFrame:
    """The rows for whose texts ``test`` is true, a slice at a time; the columns of ``df``."""
    at = df.columns.index(text)

    def run(batches):
        for batch in batches:
            rows = batch.column(0)
            texts = rows.field(at).cast(pa.string())  # the text is sent once, inside its row
            for part in pieces(pa.RecordBatch.from_arrays([texts, rows], ["_", "row"]), 0, FILTERED):
                good = test([t or "" for t in part.column(0).to_pylist()])
                yield part.filter(pa.array(good, pa.bool_())).select(["row"])
        give_back()

    return df.select(F.struct(*(F.col(c) for c in df.columns)).alias("row")).mapInArrow(
        run, f"row {df.schema.simpleString()}").select("row.*")


def map_texts(df: DataFrame, key: str, text: str, schema: str,
              work: Callable[[pa.RecordBatch], Sequence | Iterator[Sequence]],
              extra: Sequence[str] = (), done: Callable[[], None] | None = None) -> DataFrame:
    """Apply ``work`` to slices of (key, text, *extra); it returns the arrays of ``schema``.

    Only the named columns are read, so others of any name do not matter. ``done`` is called at
    the end of a partition, to give back what was kept for it.
    """
    columns = [F.col(key), F.col(text).cast("string"), *(F.col(c) for c in extra)]
    source = df.select(*(c.alias(f"_{i}") for i, c in enumerate(columns)))
    fields = [part.split()[0] for part in schema.split(", ")]

    def run(batches):
        for batch in batches:
            for part in pieces(batch):
                yield pa.RecordBatch.from_arrays(
                    [a if isinstance(a, pa.Array) else pa.array(a) for a in work(part)], fields)
        if done:
            done()
        give_back()

    return source.mapInArrow(run, schema)


def held_out(key: str, of: int):
    """True for the rows whose crc32 of the key as text leaves no remainder; null: of ''."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % of == 0
