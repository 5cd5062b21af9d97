"""Benchmark decontamination: the q-gram lemma on diagonal bands, then banded alignment.

An item is found in a document if all of it aligns with a passage at an edit distance of at most
``RATE`` of its length. If it does, at least m - q + 1 - q * e of its q-grams (length m, e edits)
recur there on diagonals that lie at most e apart. So shared q-grams are counted in bands of
diagonals that overlap by e; bands that reach the bound are aligned, within the band, by dynamic
programming. Nothing that the bound allows is left out. q is 8, or less where 8 would leave a
short item no q-gram to share.

Texts are compared in lower case (per character) with runs of white space as one blank and none at
the ends. Items come in blocks of about ``BLOCK`` characters by hash, each broadcast in turn against
all documents. Edge cases: null or empty documents and items match nothing; repeated rows of either
table are each compared, and for each pair of rows the passage of the smallest distance is returned.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from notelake.llm.texts import filter_texts, map_texts, mix

RATE = 0.08
Q = 8
BLOCK = 1 << 20
FILTER_BITS = 22
NO_CHAR = 0x110000  # outside a text; equals no character of an item
BASE = 0xD1B54A32D192ED03


@lru_cache(maxsize=1)
def lower_table() -> np.ndarray:
    """Lower case of each code point, itself if that is not one character; blanks become 32."""
    out = np.arange(0x110001, dtype=np.uint32)
    for c in range(0x110000):
        if 0xD800 <= c < 0xE000:
            continue
        char = chr(c)
        low = char.lower()
        if len(low) == 1:
            out[c] = ord(low)
        if char.isspace():
            out[c] = 32
    return out


class Plain:
    """Comparable characters of some texts, with their places in the originals.

    ``chars`` holds all texts, each followed by ``NO_CHAR``; text i is at[i]..at[i+1]-1.
    """

    def __init__(self, texts: list[str]):
        raw = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le"), "<u4")
        bounds = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
        chars = lower_table()[raw]
        chars[bounds[1:] - 1] = NO_CHAR
        blank = chars == 32
        # The last blank of a run stays if characters of the same text stand on both sides.
        stay = ~blank
        stay[:-1] |= blank[:-1] & ~blank[1:] & (chars[1:] != NO_CHAR)
        first = bounds[:-1]
        seen = np.cumsum(~blank)
        begun = seen - np.repeat(seen[first] - ~blank[first], np.diff(bounds)) > 0
        stay &= begun
        self.place = np.flatnonzero(stay)
        self.chars = chars[self.place]
        self.at = np.searchsorted(self.place, bounds)
        self.first = first

    def original(self, position: int, text: int) -> int:
        return int(self.place[position] - self.first[text])


def gram_hashes(chars: np.ndarray, q: int) -> np.ndarray:
    """Hash of the q characters from each position, put together from powers of two."""
    n = len(chars) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    part, size, out, done = mix(chars.astype(np.uint64) + np.uint64(3)), 1, None, 0
    rest = q
    while True:
        if rest & 1:
            shifted = part[done:done + n]
            if out is None:
                out = shifted.copy()
            else:
                out = out * np.uint64(pow(BASE, size, 1 << 64)) + shifted
            done += size
        rest >>= 1
        if not rest:
            return mix(out)
        part = part[:len(part) - size] * np.uint64(pow(BASE, size, 1 << 64)) + part[size:]
        size *= 2


@dataclass
class Index:
    """q-grams of the items of one length q: sorted hashes and where each occurs."""

    q: int
    hashes: np.ndarray
    at: np.ndarray
    item: np.ndarray
    place: np.ndarray
    bits: np.ndarray

    def hits(self, chars: np.ndarray):
        """(position in chars, item, position in the item) of all shared q-grams."""
        grams = gram_hashes(chars, self.q)
        maybe = np.flatnonzero(self.bits[(grams >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
        found = np.searchsorted(self.hashes, grams[maybe])
        found = np.minimum(found, len(self.hashes) - 1)
        right = self.hashes[found] == grams[maybe]
        maybe, found = maybe[right], found[right]
        times = self.at[found + 1] - self.at[found]
        ends = np.cumsum(times)
        each = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - times, times)
        each += np.repeat(self.at[found], times)
        return np.repeat(maybe, times), self.item[each], self.place[each]


class Items:
    """One block of benchmark items, ready to be searched for."""

    def __init__(self, rows: list[tuple]):
        texts = [(i, t) for i, t in rows if t and not t.isspace()]
        plain = Plain([t for _, t in texts])
        self.ids = [i for i, _ in texts]
        self.chars = [plain.chars[a:b - 1].copy() for a, b in zip(plain.at[:-1], plain.at[1:])]
        sizes = np.array([len(c) for c in self.chars], np.int64)
        self.longest = int(sizes.max()) if len(sizes) else 0
        self.edits = (sizes * RATE).astype(np.int64)
        q = np.minimum(Q, sizes // (self.edits + 1))
        self.least = sizes - q + 1 - q * self.edits
        self.indexes = [self.index(int(n), np.flatnonzero(q == n)) for n in np.unique(q)]

    def index(self, q: int, items: np.ndarray) -> Index:
        grams = [gram_hashes(self.chars[i], q) for i in items]
        hashes = np.concatenate(grams)
        item = np.repeat(items, [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams])
        order = np.argsort(hashes, kind="stable")
        hashes, at = np.unique(hashes[order], return_index=True)
        bits = np.zeros(1 << FILTER_BITS, bool)
        bits[(hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
        return Index(q, hashes, np.append(at, len(order)), item[order], place[order], bits)

    def regions(self, chars: np.ndarray, at: np.ndarray):
        """(text, item, band) that hold enough shared q-grams."""
        for index in self.indexes:
            where, item, place = index.hits(chars)
            if not len(where):
                continue
            text = np.searchsorted(at, where, "right") - 1
            width = self.edits[item] + 1
            # Diagonals of a text start at minus the length of the item.
            diagonal = where - at[text] - place + self.longest
            band, over = np.divmod(diagonal, width)
            both = over < self.edits[item]  # also in the band before, which reaches this far
            text = np.concatenate([text, text[both]])
            item_of = np.concatenate([item, item[both]])
            band = np.concatenate([band, band[both] - 1])
            order = np.lexsort((band, item_of, text))
            text, item_of, band = text[order], item_of[order], band[order]
            new = np.ones(len(text), bool)
            new[1:] = (np.diff(text) != 0) | (np.diff(item_of) != 0) | (np.diff(band) != 0)
            begin = np.flatnonzero(new)
            count = np.diff(np.append(begin, len(text)))
            enough = begin[count >= self.least[item_of[begin]]]
            yield from zip(text[enough].tolist(), item_of[enough].tolist(), band[enough].tolist())

    def find(self, texts: list[str]):
        """(text, item, distance, start, end) of the best passage per text and item."""
        if not self.ids or not texts:
            return []
        plain, best, longest = Plain(texts), {}, self.longest
        for text, item, band in self.regions(plain.chars, plain.at):
            if best.get((text, item), (1,))[0] == 0:
                continue
            wanted, edits = self.chars[item], int(self.edits[item])
            low = band * (edits + 1) - longest
            own = plain.chars[plain.at[text]:plain.at[text + 1] - 1]
            distance, end = align(wanted, own, low, 2 * edits + 1)
            if distance <= edits and distance < best.get((text, item), (edits + 1,))[0]:
                back, begin = align(wanted[::-1], own[:end][::-1], -edits, 2 * edits + 1, True)
                first = plain.at[text] + end - begin
                best[text, item] = (distance, plain.original(first, text),
                                    plain.original(plain.at[text] + end - 1, text) + 1)
        return [(*key, *value) for key, value in sorted(best.items())]


def align(item: np.ndarray, text: np.ndarray, low: int, width: int, anchored: bool = False):
    """Smallest edit distance of ``item`` to a passage of ``text`` whose alignment stays on the
    diagonals low .. low + width - 1, and the end of that passage.

    ``anchored``: the passage has to begin at the start of ``text``.
    """
    steps = np.arange(width)
    begin, end = low, low + len(item) + width
    row = np.full(end - begin, NO_CHAR, np.int64)
    a, b = max(begin, 0), min(end, len(text))
    if a < b:
        row[a - begin:b - begin] = text[a:b]
    cost = np.abs(steps + low) if anchored else np.zeros(width, np.int64)
    far = len(item) + width
    for i, char in enumerate(item.tolist()):
        change = cost + (row[i:i + width] != char)
        change[:-1] = np.minimum(change[:-1], cost[1:] + 1)
        cost = np.minimum.accumulate(change - steps) + steps
    last = steps + low + len(item)
    cost = np.where((last >= 0) & (last <= len(text)), cost, far)
    k = int(cost.argmin())
    return int(cost[k]), int(last[k])


def blocks(benchmark: DataFrame, key: str, text: str) -> list[Items]:
    """Items in blocks of about BLOCK characters."""
    rows = benchmark.select(F.col(key).alias("i"), F.col(text).cast("string").alias("t")).where(
        F.col("t").isNotNull())
    size = rows.agg(F.sum(F.char_length("t"))).first()[0] or 0
    n = -(-size // BLOCK)
    return [Items([tuple(r) for r in rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == b)
                  .orderBy("i", "t").collect()]) for b in range(n)]


def find_items(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
               item: str = "item_id", item_text: str = "text") -> DataFrame:
    """(key, item, distance, start, end) of every item found; places in code points of the text."""
    kind = docs.schema[key].dataType.simpleString()
    item_kind = benchmark.schema[item].dataType.simpleString()
    schema = f"{key} {kind}, {item} {item_kind}, distance int, start bigint, end bigint"
    spark = docs.sparkSession

    def search(items: Items) -> DataFrame:
        sent = spark.sparkContext.broadcast(items)

        def work(batch: pa.RecordBatch):
            found = sent.value.find([t or "" for t in batch.column(1).to_pylist()])
            rows, which, *rest = zip(*found) if found else ((), (), (), (), ())
            ids = pa.array([sent.value.ids[i] for i in which], type_of[1])
            return (batch.column(0).take(pa.array(rows, pa.int64())), ids,
                    *(pa.array(r, t) for r, t in zip(rest, type_of[2:])))

        return map_texts(docs, key, text, schema, work)

    empty = spark.createDataFrame([], schema)
    type_of = to_arrow_schema(empty.schema).types
    found = [search(items) for items in blocks(benchmark, item, item_text)]
    return reduce(DataFrame.unionByName, found) if found else empty


def keep_clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
               item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no item is found."""
    def clean(items: Items):
        sent = docs.sparkSession.sparkContext.broadcast(items)

        def test(texts: list[str]) -> np.ndarray:
            out = np.ones(len(texts), bool)
            out[[row[0] for row in sent.value.find(texts)]] = False
            return out

        return test

    for items in blocks(benchmark, item, item_text):
        docs = filter_texts(docs, text, clean(items))
    return docs
