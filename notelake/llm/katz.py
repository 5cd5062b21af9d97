"""Language-model scores: a bigram model with Katz backoff and Good-Turing discounts.

Tokens are the lower-cased words and one end per text; the history of the first is a start mark. With
c the training counts, P(w|h) = d(c(hw)) c(hw) / c(h) if hw was seen, else alpha(h) P(w), and P(w) is
the discounted share of w. Counts r up to K are discounted by Good-Turing, r* = (r+1) N(r+1) / N(r),
larger ones by HALF; where the counts of counts are too ragged for a ratio below 1, HALF stands in.
What the discount of P(w) leaves is the probability of an unknown word (one class, as in the base
score). alpha(h) is exactly what makes P(.|h) sum to 1; a history never seen has alpha 1.

How it runs: a first pass counts words (combined in each task, then by Spark). A second pass stores the
documents in slices of ``TOKENS`` tokens, as places in the list of the slice's words. A slice sends each
of its bigrams once, with its count, to the partition of the table that its word belongs to; words of
``HEAVY`` tokens and more are spread by bigram instead, and bigrams of as many, counted in a pass of
their own, are not sent: both are broadcast with their counts, at most one in ``HEAVY`` tokens each. So
no word or bigram fills a partition, however common, and what is sent grows with the bigrams of slices,
not with the documents or partitions that hold them. A partition adds up c(hw) and c(w) and answers each
slice with the counts alone, in the order in which it asked. Sums per history go on to partitions by
history, together with the histories of bigrams never seen, and those answer with alpha; alphas of heavy
histories, again one in ``HEAVY`` tokens, go to all. A slice meets its answers in a cogroup and scores
its documents there.

Edge cases: a null or empty text is the end alone. Rows without an id are held out (the crc32 of the
empty text). With no training rows every probability is 1. Repeated rows count as often as they are
there. Words are told apart by 56-bit hashes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from notelake.llm.components import stored
from notelake.llm.texts import Texts, Words, give_back, held_out, mix, pieces

K = 5
HALF = 0.5
START, END = 1, 2  # no hash of a word is as small, but by chance
HEAVY = 50_000  # tokens, learned from or not, from which a word or bigram is dealt out
FLUSH = 800_000  # tokens that a task gathers before it sends them on
TOKENS = 2_000_000  # tokens per slice of documents, about
BUCKET = 2_000_000  # tokens per partition of the table, about


class Tokens:
    """Tokens of a slice of texts: word ``w``, history ``h``, text ``d``; ``content`` per text."""

    def __init__(self, column: pa.Array):
        words = Words(Texts(column), lower=True)
        n, texts = len(words.start), len(words.at) - 1
        self.sizes = np.diff(words.at) + 1
        ends = np.cumsum(self.sizes) - 1
        self.d = np.repeat(np.arange(texts), self.sizes)
        self.w = np.full(n + texts, END, np.int64)
        inside = np.ones(n + texts, bool)
        inside[ends] = False
        self.w[inside] = np.maximum((words.hashes() >> np.uint64(8)).astype(np.int64), 3)
        self.h = np.empty_like(self.w)
        self.h[1:] = self.w[:-1]
        first = ends - self.sizes + 1
        self.h[first] = START
        place = (np.arange(n + texts) - first[self.d]).astype(np.uint64)
        mixed = mix(mix(self.w.astype(np.uint64)) + place)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])
        self.content = mix(sums[ends + 1] - sums[first]).astype(np.int64)


def discounts(counts: dict[int, int]) -> list[float]:
    """d(1)..d(K) from the counts of counts."""
    out = []
    for r in range(1, K + 1):
        here, after = counts.get(r, 0), counts.get(r + 1, 0)
        ratio = (r + 1) * after / (r * here) if here else 0.0
        out.append(ratio if 0 < ratio < 1 else (r - HALF) / r)
    return out


@dataclass
class Words1:
    """What is known of single words: N, V, tokens with those held out, texts learned from, P of an
    unknown word, discounts, the heavy words (sorted) with their counts, and the heavy bigrams
    (sorted by key) with theirs."""

    total: int
    tokens: int
    types: int
    texts: int
    unknown: float
    discount: list[float]
    heavy: np.ndarray
    heavy_count: np.ndarray
    pairs: tuple[np.ndarray, ...] = (np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3)

    def discounted(self, count: np.ndarray) -> np.ndarray:
        """d(c) c for positive counts."""
        small = np.concatenate([[0.0], np.arange(1, K + 1) * np.array(self.discount)])
        return np.where(count > K, count - HALF, small[np.minimum(count, K)])

    def probability(self, count: np.ndarray) -> np.ndarray:
        return np.where(count > 0, self.discounted(count) / max(self.total, 1), self.unknown)

    def count_heavy(self, words: np.ndarray) -> np.ndarray:
        """Count of heavy words, -1 for others."""
        if not len(self.heavy):
            return np.full(len(words), -1, np.int64)
        at = np.minimum(np.searchsorted(self.heavy, words), len(self.heavy) - 1)
        return np.where(self.heavy[at] == words, self.heavy_count[at], -1)

    def heavy_history(self, h: np.ndarray) -> np.ndarray:
        """Whether histories are heavy; a start is as heavy as END."""
        return self.count_heavy(np.where(h == START, END, h)) >= 0

    def count_pairs(self, w: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Count of heavy bigrams, -1 for others."""
        keys, ws, hs, counts = self.pairs
        if not len(keys):
            return np.full(len(w), -1, np.int64)
        at = np.minimum(np.searchsorted(keys, pair_key(w, h)), len(keys) - 1)
        return np.where((ws[at] == w) & (hs[at] == h), counts[at], -1)


def pair_key(w: np.ndarray, h: np.ndarray) -> np.ndarray:
    return mix(mix(w.astype(np.uint64)) + h.astype(np.uint64))


def combine(keys: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, ...]:
    unique, where = np.unique(keys, return_inverse=True)
    return unique, *(np.bincount(where, c, len(unique)).astype(np.int64) for c in counts)


def source(docs: DataFrame, key: str, text: str, of: int) -> DataFrame:
    return docs.select((~held_out(key, of)).alias("train"), F.col(text).cast("string").alias("t"))


def count_tokens(docs: DataFrame, key: str, text: str, of: int, named) -> DataFrame:
    """(key, n, m): how often the keys that ``named`` gives to tokens are there, in training rows and
    in all."""

    def batch_of(columns):
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["key", "n", "m"])

    def run(batches):
        held: list = []
        size = 0
        for batch in batches:
            for part in pieces(batch):
                tokens = Tokens(part.column(1))
                train = np.asarray(part.column(0).to_numpy(zero_copy_only=False), bool)
                at, keys = named(tokens)
                held.append(combine(keys, train[tokens.d[at]], np.ones(len(keys), bool)))
                size += len(held[-1][0])
                if size > FLUSH:
                    held = [combine(*map(np.concatenate, zip(*held)))]
                    size = len(held[0][0])
                    if size > FLUSH // 2:
                        yield batch_of(held[0])
                        held, size = [], 0
        if held:
            yield batch_of(combine(*map(np.concatenate, zip(*held))))

    counted = source(docs, key, text, of).mapInArrow(run, "key bigint, n bigint, m bigint")
    return counted.groupBy("key").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))


def count_words(docs: DataFrame, key: str, text: str, of: int) -> DataFrame:
    """(w, n, m): the count of every word in training and in all rows, END included."""
    return count_tokens(docs, key, text, of, lambda t: (slice(None), t.w)).withColumnRenamed(
        "key", "w")


def heavy_pairs(docs: DataFrame, words: Words1, key: str, text: str, of: int) -> tuple:
    """The bigrams of ``HEAVY`` tokens and more, in the form of ``Words1.pairs``.

    Both words of such a bigram are heavy, so no other bigram is counted; a start is as heavy as END.
    """
    heavy = words.heavy
    if not len(heavy):
        return words.pairs
    sent = docs.sparkSession.sparkContext.broadcast(heavy)

    def named(tokens):
        heavy = sent.value
        h = np.where(tokens.h == START, END, tokens.h)
        i, j = (np.minimum(np.searchsorted(heavy, x), len(heavy) - 1) for x in (tokens.w, h))
        at = np.flatnonzero((heavy[i] == tokens.w) & (heavy[j] == h))
        return at, i[at] * len(heavy) + j[at]

    rows = count_tokens(docs, key, text, of, named).where(F.col("m") >= HEAVY).collect()
    code = np.array([r["key"] for r in rows], np.int64)
    w, h = heavy[code // len(heavy)], heavy[code % len(heavy)]
    h = np.where(h == END, START, h)  # no history is END
    keys = pair_key(w, h)
    order = np.argsort(keys)
    counts = np.array([r["n"] for r in rows], np.int64)
    return tuple(x[order] for x in (keys, w, h, counts))


def learn_words(counts: DataFrame) -> Words1:
    """Sums over the table of words; of its rows only the heavy ones are fetched."""
    first = counts.agg(
        F.sum("n"), F.count(F.when(F.col("n") > 0, 1)), F.sum(F.when(F.col("n") > K, F.col("n") - HALF)),
        F.sum(F.when(F.col("w") == END, F.col("n"))), F.sum("m")).first()
    total, types, above, texts, tokens = (x or 0 for x in first)
    ragged = {r["n"]: r["count"] for r in counts.where(F.col("n").between(1, K + 1))
              .groupBy("n").count().collect()}
    discount = discounts(ragged)
    kept = above + sum(r * discount[r - 1] * ragged.get(r, 0) for r in range(1, K + 1))
    heavy = counts.where(F.col("m") >= HEAVY).orderBy("w").collect()
    return Words1(total, tokens, types, texts, 1 - kept / total if total else 1.0, discount,
                  np.array([r["w"] for r in heavy], np.int64),
                  np.array([r["n"] for r in heavy], np.int64))


def planes(values: np.ndarray, width: int) -> bytes:
    """The lowest ``width`` bytes of each value, all first bytes before all second ones: sorted and
    small numbers then compress well."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unplanes(data: bytes, width: int) -> np.ndarray:
    """Of up to four bytes: 32-bit integers, which saves memory."""
    flat = np.frombuffer(data, np.uint8).reshape(width, -1)
    out = np.zeros((flat.shape[1], 4 if width <= 4 else 8), np.uint8)
    out[:, :width] = flat.T
    return out.reshape(-1).view("<i4" if width <= 4 else "<i8")


# A slice of documents: its distinct words (sorted), the place of each token among them, the tokens,
# and which texts are learned from.
SLICE = "slice bigint, words binary, places binary, sizes binary, train binary"
# Words as the gaps between sorted ones, each with its number of histories; per bigram its history and
# how often documents learned from hold it.
SENT = "bucket int, slice bigint, gaps binary, runs binary, h binary, doc binary"


def squeeze(values: np.ndarray, width: int) -> bytes:
    """``planes`` with entropy coding, for what is large; the number of values comes first."""
    return len(values).to_bytes(8, "little") + pa.compress(
        planes(values, width), "zstd", asbytes=True)


def unsqueeze(data: bytes, width: int) -> np.ndarray:
    size = int.from_bytes(data[:8], "little") * width
    return unplanes(pa.decompress(data[8:], size, "zstd", asbytes=True), width)


def slices(docs: DataFrame, key: str, text: str, of: int) -> DataFrame:
    """Documents as rows of SLICE, with their keys (``ids``), in runs of about ``TOKENS`` tokens."""
    kind = docs.schema[key].dataType.simpleString()
    names = [part.split()[0] for part in SLICE.split(", ")] + ["ids"]
    limit = TOKENS

    def row(held, number):
        w, sizes, train = (np.concatenate(x) for x in list(zip(*held))[:3])
        ids = pa.concat_arrays([x[3] for x in held])
        held.clear()
        own, place = np.unique(w, return_inverse=True)
        name = (TaskContext.get().partitionId() << 32) + number
        values = (name, squeeze(np.diff(own, prepend=0), 7), squeeze(place, 4), squeeze(sizes, 4),
                  squeeze(train, 1))
        kinds = [pa.int64()] + [pa.binary()] * 4
        whole = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
        return pa.RecordBatch.from_arrays(
            [*(pa.array([v], k) for v, k in zip(values, kinds)), whole], names)

    def run(batches):
        held, size, number = [], 0, 0
        for batch in batches:
            for part in pieces(batch):
                tokens = Tokens(part.column(1))
                train = np.asarray(part.column(0).to_numpy(zero_copy_only=False), bool)
                held.append((tokens.w, tokens.sizes, train, part.column(2)))
                size += len(tokens.w)
                if size > limit:
                    yield row(held, number)  # which empties the list
                    size, number = 0, number + 1
        if held:
            yield row(held, number)
        give_back()

    return docs.select((~held_out(key, of)).alias("train"), F.col(text).cast("string").alias("t"),
                       F.col(key).alias("id")).mapInArrow(run, f"{SLICE}, ids array<{kind}>")


class Slice:
    """A row of SLICE: documents ``d`` and words ``at`` of tokens, and its distinct bigrams: words
    ``of`` and histories ``before`` (places in ``words``, -1 for the start), in ``pair`` for each token.

    Bigrams in the broadcast list have their count in ``known``; ``sent`` are the others in the order
    in which they go to their buckets.
    """

    def __init__(self, row: dict, words: Words1, buckets: int):
        self.words = np.cumsum(unsqueeze(row["words"], 7))
        self.at = unsqueeze(row["places"], 4)
        self.sizes = unsqueeze(row["sizes"], 4).astype(np.int64)
        self.train = unsqueeze(row["train"], 1) > 0
        self.d = np.repeat(np.arange(len(self.sizes), dtype=np.int32), self.sizes)
        code = self.at.astype(np.int64) * (len(self.words) + 1)
        code[1:] += self.at[:-1] + 1
        first = np.cumsum(self.sizes) - self.sizes
        code[first] = self.at[first].astype(np.int64) * (len(self.words) + 1)
        code, pair = np.unique(code, return_inverse=True)
        self.pair = pair.astype(np.int32)
        self.of, self.before = np.divmod(code, len(self.words) + 1)
        self.before -= 1
        del code, pair
        self.w = self.words[self.of]
        self.h = np.where(self.before < 0, START, self.words[self.before])
        self.known = words.count_pairs(self.w, self.h)
        place = mix(np.where(words.count_heavy(self.w) >= 0, self.w * 31 + self.h, self.w)
                    .astype(np.uint64))
        bucket = (place % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable").astype(np.int32)
        self.sent = order[self.known[order] < 0]
        self.bucket = bucket[self.sent]

    def parts(self):
        """(begin, end) in ``sent`` of each bucket."""
        cut = np.flatnonzero(np.append(True, np.diff(self.bucket) != 0)) if len(self.sent) else []
        return zip(cut, [*cut[1:], len(self.sent)])


def deal(held: DataFrame, words: Words1, buckets: int) -> DataFrame:
    """Rows of SENT: the bigrams of every slice, one row per bucket."""
    sent = held.sparkSession.sparkContext.broadcast(words)
    names = [part.split()[0] for part in SENT.split(", ")]
    kinds = [pa.int32(), pa.int64()] + [pa.binary()] * 4

    def rows(row):
        own = Slice(row, sent.value, buckets)
        n = np.bincount(own.pair, own.train[own.d], len(own.w)).astype(np.int64)[own.sent]
        w, h = own.w[own.sent], own.h[own.sent]
        for a, b in own.parts():
            new = np.flatnonzero(np.diff(w[a:b], prepend=-1))
            yield (int(own.bucket[a]), row["slice"], planes(np.diff(w[a:b][new], prepend=0), 7),
                   planes(np.diff(new, append=b - a), 4), planes(h[a:b], 7), planes(n[a:b], 4))

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                columns = list(zip(*rows(batch.slice(i, 1).to_pylist()[0])))
                if columns:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(columns, kinds)], names)
        give_back()

    return held.drop("ids").mapInArrow(run, SENT)


def bigrams(docs: DataFrame, words: Words1, buckets: int, key: str, text: str, of: int) -> DataFrame:
    """Bigrams of documents, in rows of SENT."""
    return deal(slices(docs, key, text, of), words, buckets)


COUNTS = [f"n{r}" for r in range(1, K + 1)]
# kind 0: what a slice asked (key: slice): counts of its bigrams (a) and of their words (b), as sent.
# 1: sums per history (key: bucket of histories): histories, sums of P(w) (b) and counts (c).
# 2: histories (a) before unseen bigrams, with their slices (b) (key: bucket of histories).
# 3: counts of counts (n1..n5, and of K + 1 in ``many``).
FOUND = ("kind int, key bigint, at int, a binary, b binary, c binary, many bigint, "
         + ", ".join(f"{c} bigint" for c in COUNTS))
FOUND_ARROW = pa.schema(
    [("kind", pa.int32()), ("key", pa.int64()), ("at", pa.int32()), ("a", pa.binary()),
     ("b", pa.binary()), ("c", pa.binary()), ("many", pa.int64()), *((c, pa.int64()) for c in COUNTS)])
OTHERS = (0,) * (1 + K)


def groups(keys: np.ndarray):
    """(key, where it is) for every different key."""
    order = np.argsort(keys, kind="stable")
    cut = np.flatnonzero(np.append(True, np.diff(keys[order]) != 0)) if len(keys) else []
    for begin, end in zip(cut, [*cut[1:], len(keys)]):
        yield int(keys[order[begin]]), order[begin:end]


def history_buckets(buckets: int) -> int:
    """Sums are fewer than the bigrams they are of."""
    return -(-buckets // 8)


def history_bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(h.astype(np.uint64)) % np.uint64(history_buckets(buckets))).astype(np.int64)


def history_sums(h: np.ndarray, c: np.ndarray, p: np.ndarray, buckets: int):
    """Rows of FOUND, kind 1, from different seen bigrams with their counts and P(w)."""
    histories, of = np.unique(h, return_inverse=True)
    m = len(histories)
    mass = np.bincount(of, p, m)
    counts = np.stack([np.bincount(of, c, m), np.bincount(of, c > K, m),
                       *(np.bincount(of, c == r, m) for r in range(1, K + 1))]).astype(np.int64)
    for b, at in groups(history_bucket(histories, buckets)):
        yield (1, b, 0, squeeze(np.diff(histories[at], prepend=0), 7),
               squeeze(mass[at].view(np.int64), 8), squeeze(counts[:, at].reshape(-1), 8), *OTHERS)


def evaluate(table: pa.Table, words: Words1, buckets: int) -> pa.Table:
    """All that one partition of the table knows; see FOUND."""

    def joined(name: str, width: int) -> list[np.ndarray]:
        return [unplanes(x.as_buffer(), width) for x in table.column(name)]

    gaps, runs = joined("gaps", 7), joined("runs", 4)
    w = np.concatenate([np.repeat(np.cumsum(g), r) for g, r in zip(gaps, runs)])
    h = np.concatenate(joined("h", 7))
    counted = joined("doc", 4)
    ends = np.cumsum([len(x) for x in counted])
    count = np.concatenate(counted)
    del counted, gaps
    # Entries of one bigram, then of one word.
    order = np.lexsort((h, w))
    new_w = np.append(True, np.diff(w[order]) != 0)
    new = new_w | np.append(True, np.diff(h[order]) != 0)
    pair, word = np.empty(len(w), np.int32), np.empty(len(w), np.int32)
    pair[order], word[order] = np.cumsum(new) - 1, np.cumsum(new_w) - 1
    first = order[new]  # an entry of each bigram
    del order, new, new_w
    c_pair = np.bincount(pair, count).astype(np.int64)
    c_word = np.bincount(word, count).astype(np.int64)
    bucket = table.column("bucket")[0].as_py()
    own = table.column("slice").to_numpy()
    rows = []
    for name, run, begin, end in zip(own, runs, [0, *ends[:-1]], ends):
        # Of words in the broadcast list a partition sees a part only.
        heads = begin + np.cumsum(run) - run
        rows.append((0, int(name), bucket, planes(c_pair[pair[begin:end]], 4),
                     planes(c_word[word[heads]], 4), None, *OTHERS))
    some = first[c_pair > 0]
    heavy = words.count_heavy(w[some])
    p = words.probability(np.where(heavy >= 0, heavy, c_word[word[some]]))
    rows.extend(history_sums(h[some], c_pair[c_pair > 0], p, buckets))
    # Histories of the broadcast list have their weights sent to all slices.
    unseen = np.flatnonzero(c_pair[pair] == 0)
    unseen = unseen[~words.heavy_history(h[unseen])]
    asked = own[np.searchsorted(ends, unseen, "right")]
    for b, at in groups(history_bucket(h[unseen], buckets)):
        rows.append((2, b, 0, planes(h[unseen[at]], 7), planes(asked[at], 8), None, *OTHERS))
    rows.append((3, 0, 0, None, None, None, int(np.count_nonzero(c_pair == K + 1)),
                 *(int(np.count_nonzero(c_pair == r)) for r in range(1, K + 1))))
    return found_table(rows)


def found_table(rows: list[tuple]) -> pa.Table:
    found = pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), FOUND_ARROW)],
                     schema=FOUND_ARROW)
    return pa.Table.from_batches(found.to_batches(max_chunksize=2_000))  # small messages


def of_pairs(docs: DataFrame, words: Words1, buckets: int) -> DataFrame:
    """Rows of FOUND for the heavy bigrams: their parts of the sums per history and of the counts of
    counts."""
    _, w, h, c = (x[words.pairs[3] > 0] for x in words.pairs)
    rows = list(history_sums(h, c, words.probability(words.count_heavy(w)), buckets))
    rows.append((3, 0, 0, None, None, None, int((c == K + 1).sum()),
                 *(int((c == r).sum()) for r in range(1, K + 1))))
    return docs.sparkSession.createDataFrame(rows, FOUND)


# log10 alpha of histories, for a slice that asked or, without one, for all.
WEIGHED = "slice bigint, at int, a binary, b binary"
WEIGHED_ARROW = pa.schema(
    [("slice", pa.int64()), ("at", pa.int32()), ("a", pa.binary()), ("b", pa.binary())])


def weigh(table: pa.Table, words: Words1, factors: list[float]) -> pa.Table:
    """Rows of WEIGHED from all rows of FOUND of one bucket of histories."""
    kind = table.column("kind").to_numpy()
    a, b, c = (table.column(x) for x in "abc")
    sums, asked = np.flatnonzero(kind == 1), np.flatnonzero(kind == 2)
    rows = []
    if len(sums):
        h = np.concatenate([np.cumsum(unsqueeze(a[i].as_py(), 7)) for i in sums])
        p = np.concatenate([unsqueeze(b[i].as_py(), 8).view(np.float64) for i in sums])
        counts = np.concatenate(
            [unsqueeze(c[i].as_py(), 8).reshape(2 + K, -1) for i in sums], axis=1)
        known, of = np.unique(h, return_inverse=True)
        p = np.bincount(of, p)
        total, above, *small = (np.bincount(of, x) for x in counts)
        kept = total - HALF * above
        for r, (n, d) in enumerate(zip(small, factors)):
            kept -= (r + 1) * (1 - d) * n
        weight = np.log10((1 - kept / total) / (1 - p))
        heavy = np.flatnonzero(words.heavy_history(known))
        if len(heavy):
            rows.append((None, 0, planes(known[heavy], 7), weight[heavy].tobytes()))
        if len(asked):
            h = np.concatenate([unplanes(a[i].as_buffer(), 7) for i in asked])
            name = np.concatenate([unplanes(b[i].as_buffer(), 8) for i in asked])
            at = np.minimum(np.searchsorted(known, h), len(known) - 1)
            name, at = name[known[at] == h], at[known[at] == h]
            for one, of in groups(name):
                own = np.unique(at[of])
                rows.append((one, -1, planes(known[own], 7), weight[own].tobytes()))
    columns = list(zip(*rows)) or [()] * 4
    weighed = pa.table([pa.array(x, f.type) for x, f in zip(columns, WEIGHED_ARROW)],
                       schema=WEIGHED_ARROW)
    return pa.Table.from_batches(weighed.to_batches(max_chunksize=2_000), WEIGHED_ARROW)


def finish(row: dict, answers: pa.Table, words: Words1, buckets: int, factors: list[float],
           common: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, ...]:
    """n_tokens, n_known, base score and score of the documents of a slice, from the answers to it (in
    any order: at is the bucket, or -1 for weights) and the weights of heavy histories."""
    own = Slice(row, words, buckets)
    at = answers.column("at").to_numpy()
    a, b = answers.column("a"), answers.column("b")
    by_bucket = {int(at[i]): i for i in range(len(at)) if at[i] >= 0}
    c_pair = own.known.copy()
    c_word = words.count_heavy(own.words)
    light = c_word < 0
    for begin, end in own.parts():
        i = by_bucket[int(own.bucket[begin])]
        c_pair[own.sent[begin:end]] = unplanes(a[i].as_buffer(), 4)
        of = own.of[own.sent[begin:end]]
        of = of[np.flatnonzero(np.diff(of, prepend=-1))]
        count = unplanes(b[i].as_buffer(), 4)
        c_word[of] = np.where(light[of], count, c_word[of])
    weights = [i for i in range(len(at)) if at[i] < 0]
    known = np.concatenate([common[0], *(unplanes(a[i].as_buffer(), 7) for i in weights)])
    weight = np.concatenate([common[1], *(np.frombuffer(b[i].as_buffer(), "<f8") for i in weights)])
    order = np.argsort(known)
    known, weight = known[order], weight[order]
    # Terms per word and per bigram, then per token.
    base = np.log10((c_word + 0.1) / (words.total + 0.1 * (words.types + 1)))
    after = np.where(own.before < 0, words.texts, c_word[own.before])
    small = np.concatenate([[1.0], np.arange(1, K + 1) * np.array(factors)])
    less = np.where(c_pair > K, c_pair - HALF, small[np.minimum(c_pair, K)])
    term = np.log10(less / np.maximum(after, 1))
    unseen = np.flatnonzero(c_pair == 0)
    term[unseen] = np.log10(np.maximum(words.probability(c_word[own.of[unseen]]), 1e-300))
    if len(known):
        place = np.minimum(np.searchsorted(known, own.h[unseen]), len(known) - 1)
        term[unseen] += np.where(known[place] == own.h[unseen], weight[place], 0.0)
    n = len(own.sizes)
    return (own.sizes, np.bincount(own.d, c_word[own.at] > 0, n).astype(np.int64),
            np.bincount(own.d, base[own.at], n), np.bincount(own.d, term[own.pair], n))


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", of: int = 10) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document.

    It learns from the rows whose crc32 of the key, modulo ``of``, is not 0.
    """
    spark = docs.sparkSession
    words = learn_words(stored(count_words(docs, key, text, of), "words"))
    words.pairs = heavy_pairs(docs, words, key, text, of)
    buckets = max(1, -(-words.tokens // BUCKET))
    sent = spark.sparkContext.broadcast(words)
    held = stored(slices(docs, key, text, of), "slices")
    found = stored(
        deal(held, words, buckets).repartitionById(buckets, F.col("bucket")).groupBy("bucket")
        .applyInArrow(lambda t: evaluate(t, sent.value, buckets), FOUND), "bigrams")
    answers = found.where("kind = 0").select(F.col("key").alias("slice"), "at", "a", "b")
    found = found.where("kind > 0").unionByName(of_pairs(docs, words, buckets))
    sums = found.where("kind = 3").agg(*(F.sum(c) for c in [*COUNTS, "many"])).first()
    factors = discounts({r + 1: n or 0 for r, n in enumerate(sums)})
    weights = stored(
        found.where("kind in (1, 2)").select(
            F.col("key").cast("int").alias("home"), "kind", "a", "b", "c")
        .repartitionById(history_buckets(buckets), F.col("home")).groupBy("home")
        .applyInArrow(lambda t: weigh(t, sent.value, factors), WEIGHED), "weights")
    rows = weights.where("slice is null").collect()  # at most one in HEAVY tokens
    common = spark.sparkContext.broadcast((
        np.concatenate([np.zeros(0, np.int64), *(unplanes(r["a"], 7) for r in rows)]),
        np.concatenate([np.zeros(0), *(np.frombuffer(r["b"], "<f8") for r in rows)])))
    answers = answers.unionByName(weights.where("slice is not null"))
    kind = docs.schema[key].dataType.simpleString()
    names = [key, "n_tokens", "n_known", "base_score", "score"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = []
        for row in left.drop_columns("ids").to_pylist():
            own = right.filter(pc.equal(right.column("slice"), row["slice"]))
            parts.append(finish(row, own, sent.value, buckets, factors, common.value))
        ids = pa.concat_arrays([x.flatten() for x in left.column("ids").chunks])
        return pa.table([ids, *(pa.array(np.concatenate(x)) for x in zip(*parts))], names)

    # Slices are dealt out in turn, so that no task gets many of them.
    tasks = held.agg(F.max(F.shiftright("slice", 32))).first()[0] or 0
    turn = F.shiftright("slice", 32) + F.col("slice").bitwiseAND(0xFFFFFFFF) * (tasks + 1)
    at_home = (x.withColumn("home", (turn % buckets).cast("int"))
               .repartitionById(buckets, F.col("home")).groupBy("home") for x in (held, answers))
    scores = next(at_home).cogroup(next(at_home)).applyInArrow(
        run, f"{key} {kind}, n_tokens bigint, n_known bigint, base_score double, score double")
    return scores.select(
        key, held_out(key, of).alias("held_out"), "n_tokens", "n_known",
        F.lit(words.total).cast("bigint").alias("train_tokens"), "base_score", "score")
