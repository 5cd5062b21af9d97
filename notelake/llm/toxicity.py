"""Toxicity: bags of character n-grams, averaged embeddings, a linear softmax; trained in numpy.

A word's bag holds its character n-grams, marked at both ends, hashed to buckets. A window of
consecutive words is scored by a softmax over the mean embedding of its bag, so a misspelling never
seen shares most vectors with words that were. A document is as toxic as its most toxic window: one
insult counts in a long text as in a short one. Labels are given per document, so training goes in
rounds: choose the window of each toxic document that looks most toxic so far (the first time by
how much more often its n-grams are in toxic documents), set it against the worst-looking and some
other windows of the clean documents, and train embeddings and softmax jointly.

The trained model is linear in the bag, so it is sent out as one number per bucket (1 MB).

Sample: at most ``n_toxic`` and ``n_clean`` labelled documents of at most ``longest`` characters,
those with the smallest hash of their id. That bounds the training on the driver; every document is
scored whole. Edge cases: null and empty texts, and those without a letter or digit, score 0.
A document with several labels is toxic if one of them says so; null labels are ignored. Without a
label of either kind the model knows nothing and scores 0. Repeated rows are each scored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from notelake.llm.texts import filter_texts, held_out, map_texts, mix, slices

BITS = 18
SIZES = (3, 4, 5, 6)
DIM = 8


@lru_cache(maxsize=1)
def word_characters() -> np.ndarray:
    """True for the code points that words are made of."""
    return np.array([not 0xD800 <= c < 0xE000 and chr(c).isalnum() for c in range(0x110000)])


class Bags:
    """The n-grams of all words of some texts: bucket ids in order of their words."""

    def __init__(self, texts: list[str]):
        texts = [f" {t.lower()} " for t in texts]
        chars = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
        word = word_characters()[chars]
        opens = np.flatnonzero(word[1:] & ~word[:-1]) + 1
        ends = np.flatnonzero(word[:-1] & ~word[1:]) + 1
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        # Words of text i are at[i]..at[i+1].
        self.at = np.searchsorted(opens, bounds)
        # One blank on either side of a word marks its ends.
        value = mix(np.where(word, chars, 32).astype(np.uint64) + np.uint64(7))
        number = np.zeros(len(chars), np.int32)
        number[opens] = 1
        number = np.cumsum(number) - 1
        buckets, words = [], []
        inner = np.concatenate([[0], np.cumsum(~word)])
        for size in SIZES:
            n = len(chars) - size + 1
            if n <= 0:
                continue
            # No blank strictly inside, and at least two characters of the word.
            start = np.flatnonzero((inner[size - 1:size - 1 + n] - inner[1:1 + n]) == 0)
            hashed = np.zeros(len(start), np.uint64)
            for k in range(size):
                hashed = hashed * np.uint64(0x9E3779B97F4A7C15) + value[start + k]
            buckets.append((mix(hashed + np.uint64(size)) >> np.uint64(64 - BITS)).astype(np.int32))
            words.append(number[start + 1])
        self.n_words = len(opens)
        self.bucket = np.concatenate(buckets) if buckets else np.zeros(0, np.int32)
        self.word = np.concatenate(words) if words else np.zeros(0, np.int32)
        assert len(ends) == len(opens)

    def word_sums(self, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum of the weights, and number of n-grams, per word."""
        return (np.bincount(self.word, weight[self.bucket], self.n_words),
                np.bincount(self.word, minlength=self.n_words))

    def window_means(self, weight: np.ndarray, width: int):
        """Mean weight of each window, and the windows of each text (at[i]..at[i+1])."""
        sums, counts = (np.concatenate([[0], np.cumsum(x)]) for x in self.word_sums(weight))
        n_words = np.diff(self.at)
        n_windows = np.where(n_words > 0, np.maximum(n_words - width + 1, 1), 0)
        at = np.concatenate([[0], np.cumsum(n_windows)])
        first = np.arange(at[-1]) - np.repeat(at[:-1] - self.at[:-1], n_windows)
        last = np.minimum(first + width, np.repeat(self.at[1:], n_windows))
        return (sums[last] - sums[first]) / np.maximum(counts[last] - counts[first], 1), at, first


    def choose(self, weight: np.ndarray, width: int, toxic: np.ndarray, rng):
        """(text, bag) of the windows to train on: of a toxic text the one that looks worst, of
        another the four that look worst and four more."""
        means, at, first = self.window_means(weight, width)
        grams = self.bucket[np.argsort(self.word, kind="stable")]
        gram_at = np.concatenate([[0], np.cumsum(np.bincount(self.word, minlength=self.n_words))])
        for i in np.flatnonzero(at[1:] > at[:-1]):
            own = means[at[i]:at[i + 1]]
            if toxic[i]:
                picks = {int(own.argmax())}
            else:
                few = min(4, len(own))
                picks = {*np.argpartition(own, -few)[-few:].tolist(),
                         *rng.integers(0, len(own), 4).tolist()}
            for pick in sorted(picks):
                word = first[at[i] + pick]
                last = min(word + width, self.at[i + 1])
                if gram_at[last] > gram_at[word]:
                    yield i, grams[gram_at[word]:gram_at[last]].copy()


@dataclass
class Model:
    """Logit of a window: the mean weight of its n-grams plus the bias."""

    weight: np.ndarray
    bias: float
    width: int

    def score(self, texts: list[str]) -> np.ndarray:
        bags = Bags(texts)
        means, at, _ = bags.window_means(self.weight, self.width)
        out = np.zeros(len(texts))
        some = np.flatnonzero(at[1:] > at[:-1])
        if len(some):
            worst = np.maximum.reduceat(means, at[:-1][some]) + self.bias
            out[some] = 1 / (1 + np.exp(-np.clip(worst, -50, 50)))
        return out


def fit_softmax(bags: list[np.ndarray], labels: np.ndarray, rng, epochs: int, rate: float):
    """Embeddings and softmax, jointly by Adagrad; returns weights per bucket and the bias."""
    table = rng.uniform(-0.5, 0.5, (1 << BITS, DIM)).astype(np.float32) / DIM
    soft, shift = rng.normal(0, 0.5, (2, DIM)), np.zeros(2)
    seen, seen_soft = np.full(1 << BITS, 1e-6, np.float32), np.full((2, DIM), 1e-6)
    sizes = np.array([len(b) for b in bags])
    starts = np.concatenate([[0], np.cumsum(sizes)])
    flat = np.concatenate(bags)
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for batch in np.array_split(order, max(1, len(order) // 128)):
            n = sizes[batch]
            place = np.concatenate([[0], np.cumsum(n)])
            index = flat[np.arange(place[-1]) + np.repeat(starts[batch] - place[:-1], n)]
            mean = np.add.reduceat(table[index], place[:-1], axis=0) / n[:, None]
            logit = mean @ soft.T + shift
            p = np.exp(logit - logit.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(batch)), labels[batch]] -= 1
            pull = (p @ soft) / n[:, None]
            grad = p.T @ mean / len(batch)
            each = np.repeat(pull, n, axis=0).astype(np.float32)
            np.add.at(seen, index, (each ** 2).mean(1))
            np.add.at(table, index, -rate * each / np.sqrt(seen[index])[:, None])
            seen_soft += grad ** 2
            soft -= rate * grad / np.sqrt(seen_soft)
            shift -= rate * p.mean(0)
    along = soft[1] - soft[0]
    # Buckets that no bag has touched say nothing.
    weight = np.where(seen > 1e-6, table @ along, 0).astype(np.float32)
    return weight, float(shift[1] - shift[0])


def train(texts: list[str], toxic: np.ndarray, width: int = 2, rounds: int = 3, epochs: int = 6,
          rate: float = 0.1, seed: int = 7) -> Model:
    """See the module text. ``toxic``: 0 or 1 per text."""
    rng = np.random.default_rng(seed)
    toxic = np.asarray(toxic, np.int64)
    if not len(texts) or toxic.min() == toxic.max():
        return Model(np.zeros(1 << BITS, np.float32), -50.0, width)
    # Log odds of a bucket in toxic documents, to begin with.
    found = [np.full(1 << BITS, 0.5), np.full(1 << BITS, 0.5)]
    for begin, end in slices(texts):
        bags = Bags(texts[begin:end])
        text = np.repeat(np.arange(end - begin), np.diff(bags.at))
        pairs = np.unique((text[bags.word].astype(np.int64) << BITS) + bags.bucket)
        where, bucket = toxic[begin:end][pairs >> BITS], pairs & ((1 << BITS) - 1)
        for k in (0, 1):
            found[k] += np.bincount(bucket[where == k], minlength=1 << BITS)
    share = [f / (np.count_nonzero(toxic == k) + 1) for k, f in enumerate(found)]
    weight, bias = np.log(share[1] / share[0]), 0.0
    weight[found[1] < 3] = 0
    for _ in range(rounds):
        chosen: list[np.ndarray] = []
        kinds: list[int] = []
        for begin, end in slices(texts):
            bags = Bags(texts[begin:end])
            for i, bag in bags.choose(weight, width, toxic[begin:end], rng):
                chosen.append(bag)
                kinds.append(toxic[begin + i])
        if len(set(kinds)) == 2:
            weight, bias = fit_softmax(chosen, np.array(kinds), rng, epochs, rate)
    return Model(weight, bias, width)


def sample_labelled(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str,
                    n_toxic: int, n_clean: int, longest: int):
    """The bounded sample described above: texts and labels."""
    known = labels.where(~held_out(key, 5) & F.col(label).isNotNull() & F.col(key).isNotNull())
    known = known.groupBy(F.col(key).alias("_key")).agg(F.max(label).alias("_toxic"))
    texts, toxic = [], []
    for value, most in ((1, n_toxic), (0, n_clean)):
        ids = known.where(F.col("_toxic") == value).orderBy(F.xxhash64("_key"), "_key").limit(most)
        rows = (  # the ids are at most ``most`` numbers
            docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
            .where(F.char_length("_text").between(1, longest))
            .join(F.broadcast(ids.select("_key")), "_key")
            .orderBy(F.xxhash64("_key"), "_text").limit(most).select("_text").collect()
        )
        texts += [r["_text"] for r in rows]
        toxic += [value] * len(rows)
    return texts, np.array(toxic, np.int64)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
        label: str = "toxic", n_toxic: int = 1500, n_clean: int = 3000,
        longest: int = 32_000) -> Model:
    return train(*sample_labelled(docs, labels, key, text, label, n_toxic, n_clean, longest))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, score, predicted) of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch):
        texts = [t or "" for t in batch.column(1).to_pylist()]
        found = np.concatenate([sent.value.score(texts[a:b]) for a, b in slices(texts)] or [[]])
        return batch.column(0), found, pa.array((found >= 0.5).astype(np.int32))

    kind = docs.schema[key].dataType.simpleString()
    scored = map_texts(docs, key, text, f"{key} {kind}, score double, predicted int", work)
    return scored.select(key, held_out(key, 5).alias("held_out"), "score", "predicted")


def keep_clean(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted to be toxic."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def clean(texts: list[str]) -> np.ndarray:
        parts = [sent.value.score(texts[a:b]) for a, b in slices(texts, 1 << 18)]
        return np.concatenate(parts or [[]]) < 0.5

    return filter_texts(docs, text, clean)
