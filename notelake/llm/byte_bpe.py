"""Byte-level BPE: a heap of merge ranks over a doubly linked list of symbols.

Edge cases: a null text is the empty text, which has no ids and decodes to ''. Repeated rows are
each encoded. Strings of special tokens inside a text become their id, as the library does it.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from notelake.llm.texts import map_texts

# Fixed value: the pattern that cuts a text into pieces which no merge crosses.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

CACHE = 200_000


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in the vocabulary: itself if printable, else shifted."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


class ByteBpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, letters = spec["model"]["vocab"], byte_letters()
        back = {letter: byte for byte, letter in letters.items()}
        self.byte_id = [vocab[letters[b]] for b in range(256)]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.strings = [b""] * size
        for token, i in vocab.items():
            self.strings[i] = bytes(back[c] for c in token)
        for token, i in self.special.items():
            self.strings[i] = token.encode()
        self.merges = {}
        for rank, (left, right) in enumerate(spec["model"]["merges"]):
            self.merges[vocab[left], vocab[right]] = (rank, vocab[left + right])
        self.pieces = regex.compile(PATTERN).findall
        self.specials = regex.compile(
            "(" + "|".join(regex.escape(t) for t in self.special) + ")") if self.special else None
        self.known: dict[str, bytes] = {}

    def merge(self, data: bytes) -> list[int]:
        """Ids of one piece. Merged-away symbols are None, so stale heap entries are skipped."""
        symbol: list[int | None] = [self.byte_id[b] for b in data]
        n, merges = len(symbol), self.merges
        if n < 2:
            return symbol
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []
        for i in range(n - 1):
            if found := merges.get((symbol[i], symbol[i + 1])):
                heap.append((found[0], i, symbol[i], symbol[i + 1], found[1]))
        heapify(heap)
        while heap:
            _, i, left, right, new = heappop(heap)
            j = after[i]
            if symbol[i] != left or j >= n or symbol[j] != right:
                continue
            symbol[i], symbol[j] = new, None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if found := merges.get((new, symbol[k])):
                    heappush(heap, (found[0], i, new, symbol[k], found[1]))
            h = before[i]
            if h >= 0 and (found := merges.get((symbol[h], new))):
                heappush(heap, (found[0], h, symbol[h], new, found[1]))
        return [s for s in symbol if s is not None]

    def plain(self, text: str) -> bytes:
        known, out = self.known, []
        for piece in self.pieces(text):
            ids = known.get(piece)
            if ids is None:
                ids = np.array(self.merge(piece.encode()), "<u4").tobytes()
                if len(known) >= CACHE:
                    known.clear()
                if len(piece) < 64:
                    known[piece] = ids
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not self.specials or not any(t in text for t in self.special):
            return self.plain(text)
        return b"".join(
            np.array([self.special[part]], "<u4").tobytes() if part in self.special
            else self.plain(part) for part in self.specials.split(text))

    def decode(self, ids: bytes) -> str:
        strings = self.strings
        joined = b"".join([strings[i] for i in np.frombuffer(ids, "<u4").tolist()])
        return joined.decode("utf-8", "replace")


@lru_cache(maxsize=2)
def bpe(path: str) -> ByteBpe:
    return ByteBpe(path)


def encode_texts(docs: DataFrame, vocab: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids, decoded): the ids of every whole text as binary (see ``encode``), and the text
    that they decode to. Each executor reads the file ``vocab`` once."""

    def work(batch: pa.RecordBatch):
        codec = bpe(vocab)
        ids = [codec.encode(t or "") for t in batch.column(1).to_pylist()]
        return batch.column(0), pa.array(ids, pa.binary()), [codec.decode(i) for i in ids]

    kind = docs.schema[key].dataType.simpleString()
    return map_texts(docs, key, text, f"{key} {kind}, ids binary, decoded string", work,
                     done=lambda: bpe(vocab).known.clear())


def digest_texts(docs: DataFrame, vocab: str, key: str = "doc_id", text: str = "text",
                 with_ids: bool = False) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of ``encode_texts``, hashed where they arise.

    ``with_ids`` adds the ids themselves.
    """

    def work(batch: pa.RecordBatch):
        codec, counts, ids_sha, decoded_sha, all_ids = bpe(vocab), [], [], [], []
        for t in batch.column(1).to_pylist():
            ids = codec.encode(t or "")
            counts.append(len(ids) // 4)
            ids_sha.append(hashlib.sha256(ids).hexdigest())
            decoded_sha.append(hashlib.sha256(codec.decode(ids).encode()).hexdigest())
            if with_ids:
                all_ids.append(ids)
        return (batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()),
                pa.array(decoded_sha, pa.string()),
                *([pa.array(all_ids, pa.binary())] if with_ids else []))

    kind = docs.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return map_texts(docs, key, text, schema + ", ids binary" * with_ids, work,
                     done=lambda: bpe(vocab).known.clear())
