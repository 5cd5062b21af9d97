"""Token counts by finite-state transducers.

A vocabulary file (BPE with word ends) is compiled into two deterministic machines. The first reads
character classes and marks where the pieces of the pre-tokenizer begin. It has seven states, so a
chunk of text is a map from states to states; the maps of all chunks compose in a parallel prefix
scan, after which every chunk knows its state of entry and marks its pieces on its own. The second
reads the bytes of the pieces. Its transitions carry the number of tokens they add (negative where
a byte joins earlier tokens into one), so the count of a text is a sum over its transitions. Its
states are finite: a state is the list of suffixes that could still grow into a token, each with
the token before it and the number of tokens since. States are built when a text first needs them.

Edge cases: a null text is empty, with 0 bytes and 0 tokens. Texts of any length are read whole.
Repeated rows are each counted. Special tokens inside a text count one each, as in the library.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from notelake.llm.byte_bpe import byte_letters
from notelake.llm.texts import BASE, BYTE_VALUE, map_texts, mix, powers

# Classes of characters. Fixed value: the letters of the contractions 's 't 're 've 'm 'll 'd.
SPACE, LETTER, NUMBER, QUOTE, OTHER, CUT = range(6)
CONTRACTION = {c: 6 + i for i, c in enumerate("strevmld")}
CLASSES = 6 + len(CONTRACTION)
UNKNOWN = 255

# States of the first machine: between pieces, in letters, in other signs, after a quote that
# opens a piece, and after such a quote with r, v or l.
BETWEEN, LETTERS, SIGNS, QUOTED, QUOTED_R, QUOTED_V, QUOTED_L = range(7)
STATES = 7
HERE, BEFORE = 1, 2  # marks: a piece begins at this character, at the one before

CHUNK = 256
LANE = 1024
END = 256
SYMBOLS = 257
SPREAD = np.uint64(0x9E3779B97F4A7C15)

# So many states are kept from one slice of texts to the next; it bounds memory, not results.
MAX_STATES = 150_000


def piece_machine() -> tuple[np.ndarray, np.ndarray]:
    """Next state and marks for [state, class]."""
    step = np.zeros((STATES, CLASSES), np.uint8)
    mark = np.zeros((STATES, CLASSES), np.uint8)
    letters = {LETTER, *CONTRACTION.values()}
    fresh = {SPACE: (BETWEEN, 0), CUT: (BETWEEN, 0), NUMBER: (BETWEEN, HERE), QUOTE: (QUOTED, HERE),
             OTHER: (SIGNS, HERE)} | {c: (LETTERS, HERE) for c in letters}
    own = {
        BETWEEN: {},
        LETTERS: {c: (LETTERS, 0) for c in letters},
        SIGNS: {QUOTE: (SIGNS, 0), OTHER: (SIGNS, 0)},
        QUOTED: {QUOTE: (SIGNS, 0), OTHER: (SIGNS, 0)}
        | {CONTRACTION[c]: (BETWEEN, 0) for c in "stmd"}
        | {CONTRACTION["r"]: (QUOTED_R, 0), CONTRACTION["v"]: (QUOTED_V, 0),
           CONTRACTION["l"]: (QUOTED_L, 0)},
    }
    for state, last in ((QUOTED_R, "e"), (QUOTED_V, "e"), (QUOTED_L, "l")):
        # No contraction after all: the letter before opened a run of letters.
        opened = {c: (to, BEFORE | m) for c, (to, m) in fresh.items()}
        opened |= {c: (LETTERS, BEFORE) for c in letters}
        own[state] = opened | {CONTRACTION[last]: (BETWEEN, 0)}
    for state in range(STATES):
        for kind, (to, marks) in (fresh | own[state]).items():
            step[state, kind], mark[state, kind] = to, marks
    return step, mark


def entry_states(kinds: np.ndarray, step: np.ndarray) -> np.ndarray:
    """State in which each row of ``kinds`` is entered, when row 0 is entered BETWEEN pieces."""
    maps = np.tile(np.arange(STATES, dtype=np.uint8), (len(kinds), 1))
    flat = step.ravel()
    for j in range(kinds.shape[1]):
        maps = flat[maps.astype(np.intp) * CLASSES + kinds[:, j, None]]
    gap = 1
    while gap < len(maps):  # prefix scan: after it, map i leads through chunks 0..i
        joined = maps.copy()
        joined[gap:] = np.take_along_axis(maps[gap:], maps[:-gap].astype(np.intp), 1)
        maps, gap = joined, gap * 2
    entries = np.zeros(len(kinds), np.uint8)
    entries[1:] = maps[:-1, BETWEEN]
    return entries


class Transitions:
    """(state, symbol) -> (next state, tokens added): a hash table of arrays, at most a quarter full."""

    def __init__(self, bits: int = 16):
        self.shift, self.used = np.uint64(64 - bits), 0
        self.keys = np.full(1 << bits, -1, np.int64)
        self.next = np.zeros(1 << bits, np.int32)
        self.adds = np.zeros(1 << bits, np.int32)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Where each key is or belongs."""
        slots = ((keys.astype(np.uint64) * SPREAD) >> self.shift).astype(np.int64)
        found = self.keys[slots]
        rest = np.flatnonzero((found != keys) & (found >= 0))
        while len(rest):
            slots[rest] = (slots[rest] + 1) & (len(self.keys) - 1)
            found = self.keys[slots[rest]]
            rest = rest[(found != keys[rest]) & (found >= 0)]
        return slots

    def put(self, keys: np.ndarray, to: np.ndarray, adds: np.ndarray) -> None:
        """Add transitions whose keys are new and different."""
        if (self.used + len(keys)) * 4 >= len(self.keys):
            full = self.keys >= 0
            old = self.keys[full], self.next[full], self.adds[full]
            bits = len(self.keys).bit_length() - 1
            while (self.used + len(keys)) * 4 >= 1 << bits:
                bits += 1
            self.__init__(bits)
            self.put(*old)
        self.used += len(keys)
        while len(keys):
            slots = self.slots(keys)
            # Of keys that want one slot the first gets it, the others look on from there.
            _, first = np.unique(slots, return_index=True)
            at = slots[first]
            self.keys[at], self.next[at], self.adds[at] = keys[first], to[first], adds[first]
            rest = np.ones(len(keys), bool)
            rest[first] = False
            keys, to, adds = keys[rest], to[rest], adds[rest]


class TokenMachine:
    """The second machine, built as far as texts have needed it."""

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str):
        back = {letter: byte for byte, letter in byte_letters().items()}

        def raw(token: str) -> tuple[bytes, bool]:
            end = token.endswith(suffix)
            return bytes(back[c] for c in (token[:-len(suffix)] if end else token)), end

        self.ranks = {(raw(a), raw(b)): i for i, (a, b) in reversed(list(enumerate(merges)))}
        self.tokens = {raw(t) for t in vocab}
        self.growing = {b[:i] for b, end in self.tokens for i in range(1, len(b) + end)}
        self.forget()

    def forget(self) -> None:
        """Back to the state of entry; the others are built anew when they are needed."""
        self.fits: dict = {}
        self.ids: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.moves = Transitions()
        # The empty suffix, before which there is no token yet.
        self.start = self.number(((b"", None, 0),))

    def number(self, state: tuple) -> int:
        if (found := self.ids.get(state)) is None:
            found = self.ids[state] = len(self.states)
            self.states.append(state)
        return found

    def merge(self, symbols: list) -> list:
        """The plain definition, for the few bytes of two tokens."""
        while len(symbols) > 1:
            ranked = [(self.ranks.get(pair, 1 << 30), i)
                      for i, pair in enumerate(zip(symbols, symbols[1:]))]
            rank, i = min(ranked)
            if rank == 1 << 30:
                break
            symbols[i:i + 2] = [(symbols[i][0] + symbols[i + 1][0], symbols[i + 1][1])]
        return symbols

    def fit(self, left: bytes | None, right: bytes, end: bool) -> bool:
        """Do these two tokens stay as they are when their bytes are encoded together?"""
        key = left, right, end
        if (found := self.fits.get(key)) is None:
            both = (left or b"") + right
            symbols = [(both[i:i + 1], False) for i in range(len(both))]
            symbols[-1] = (symbols[-1][0], end)
            wanted = ([] if left is None else [(left, False)]) + [(right, end)]
            found = self.fits[key] = self.merge(symbols) == wanted
        return found

    def build(self, number: int, symbol: int) -> tuple[int, int]:
        """The next state and the tokens added."""
        state = self.states[number]
        if symbol == END:
            ends = [since for s, t, since in state
                    if s and (s, True) in self.tokens and self.fit(t, s, True)]
            if len(ends) != 1:
                raise ValueError(f"{len(ends)} ways to end a piece; the merges are not proper")
            to, add = self.start, ends[0] + 1
        else:
            byte = bytes([symbol])
            grown = [(s + byte, t, since) for s, t, since in state]
            last = [(s, since) for s, t, since in grown
                    if (s, False) in self.tokens and self.fit(t, s, False)]
            if len(last) != 1:
                raise ValueError(f"{len(last)} ways to go on; the merges are not proper")
            token, add = last[0][0], last[0][1] + 1
            kept = [(s, t, since - add) for s, t, since in grown if s in self.growing]
            to = self.number((*kept, (b"", token, 0)))
        return to, add

    def run(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Tokens that each symbol adds. ``ends``: positions behind the END symbols.

        Lanes of whole pieces are read side by side, one symbol of each at a time.
        """
        out = np.zeros(len(symbols), np.int64)
        if not len(symbols):
            return out
        if len(self.states) > MAX_STATES:
            self.forget()
        cuts = ends[np.searchsorted(ends, np.arange(LANE, len(symbols), LANE))]
        bounds = np.unique(np.concatenate([[0], cuts, [len(symbols)]]))
        sizes = np.diff(bounds)
        order = np.argsort(-sizes, kind="stable")
        at, sizes = bounds[:-1][order].copy(), sizes[order]
        live = np.searchsorted(-sizes, -np.arange(sizes[0]), "left")
        state = np.full(len(at), self.start, np.int64)
        for n in live:
            keys = state[:n] * SYMBOLS + symbols[at[:n]]
            slots = self.moves.slots(keys)
            new = self.moves.keys[slots] < 0
            if new.any():
                missing = np.unique(keys[new])
                built = [self.build(*divmod(key, SYMBOLS)) for key in missing.tolist()]
                self.moves.put(missing, *np.array(built, np.int32).T)
                slots = self.moves.slots(keys)
            out[at[:n]] = self.moves.adds[slots]
            state[:n] = self.moves.next[slots]
            at[:n] += 1
        return out


class Counter:
    """Both machines of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.machine = TokenMachine(model["vocab"], model["merges"], model["end_of_word_suffix"])
        self.step, self.mark = piece_machine()
        self.specials = re.compile("|".join(re.escape(t["content"]) for t in spec["added_tokens"]))
        library = Tokenizer.from_file(path)
        self.pre = library.pre_tokenizer.pre_tokenize_str
        self.library_normal = library.normalizer.normalize_str
        self.late: dict[int, str] = {}  # lower case that is newer than this Python's
        self.kinds = np.full(0x110000, UNKNOWN, np.uint8)
        self.kinds[0] = CUT

    def kind_of(self, c: str) -> int:
        """Class of a character, as the pre-tokenizer of the file treats it."""
        if c == "'":
            return QUOTE
        if c in CONTRACTION:
            return CONTRACTION[c]
        if not self.pre(c):
            return SPACE
        if len(self.pre("a" + c)) == 1:
            return LETTER
        return NUMBER if len(self.pre(c + c)) == 2 else OTHER

    def normal(self, text: str) -> str:
        """Composed and in lower case, each character by itself."""
        text = unicodedata.normalize("NFC", text) if not text.isascii() else text
        text = text.replace("Σ", "σ").lower()
        return text.translate(self.late) if self.late else text

    def of_pieces(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Tokens of each piece; piece i is data[at[i]:at[i + 1]].

        A piece adds the same tokens wherever it stands, so the machine reads different ones only.
        Hashes tell equal pieces, and a comparison of all bytes confirms it.
        """
        size = np.diff(at)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE_VALUE[data] * powers(BASE, len(data)), out=sums[1:])
        back = powers(pow(BASE, -1, 1 << 64), len(data) + 1)
        hashes = mix((sums[at[1:]] - sums[at[:-1]]) * back[at[:-1]] + size.astype(np.uint64))
        _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        same = np.repeat(at[first][which] - at[:-1], size) + np.arange(len(data))
        equal = (size == size[first][which]) & ~np.logical_or.reduceat(
            data != data[np.minimum(same, len(data) - 1)], at[:-1])
        read = np.concatenate([first, np.flatnonzero(~equal)])
        which = np.where(equal, which, 0)
        which[~equal] = np.arange(len(first), len(read))
        # The pieces that are read, each followed by END.
        ends = np.cumsum(size[read] + 1)
        symbols = np.full(int(ends[-1]), END, np.int64)
        begin = ends - size[read] - 1
        inside = np.arange(len(symbols)) - np.repeat(begin, size[read] + 1)
        taken = np.ones(len(symbols), bool)
        taken[ends - 1] = False
        symbols[taken] = data[(np.repeat(at[read], size[read] + 1) + inside)[taken]]
        tokens = np.concatenate([[0], np.cumsum(self.machine.run(symbols, ends))])
        return (tokens[ends] - tokens[begin])[which]

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        special = np.zeros(len(texts), np.int64)
        lengths = np.zeros(len(texts) + 1, np.int64)
        parts: list[str] = []
        for i, text in enumerate(texts):
            cut = self.specials.split(text) if "<|" in text else [text]
            special[i] = len(cut) - 1
            for part in cut:
                # U+0000 ends every part; one inside a text is U+0001, which counts alike.
                part = self.normal(part.replace("\0", "\x01")) + "\0"
                parts.append(part)
                lengths[i + 1] += len(part)
        chars = np.frombuffer("".join(parts).encode("utf-32-le"), "<u4")
        bounds = np.cumsum(lengths)
        if not len(chars):
            return special
        kinds = self.kinds[chars]
        if (kinds == UNKNOWN).any():
            late = len(self.late)
            for c in np.unique(chars[kinds == UNKNOWN]).tolist():
                self.kinds[c] = kind = self.kind_of(chr(c))
                if kind != SPACE and (normal := self.library_normal(chr(c))) != chr(c):
                    self.late[c] = normal
            if len(self.late) > late:
                return self.count(texts)
            kinds = self.kinds[chars]
        opens = self.opens(kinds)
        inside = (kinds != SPACE) & (kinds != CUT)
        # A piece closes where the next character opens one or lies between pieces.
        closes = inside.copy()
        closes[:-1] &= opens[1:] | ~inside[1:]
        # Bytes of the characters inside pieces.
        points = chars[inside]
        width = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
        data = np.frombuffer(points.astype("<u4").tobytes().decode("utf-32-le").encode(), np.uint8)
        shut = np.flatnonzero(closes[inside]) + 1
        if not len(shut):
            return special
        at = np.concatenate([[0], np.cumsum(width)[shut - 1]])
        tokens = np.concatenate([[0], np.cumsum(self.of_pieces(data, at))])
        # Characters inside pieces before each text, then pieces before it.
        before = np.concatenate([[0], np.cumsum(inside)])[bounds]
        return special + np.diff(tokens[np.searchsorted(shut, before, "right")])

    def opens(self, kinds: np.ndarray) -> np.ndarray:
        """Where pieces begin."""
        padded = np.full(-(-len(kinds) // CHUNK) * CHUNK, CUT, np.uint8)
        padded[:len(kinds)] = kinds
        rows = padded.reshape(-1, CHUNK)
        state = entry_states(rows, self.step).astype(np.intp)
        step, mark = self.step.ravel(), self.mark.ravel()
        marks = np.zeros(rows.shape, np.uint8)
        for j in range(CHUNK):
            at = state * CLASSES + rows[:, j]
            marks[:, j] = mark[at]
            state = step[at].astype(np.intp)
        flat = marks.ravel()[:len(kinds)]
        opens = (flat & HERE) > 0
        opens[:-1] |= (flat[1:] & BEFORE) > 0
        return opens


@lru_cache(maxsize=1)
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(docs: DataFrame, vocab: str, limit: int = 2048, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) of every whole text under the file ``vocab``."""

    def work(batch: pa.RecordBatch):
        texts = [t or "" for t in batch.column(1).to_pylist()]
        tokens = counter(vocab).count(texts)
        n_bytes = [len(t) if t.isascii() else len(t.encode()) for t in texts]
        return batch.column(0), pa.array(n_bytes, pa.int64()), tokens, tokens > limit

    kind = docs.schema[key].dataType.simpleString()
    return map_texts(
        docs, key, text, f"{key} {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean", work)
