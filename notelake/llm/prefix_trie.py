"""Prefix trie of conversations: adaptive radix trees per slice, merged by the hash of the prefix.

A turn is known by two hashes of its role and text, a prefix by its depth and the exclusive-or of its
turns' hashes with their places, so prefix hashes are rolled along and never need the prefix itself.
Conversations are cut into segments of ``SEGMENT`` turns. A slice of segments numbers its different
turns and builds an adaptive radix tree over their fixed-width big-endian numbers: node layouts grow from
4 over 16 and 48 to 256 children, and paths without a branch are compressed into one label. Nodes come out
at turn-aligned byte depths only, with what a slice adds to them, and meet under their prefix hash.

Sums over subtrees need no walk through the merged trie. A node belongs to the smallest conversation
through it; what a conversation owns is the end of its own path. A subtree is thus the owner's path from the
node on, plus the whole owned path of every other conversation through the node that owns one: the first
is a running sum, the second is added up by a second pass of the same trees, with these totals as weights.

How it scales: texts are hashed where they are read and not shuffled. Turns are numbered by one sort over
ranges; a conversation of any length, a turn that begins a third of all conversations and a group of copies
are spread over tasks, since slices count before they shuffle. Ids that end at one node are
joined in pieces over ranges and the pieces hashed in order, a piece at a time.

Edge cases: a null role or text is empty; rows of one turn number (null first) are ordered by the hashes of
their role and text; repeated rows are turns of their own. Rows without a conversation id are left out. A
conversation without turns is a member of the root. An empty table has no root and gives no rows; other
columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from notelake.llm.components import stored
from notelake.operators.ordering import global_index

SEGMENT = 64
SLICE = 4096
WIDTH = 4  # bytes of a turn's number
NODE = ["depth", "x", "y"]


class Node:
    """A node with the label that leads to it; its layout is 4, 16, 48 or 256 children wide."""

    __slots__ = ("label", "row", "layout", "keys", "kids")

    def __init__(self, label: bytes, row: int):
        self.label, self.row = label, row
        self.layout, self.keys, self.kids = 4, bytearray(), []

    def slot(self, byte: int) -> int:
        """Where the child of ``byte`` lies, or -1."""
        if self.layout <= 16:
            return self.keys.find(byte)
        if self.layout == 48:
            return self.keys[byte] - 1
        return byte if self.kids[byte] is not None else -1

    def add(self, byte: int, child: Node) -> None:
        if self.layout < 256 and len(self.kids) == self.layout:
            self.grow()
        if self.layout == 256:
            self.kids[byte] = child
            return
        self.kids.append(child)
        if self.layout == 48:
            self.keys[byte] = len(self.kids)
        else:
            self.keys.append(byte)

    def grow(self) -> None:
        if self.layout == 4:
            self.layout = 16
        elif self.layout == 16:
            index = bytearray(256)
            for place, byte in enumerate(self.keys, 1):
                index[byte] = place
            self.layout, self.keys = 48, index
        else:
            kids = [self.kids[place - 1] if place else None for place in self.keys]
            self.layout, self.keys, self.kids = 256, bytearray(), kids

    def children(self):
        return (kid for kid in self.kids if kid is not None)


class RadixTree:
    """Keys of any length, also keys that begin others; ``insert`` returns the node of a key."""

    def __init__(self):
        self.root = Node(b"", -1)

    def insert(self, key: bytes, row: int) -> Node:
        node, at = self.root, 0
        while at < len(key):
            slot = node.slot(key[at])
            if slot < 0:
                leaf = Node(key[at:], row)
                node.add(key[at], leaf)
                return leaf
            child = node.kids[slot]
            label = child.label
            if not key.startswith(label, at):
                same, most = 1, min(len(label), len(key) - at)
                while same < most and label[same] == key[at + same]:
                    same += 1
                upper = Node(label[:same], row)
                child.label = label[same:]
                upper.add(child.label[0], child)
                node.kids[slot] = child = upper
                label = upper.label
            node, at = child, at + len(label)
        return node

    def walk(self):
        """(node, place of its parent, byte depth) of every node, parents first."""
        found, at = [(self.root, -1, 0)], 0
        while at < len(found):
            node, _, depth = found[at]
            found += [(kid, at, depth + len(kid.label)) for kid in node.children()]
            at += 1
        return found


def numbers(*columns: np.ndarray) -> np.ndarray:
    """Equal tuples get equal numbers from 0."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    order = np.lexsort(columns)
    changed = np.zeros(len(order), bool)
    for column in columns:
        changed[1:] |= column[order][1:] != column[order][:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(changed)
    return out


def prefixes(batch: pa.RecordBatch, sums: list[str], least: str | None):
    """What a slice of segments adds to each of its nodes; the root counts in first segments only.

    Columns: segment, from_x, from_y (the prefix before it), turns and what to add up.
    """
    turns = batch.column("turns")
    sizes = np.asarray(turns.value_lengths()).astype(np.int64)
    at = np.concatenate([[0], np.cumsum(sizes)])
    flat = turns.flatten()
    field = {name: np.asarray(flat.field(name)) for name in ("a", "b", "x", "y", "chars")}
    segment = np.asarray(batch.column("segment"))
    start = {name: np.asarray(batch.column(f"from_{name}")) for name in "xy"}
    ids = numbers(field["a"], field["b"]).astype(">u4").tobytes()
    starts = numbers(segment, start["x"], start["y"]).astype(">u4").tobytes()
    tree = RadixTree()
    ends = [tree.insert(starts[WIDTH * i:WIDTH * i + WIDTH] + ids[WIDTH * at[i]:WIDTH * at[i + 1]], i)
            for i in range(batch.num_rows)]
    nodes = tree.walk()
    place = {id(node): n for n, (node, _, _) in enumerate(nodes)}
    own = np.array([place[id(node)] for node in ends], np.int64)
    parent = [p for _, p, _ in nodes]
    totals = {}
    for name in sums:
        total = np.zeros(len(nodes), np.int64)
        np.add.at(total, own, np.asarray(batch.column(name)))
        total = total.tolist()
        for n in range(len(nodes) - 1, 0, -1):
            total[parent[n]] += total[n]
        totals[name] = np.array(total)
    if least:
        value = np.full(len(nodes), np.iinfo(np.int64).max)
        np.minimum.at(value, own, np.asarray(batch.column(least)))
        value = value.tolist()
        for n in range(len(nodes) - 1, 0, -1):
            value[parent[n]] = min(value[parent[n]], value[n])
        totals[least] = np.array(value)
    # The turn-aligned depths inside each label; the first number is that of the start.
    high = np.array([depth // WIDTH for _, _, depth in nodes])
    low = np.concatenate([[0], high[np.array(parent[1:], np.int64)]]).astype(np.int64)
    count = high - low
    node = np.repeat(np.arange(len(nodes)), count)
    turn = np.arange(len(node)) - np.repeat(np.cumsum(count) - count, count) + low[node]
    row = np.array([n.row for n, _, _ in nodes])[node]
    kept = (turn > 0) | (segment[row] == 0)
    node, turn, row = node[kept], turn[kept], row[kept]
    root = turn == 0
    last = np.where(root, 0, at[row] + turn - 1)
    out = {"depth": segment[row] * SEGMENT + turn}
    for name in "xy":
        # Rolled over the whole slice; what lies before a row is taken out again.
        rolled = np.concatenate([[0], np.bitwise_xor.accumulate(field[name])]).astype(np.int64)
        before = rolled[at[row]] ^ start[name][row]
        out[name] = np.where(root, 0, rolled[at[row] + turn] ^ before)
        out[f"p{name}"] = np.where(root, 0, rolled[at[row] + np.maximum(turn - 1, 0)] ^ before)
    chars = np.concatenate([field["chars"], [0]])
    out["chars"] = np.where(root, 0, chars[last])
    return out | {name: total[node] for name, total in totals.items()}


def slice_nodes(segments: DataFrame, sums: list[str], least: str | None = None) -> DataFrame:
    names = [*NODE, "px", "py", "chars", *sums, *([least] if least else [])]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                found = prefixes(batch.slice(at, SLICE), sums, least)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found[n].astype(np.int64)) for n in names], names)

    columns = ["segment", "from_x", "from_y", "turns", *sums, *([least] if least else [])]
    return segments.select(*columns).mapInArrow(run, ", ".join(f"{n} long" for n in names))


def merged_nodes(segments: DataFrame) -> DataFrame:
    """(depth, x, y, px, py, chars, n_convs, conv_id): every distinct prefix once."""
    ones = segments.withColumn("n_convs", F.lit(1).cast("bigint"))
    return slice_nodes(ones, ["n_convs"], "conv_id").groupBy(*NODE).agg(
        *[F.first(c).alias(c) for c in ("px", "py", "chars")], F.sum("n_convs").alias("n_convs"),
        F.min("conv_id").alias("conv_id"))


def cut_segments(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """(conv_id, segment, length, turns, from_x, from_y, x, y) from (conv_id, place, a, b, chars).

    Places count from 1 without gaps; ``conversations`` has the (conv_id, length) of all. The hashes
    x and y are those of the prefix that ends with the segment.
    """
    zero = F.lit(0).cast("bigint")
    hashed = turns.withColumns({
        "segment": F.expr(f"(place - 1) div {SEGMENT}"),
        "x": F.xxhash64(F.lit(1), "place", "a", "b"), "y": F.xxhash64(F.lit(2), "place", "a", "b")})
    rows = hashed.groupBy("conv_id", "segment").agg(
        F.sort_array(F.collect_list(F.struct("place", "a", "b", "x", "y", "chars"))).alias("turns"),
        F.bit_xor("x").alias("own_x"), F.bit_xor("y").alias("own_y"))
    rows = rows.join(conversations, "conv_id")
    empty = conversations.where("length = 0").select(
        "conv_id", zero.alias("segment"),
        F.array().cast(rows.schema["turns"].dataType).alias("turns"), zero.alias("own_x"),
        zero.alias("own_y"), "length")
    every = stored(rows.unionByName(empty), "segments")
    so_far = Window.partitionBy("conv_id").orderBy("segment").rowsBetween(
        Window.unboundedPreceding, 0)
    rolled = every.select("conv_id", "segment", *[
        F.bit_xor(f"own_{c}").over(so_far).alias(c) for c in "xy"])
    return every.join(rolled, ["conv_id", "segment"]).select(
        "conv_id", "segment", "length", "turns",
        *[F.col(c).bitwiseXOR(F.col(f"own_{c}")).alias(f"from_{c}") for c in "xy"], "x", "y")


def from_here_on(nodes: DataFrame, values: list[str]) -> DataFrame:
    """(depth, x, y, conv_id, values) with each value added up over the owner's path from there on.

    Paths are cut into segments: no window holds more than one segment or one row per segment.
    """
    cut = nodes.withColumn("segment", F.expr(f"depth div {SEGMENT}"))
    sums = cut.groupBy("conv_id", "segment").agg(*[F.sum(v).alias(v) for v in values])
    after = Window.partitionBy("conv_id").orderBy("segment").rowsBetween(1, Window.unboundedFollowing)
    later = sums.select("conv_id", "segment", *[
        F.coalesce(F.sum(v).over(after), F.lit(0)).alias(f"later_{v}") for v in values])
    rest = Window.partitionBy("conv_id", "segment").orderBy("depth").rowsBetween(
        0, Window.unboundedFollowing)
    inside = cut.withColumns({v: F.sum(v).over(rest) for v in values})
    return inside.join(later, ["conv_id", "segment"]).select(
        *NODE, "conv_id", *[(F.col(v) + F.col(f"later_{v}")).alias(v) for v in values])


def subtree_sums(nodes: DataFrame, segments: DataFrame, values: list[str]) -> DataFrame:
    """(depth, x, y, values): each value of ``nodes`` added up over every node's subtree."""
    own = stored(from_here_on(nodes, values), "own-paths")
    owned = own.groupBy("conv_id").agg(
        F.min("depth").alias("first"), *[F.max_by(v, -F.col("depth")).alias(v) for v in values])
    left = F.col("first") - 1 - F.col("segment") * SEGMENT
    above = segments.select("conv_id", "segment", "from_x", "from_y", "turns").join(
        owned.where("first > 0"), "conv_id").where((left > 0) | (F.col("segment") == 0)).withColumn(
        "turns", F.slice("turns", F.lit(1), F.least(left, F.size("turns")).cast("int")))
    others = slice_nodes(above, values).groupBy(*NODE).agg(*[F.sum(v).alias(f"other_{v}") for v in values])
    return own.join(others, NODE, "left").select(*NODE, *[
        (F.col(v) + F.coalesce(F.col(f"other_{v}"), F.lit(0))).alias(v) for v in values])


def joined_ids(ends: DataFrame) -> DataFrame:
    """(depth, x, y, ends_sha256): ids in ascending order, joined by commas, hashed piece by piece."""
    def pieces(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            key = [np.asarray(batch.column(c)) for c in NODE]
            new = np.zeros(batch.num_rows, bool)
            for column in key:
                new[1:] |= column[1:] != column[:-1]
            begin = np.concatenate([[0], np.flatnonzero(new)])
            stop = np.concatenate([begin[1:], [batch.num_rows]])
            ids = batch.column("conv_id").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(c[begin]) for c in key], pa.array([ids[i] for i in begin]),
                 pa.array([",".join(map(str, ids[i:j])) for i, j in zip(begin, stop)])],
                [*NODE, "first", "ids"])

    def digests(batches):
        now, state = None, None
        for batch in batches:
            done = []
            for *key, ids in zip(*[batch.column(c).to_pylist() for c in (*NODE, "ids")]):
                if key == now:
                    state.update(b"," + ids.encode())
                    continue
                if now is not None:
                    done.append((*now, state.hexdigest()))
                now, state = key, hashlib.sha256(ids.encode())
            if done:
                yield of(done)
        if now is not None:
            yield of([(*now, state.hexdigest())])

    def of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], [*NODE, "ends_sha256"])

    long = ", ".join(f"{c} long" for c in NODE)
    order = [*NODE, "conv_id"]
    cut = ends.repartitionByRange(*order).sortWithinPartitions(*order).select(*order).mapInArrow(
        pieces, f"{long}, first long, ids string")
    return cut.repartition(*NODE).sortWithinPartitions(*NODE, "first").select(
        *NODE, "ids").mapInArrow(digests, f"{long}, ends_sha256 string")


def trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """All nodes of the trie of (conv_id, place, a, b, chars); see ``cut_segments``."""
    segments = stored(cut_segments(turns, conversations), "rolled")
    nodes = stored(merged_nodes(segments), "nodes")
    children = nodes.where("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("px").alias("x"), F.col("py").alias("y")).agg(
        F.count(F.lit(1)).alias("n_children"))
    counted = stored(nodes.join(children, NODE, "left").fillna(0, ["n_children"]), "counted")
    values = counted.select(
        *NODE, "conv_id", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("bigint").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"))
    last = F.col("segment") == F.expr(f"greatest(length - 1, 0) div {SEGMENT}")
    ends = segments.where(last).select("conv_id", F.col("length").alias("depth"), "x", "y")
    whole = stored(
        counted.join(subtree_sums(values, segments, ["n_leaves", "saved_tokens"]), NODE)
        .join(joined_ids(ends), NODE, "left"), "trie")
    parents = whole.select(
        (F.col("depth") + 1).alias("depth"), F.col("x").alias("px"), F.col("y").alias("py"),
        F.col("conv_id").alias("parent_conv_id"))
    return whole.join(parents, ["depth", "px", "py"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def numbered_turns(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                   text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(conv_id, place, a, b, chars) of all turns in order, and (conv_id, length)."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text)]
    rows = df.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("bigint").alias("conv_id"), F.col(turn).alias("turn"),
        F.xxhash64(F.lit(3), *said).alias("a"), F.xxhash64(F.lit(4), *said).alias("b"),
        F.char_length(said[1]).cast("bigint").alias("chars"))
    index = global_index(rows, [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("a"),
                                F.col("b")])
    sizes = stored(index.groupBy("conv_id").agg(
        F.min("index").alias("start"), F.count(F.lit(1)).alias("length")), "lengths")
    placed = index.join(sizes, "conv_id").select(
        "conv_id", (F.col("index") - F.col("start") + 1).alias("place"), "a", "b", "chars")
    return stored(placed, "turns"), sizes.select("conv_id", "length")


# Rebuilt conversations begin with turns of the first of each hundred; so many at most.
GROUP, MOST = 100, 5


def rebuilt(turns: DataFrame, conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every conversation c with its first h = crc32(c) % 6 turns taken from c - c % 100.

    Its own turns follow, after its first h.
    """
    given = conversations.select(F.col("conv_id").alias("base"), F.col("length").alias("base_length"))
    plan = conversations.withColumns({
        "base": F.col("conv_id") - F.col("conv_id") % GROUP,
        "h": F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST + 1)})
    plan = plan.join(given, "base", "left").withColumn(
        "led", F.least("h", F.coalesce("base_length", F.lit(0)))).select(
        "conv_id", "base", "h", "led",
        (F.col("led") + F.greatest(F.col("length") - F.col("h"), F.lit(0))).alias("new_length"))
    plan = stored(plan, "plan")
    leads = turns.where((F.col("conv_id") % GROUP == 0) & (F.col("place") <= MOST)).withColumnRenamed(
        "conv_id", "base")
    lead = plan.join(leads, "base").where("place <= h").select("conv_id", "place", "a", "b", "chars")
    rest = turns.join(plan, "conv_id").where("place > h").select(
        "conv_id", (F.col("place") - F.col("h") + F.col("led")).alias("place"), "a", "b", "chars")
    return lead.unionByName(rest), plan.select("conv_id", F.col("new_length").alias("length"))


def rebuilt_trie(df: DataFrame) -> DataFrame:
    return trie(*rebuilt(*numbered_turns(df)))
