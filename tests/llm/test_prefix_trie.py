"""The trie against a plain definition; the radix tree against a dictionary."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest

from notelake.llm import prefix_trie
from notelake.llm.components import stored

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def plain(conversations):
    """All nodes of {conv_id: [(role, text), ...]}, as tuples of the result's columns."""
    members = collections.defaultdict(list)
    for c, said in conversations.items():
        for depth in range(len(said) + 1):
            members[tuple(said[:depth])].append(c)
    children = collections.Counter(node[:-1] for node in members if node)
    leaves, saved = collections.Counter(), collections.Counter()
    for node, convs in members.items():
        for depth in range(len(node) + 1):
            leaves[node[:depth]] += node not in children
            if node:
                saved[node[:depth]] += (len(convs) - 1) * len(node[-1][1])
    out = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(conversations[c]) == len(node))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
                    children[node], leaves[node], saved[node],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def rebuild(rows):
    """Rows (conv_id, turn, role, text) with one row per turn number of a conversation."""
    own = collections.defaultdict(list)
    for c, turn, role, text in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own[c].append((role or "", text or ""))
    out = {}
    for c, said in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + said[h:]
    return out


def nodes(frame):
    return sorted((tuple(r) for r in frame.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256").collect()), key=repr)


def frame_of(spark, rows):
    """With columns whose names the operator uses for itself."""
    return spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "1 as depth", "2 as x", "3 as place", "4 as segment", "5 as n_convs")


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    said = [(role, "x" * n) for role in ("user", "assistant", None) for n in (0, 1, 5)]
    out = []
    for c in [*range(0, 320, 1), 700, 701, 799, 1_000_000_007]:
        if c == 200:
            continue  # a hundred without its first
        for turn in range(rng.choice([1, 2, 3, 8])):
            out.append((c, turn - 1 if turn else None, *rng.choice(said[:rng.choice([1, 2, 9])])))
    for c in (310, 311, 600, 601):  # longer than a segment, with common beginnings
        out = [r for r in out if r[0] != c]
        out += [(c, t, "user", str(t % 3) if t < 150 or c % 2 else "other") for t in range(200 - c % 7)]
    rng.shuffle(out)
    return out


def test_rebuilt_conversations_by_brute_force(spark, rows):
    assert nodes(prefix_trie.rebuilt_trie(frame_of(spark, rows))) == plain(rebuild(rows))


def test_edge_cases(spark):
    assert prefix_trie.rebuilt_trie(frame_of(spark, [])).collect() == []
    assert prefix_trie.rebuilt_trie(frame_of(spark, [(None, 1, "user", "x")])).collect() == []
    long = "y" * 3_000_000
    rows = [(i, 0, "user", "hello") for i in range(1, 90)] + [(i, 1, None, None) for i in range(1, 90)]
    rows += [(300, None, "user", long), (300, 1, "", ""), (301, 5, "user", long), (301, 6, "", None)]
    assert nodes(prefix_trie.rebuilt_trie(frame_of(spark, rows))) == plain(rebuild(rows))
    # Rows of one turn number, repeated ones too, are turns of their own in a fixed order.
    tied = [(100 + i, 0, "user", t) for i in range(3) for t in ("a", "b", "b", "c")]
    first = nodes(prefix_trie.rebuilt_trie(frame_of(spark, tied)))
    assert first == nodes(prefix_trie.rebuilt_trie(frame_of(spark, tied[::-1]).repartition(3)))
    assert max(n[1] for n in first) == 4


def test_one_conversation_of_many_turns_and_many_copies(spark):
    said = {1: [("u", str(i % 5)) for i in range(400)], 2: [("u", str(i % 5)) for i in range(64)],
            3: [("u", str(i % 5)) for i in range(65)], 4: [], 5: [("v", "z")]}
    said |= {100 + i: [("u", "0"), ("u", "1")] for i in range(300)}
    rows = [(c, i, *turn) for c, turns in said.items() for i, turn in enumerate(turns)]
    turns, conversations = prefix_trie.numbered_turns(frame_of(spark, rows))
    every = conversations.unionByName(
        spark.createDataFrame([(4, 0)], "conv_id bigint, length bigint"))
    assert nodes(prefix_trie.trie(turns, stored(every, "all"))) == plain(said)


def test_radix_tree_layouts():
    rng = random.Random(8)
    tree, ends = prefix_trie.RadixTree(), {}
    keys = [bytes([a]) + bytes(rng.randrange(4) for _ in range(rng.randrange(6)))
            for a in range(256) for _ in range(6)] + [b"", b"ab", b"abc", b"abcd" * 9, b"abce"]
    for i, key in enumerate(keys):
        node = tree.insert(key, i)
        assert ends.setdefault(key, node) is node
    for key, node in ends.items():
        assert tree.insert(key, -1) is node
    found = tree.walk()
    paths = {}
    for n, (node, parent, depth) in enumerate(found):
        paths[n] = (paths[parent] if parent >= 0 else b"") + node.label
        assert len(paths[n]) == depth
    assert {paths[n] for n, (node, _, _) in enumerate(found) if node in ends.values()} == set(keys)
    assert tree.root.layout == 256
    layouts = {node.layout for node, _, _ in found}
    assert 4 in layouts and len(list(tree.root.children())) == 256
    # No node but the root, an end or a branch: paths are compressed.
    assert all(node in ends.values() or len(list(node.children())) > 1 for node, _, _ in found[1:])
    for size, layout in ((4, 4), (5, 16), (16, 16), (17, 48), (48, 48), (49, 256)):
        some = prefix_trie.RadixTree()
        for byte in range(size):
            some.insert(bytes([byte, 7]), byte)
        assert some.root.layout == layout
        assert sorted(kid.label[0] for kid in some.root.children()) == list(range(size))


def test_numbers():
    a, b = np.array([3, 1, 3, 1, 3]), np.array([5, 5, 5, 6, 5])
    got = prefix_trie.numbers(a, b)
    assert len(set(got.tolist())) == 3 and got[0] == got[2] == got[4]
