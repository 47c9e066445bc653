"""The prefix trie against plain dictionaries of prefixes."""

import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemill.llm import prefix_trie
from tidemill.llm.prefix_trie import FIRST, LAST, Tree, numbered_turns, prefix_nodes, shard_rows, swept
from tidemill.llm.queries import op11_prefix_trie, open_alike

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain_sequences(rows):
    """(conv, turn, role, text) rows to conversations."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}


def plain_opened(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100 if c >= 0 else c + -c % 100, [])[:h] + turns[h:]
    return out


def plain_nodes(sequences, size=lambda t: len(t[-1])):
    members = {}
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    below = {p: [] for p in members}
    for p in members:
        if p:
            below[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[c] for c in below[p]) or 1
        saved[p] = sum(saved[c] for c in below[p]) + ((len(members[p]) - 1) * size(p[-1]) if p else 0)
    out = []
    for p, cs in members.items():
        ends = ",".join(str(c) for c in sorted(cs) if len(sequences[c]) == len(p))
        out.append((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), len(below[p]), leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def table(spark, rows):
    wide = [(*r, 1, "x", 2) for r in rows]
    return spark.createDataFrame(wide, "conv_id long, turn long, role string, text string, depth int, key string, conv int")


def made(frame):
    assert frame.columns == COLUMNS
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def nodes_of(spark, rows):
    turns = numbered_turns(table(spark, rows))
    opened, conversations = open_alike(turns)
    return made(prefix_nodes(opened, conversations))


def sample(seed, conversations, kinds, longest):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "assistant"][:kinds]), rng.choice("abcé漢")[: rng.randrange(2)] * rng.randrange(4))
            for c in conversations for t in range(rng.randrange(1, longest))]


@pytest.mark.parametrize("turns", [7, 200_000])
def test_rebuilt_conversations(spark, monkeypatch, turns):
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", turns)  # many shards, so that nodes go on from one to the next
    rows = sample(1, [*range(0, 140), *range(250, 320), -5, -100, 10**15], 2, 9)
    rows += [(900 + i, t, "user", "hot") for i in range(99) for t in range(i % 3 + 5)]
    rows += [(900 + i, 99, None, None) for i in range(0, 99, 5)] + [(3, None, "user", None), (3, None, "user", "x"), (3, 1, "user", "x")]
    rows += [(None, 1, "user", "lost")]
    random.Random(2).shuffle(rows)
    assert nodes_of(spark, rows) == plain_nodes(plain_opened(plain_sequences(rows)))


def test_no_conversations_and_no_turns(spark):
    assert nodes_of(spark, []) == []
    turns = numbered_turns(table(spark, []))
    alone = made(prefix_nodes(turns, spark.createDataFrame([(7,), (3,)], "conv long")))
    assert alone == [(3, 0, None, 2, 0, 1, 0, hashlib.sha256(b"3,7").hexdigest())]


def test_null_keys(spark):
    turns = spark.createDataFrame([(1, 1, None, None), (2, 1, None, None), (3, 1, b"k", 4)], "conv long, pos long, key binary, size long")
    got = made(prefix_nodes(turns, turns.select("conv")))
    assert [(r[0], r[1], r[3], r[6]) for r in got] == [(1, 0, 3, 0), (1, 1, 2, 0), (3, 1, 1, 0)]


def test_long_conversations_and_texts(spark):
    rows = [(c, t, "user", f"turn {t}") for c in (1, 2, 3) for t in range(3000)] + [(4, 0, "user", "x" * 1_000_000), (5, 0, "user", "x" * 1_000_000)]
    turns = numbered_turns(table(spark, rows))
    got = made(prefix_nodes(turns, turns.select("conv").distinct()))
    assert got == plain_nodes(plain_sequences(rows))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=5), min_size=1, max_size=30), st.lists(st.integers(0, 30), max_size=6))
def test_any_shards(sequences, cuts):
    """Shards cut anywhere in the order, also between equal sequences."""
    by_conv = dict(enumerate(sequences))
    ordered = sorted((s, c) for c, s in by_conv.items())
    edges = sorted({0, len(ordered), *[c for c in cuts if c < len(ordered)]})
    built = []
    for shard, (a, b) in enumerate(zip(edges, edges[1:])):
        distinct = []
        for s, c in ordered[a:b]:
            if not distinct or distinct[-1][0] != s:
                distinct.append((s, [t + 1 for t in s], []))
            distinct[-1][2].append(c)
        built += shard_rows(shard, distinct)
    names = [f.split()[0] for f in prefix_trie._SHARD.split(", ")]
    rows = [dict(zip(names, r)) for r in built]
    paths = sorted((r for r in rows if r["side"] is not None), key=lambda r: (r["shard"], r["side"], r["depth"]))
    names = [f.split()[0] for f in prefix_trie._SWEPT.split(", ")]
    out = [dict(zip(names, r)) for r in swept(paths)]
    finished = {(r["node_shard"], r["node_side"], r["depth"]): r for r in out if r["n_convs"] is not None}
    place = {(r["shard"], r["side"], r["depth"]): (r["node_shard"], r["node_side"], r["depth"]) for r in out if r["n_convs"] is None}
    got = []
    for r in finished.values():
        up = finished.get((r["up_shard"], r["up_side"], r["depth"] - 1))
        got.append((r["conv"], r["depth"], up and up["conv"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved"], r["ends"]))
    for r in rows:
        if r["side"] is None:
            up = r["up_conv"]
            if r["up_side"] is not None:
                up = finished[place[r["shard"], r["up_side"], r["depth"] - 1]]["conv"]
            got.append((r["conv"], r["depth"], up, r["n_convs"], r["n_children"], r["n_leaves"], r["saved"], r["ends"]))
    assert sorted(got, key=repr) == plain_nodes(by_conv, size=lambda t: t + 1)


def test_search_tree_is_balanced_and_sorted():
    tree = Tree.balanced([([i], [0], [i]) for i in range(4096)])
    depth, deepest, todo = 0, 0, [(tree.middle[0], 1)]
    while todo:
        node, depth = todo.pop()
        deepest = max(deepest, depth)
        todo += [(x, depth + 1) for x in (tree.low[node], tree.high[node]) if x >= 0]
    assert deepest <= 13
    assert [tree.turn[n] for n in tree.walk()] == [-1, *range(4096)]
    assert FIRST < LAST


def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert made(op11_prefix_trie(spark, sf)) == plain_nodes(plain_opened(plain_sequences(rows)))
