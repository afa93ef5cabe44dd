"""The radix tree against a dict, the trie of conversations against plain prefixes."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from edges import SF_SMALL
from tallyhouse.llm import prefix_trie, queries
from tallyhouse.llm.common import table
from tallyhouse.llm.radix_tree import RadixTree


def contents(tree):
    found, walk = {}, [(tree.top, b"")]
    while walk:
        node, path = walk.pop()
        path += node.prefix
        if node.value is not None:
            found[path] = node.value
        kids = list(node.children())
        assert [b for b, _ in kids] == sorted({b for b, _ in kids})
        assert all(node.find(b) is k for b, k in kids)
        assert len(kids) <= node.layout and (node is tree.top or node.value is not None or len(kids) > 1)
        walk += [(k, path + bytes([b])) for b, k in kids]
    return found


@settings(max_examples=60, deadline=None)
@given(st.sets(st.binary(min_size=1, max_size=6) | st.text("ab", min_size=1, max_size=9).map(str.encode), max_size=80))
def test_radix_tree_keeps_all_keys(keys):
    tree = RadixTree()
    for k, key in enumerate(keys):
        tree.insert(key, k + 1)
    assert contents(tree) == {key: k + 1 for k, key in enumerate(keys)}


def test_layouts_grow():
    tree = RadixTree()
    keys = [bytes([b, 7, 7]) for b in range(256)]
    random.Random(4).shuffle(keys)
    for n, key in enumerate(keys, 1):
        tree.insert(key, n)
        assert tree.top.layout == next(size for size in (4, 16, 48, 256) if n <= size)
        assert tree.top.find(key[0]).value == n
    assert len(contents(tree)) == 256
    assert tree.top.find(3) is not None


def brute_force(rows, head=True):
    convs = defaultdict(list)
    for r in rows:
        if r[0] is not None:
            convs[r[0]].append(((r[1] is not None, r[1] or 0), hashlib.md5(
                f"{len(r[2] or '')}:{r[2] or ''}{r[3] or ''}".encode()).digest(), r[2] or "", r[3] or ""))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in convs.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = turns.get(c - int(math.fmod(c, 100)), [])[:h] + own[h:] if head else own
    members, ends = defaultdict(list), defaultdict(list)
    for c, ts in rebuilt.items():
        ends[tuple(ts)].append(c)
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
    kids = defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        own = (len(m) - 1) * len(p[-1][1]) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += kids[p] == 0
            saved[p[:d]] += own
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), kids[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items())


def found(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children,
                   r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect())


SCHEMA = "conv_id long, turn long, role string, text string, depth string, k1 string, head string"


def made(spark, rows):
    return spark.createDataFrame([(*r, "d", "k", "h") for r in rows], SCHEMA)


def trie_of(spark, rows, **options):
    turns = prefix_trie.ordered_turns(made(spark, rows))
    return prefix_trie.digests(prefix_trie.trie(*prefix_trie.with_shared_heads(turns), **options))


def test_query_by_brute_force(spark):
    rows = [tuple(r) for r in table(spark, SF_SMALL, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert found(queries.op13_prefix_trie(spark, SF_SMALL)) == brute_force(rows)


def test_long_hot_and_odd_conversations(spark):
    rng = random.Random(7)
    rows = []
    for c in range(240):                                   # few texts, so deep shared prefixes
        for t in range(rng.choice([0, 1, 2, 5, 6, 9])):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice("ab")))
    for c in (301, 302, 303, 304):                         # long ones that part late
        rows += [(c, t, "user", "long" if t < 70 + 7 * (c % 3) else f"own {c % 2}") for t in range(170)]
    rows += [(c, t, "u", "x") for c in range(400, 470) for t in range(32)]      # copies of a segment's length
    rows += [(500, t, "user", f"hot {t % 3}") for t in range(900)]              # one conversation with most rows
    rows += [(600, None, None, None), (600, None, "user", "null turn"), (600, 3, "user", None), (600, 3, "user", None),
             (None, 1, "user", "nobody's"), (702, 1, "user", "no head"), (-5, 0, "user", "below zero"), (800, 0, "", ""),
             (801, 0, "us", "er"), (802, 0, "user", "")]
    rng.shuffle(rows)
    want = brute_force(rows)
    assert found(trie_of(spark, rows)) == want
    assert found(trie_of(spark, rows, run_bytes=64)) == want


def test_empty_and_turnless(spark):
    assert found(trie_of(spark, [])) == []
    c = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 1)
    rows = [(c, 0, "user", "taken from nobody")]           # its head's conversation is absent
    assert found(trie_of(spark, rows)) == brute_force(rows) == [
        (c, 0, -1, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_last_turns_come_back(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "user", "a")]
    turns = prefix_trie.ordered_turns(made(spark, rows))
    from pyspark.sql import functions as F, Window
    total = turns.withColumn("total", F.count("*").over(Window.partitionBy("conv_id")))
    nodes = prefix_trie.trie(total, total.select("conv_id", "total").distinct())
    got = prefix_trie.with_last_turn(nodes, made(spark, rows))
    assert sorted((r.depth, r.role, r.text, r.n_convs) for r in got.collect() if r.depth) == [
        (1, "user", "a", 2), (2, "assistant", "b", 1)]
