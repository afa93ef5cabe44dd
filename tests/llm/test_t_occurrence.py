"""The Jaccard join: its search, its candidates and the query against all pairs."""

import random

import numpy as np
import pytest
from edges import SF_SMALL, docs, edge_docs, no_docs
from test_near_dups import naive_components

from tallyhouse.llm import queries, t_occurrence
from tallyhouse.llm.common import table


def naive_set(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    return {tuple(words[k:k + 4]) for k in range(max(1, len(words) - 3))} if words else set()


def naive_links(sets):
    """Pairs of names whose sets are linked; equal ones, too."""
    out = set()
    named = sorted(sets.items())
    for k, (a, x) in enumerate(named):
        for b, y in named[k + 1:]:
            if x and y and min(len(x), len(y)) * 100 >= 85 * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= 85 * (len(x) + len(y) - both):
                    out.add((a, b))
    return out


def brute_force(rows):
    """(doc_id, size, component) of each row; rows are told apart by their place."""
    sets = {k: naive_set(t) for k, (_, t) in enumerate(rows)}
    pairs = naive_links(sets)
    root = naive_components(sorted(sets), lambda a, b: (a, b) in pairs)
    ids = {}
    for k, (d, _) in enumerate(rows):
        if sets[k] and d is not None:
            ids[root[k]] = min(d, ids.get(root[k], d))
    return sorted(((d, len(sets[k]), ids.get(root[k]) if sets[k] else d) for k, (d, _) in enumerate(rows)), key=str)


def found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def grown(rng, n_groups, size, words, edits=(0, 3)):
    """Groups of near copies, some near the limit, over common passages."""
    passages = [[rng.choice(words) for _ in range(30)] for _ in range(4)]
    texts = []
    for _ in range(n_groups):
        base = [rng.choice(words) for _ in range(rng.randint(20, 60))] + rng.choice(passages) + rng.choice(passages)
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randint(*edits)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
    return texts


WORDS = [f"w{k}" for k in range(300)]


@pytest.mark.parametrize("every", [True, False])
@pytest.mark.parametrize("across", [True, False])
def test_block_search_by_brute_force(every, across):
    rng = random.Random(5)
    texts = grown(rng, 14, 9, WORDS)
    sets = [naive_set(t) for t in texts]
    number: dict = {}
    held = [(len(s), np.array([number.setdefault(x, len(number)) for x in s], dtype=np.uint64),
             k % 2 if across else None, k) for k, s in enumerate(sets)]
    want = naive_links(dict(enumerate(sets)))
    if across:
        want = {(a, b) for a, b in want if (a + b) % 2}
    got = {tuple(sorted(p)) for p in t_occurrence.search_block(held, every=every)}
    assert want and got <= want
    if every:
        assert got == want
    else:
        nodes = range(len(sets))
        assert naive_components(nodes, lambda a, b: (a, b) in got) == naive_components(nodes, lambda a, b: (a, b) in want)
        assert len(got) < len(nodes)


def test_index_search_finds_all_with_enough():
    rng = random.Random(9)
    index, sets = t_occurrence._Index(), []
    for at in range(300):
        values = rng.sample(range(60), rng.randint(1, 25))
        sets.append(set(values))
        index.add(at, values)
    for _ in range(200):
        asked, t, first = rng.sample(range(60), rng.randint(1, 30)), rng.randint(1, 12), rng.randrange(300)
        got = set()
        for at, count, long in index.search(asked, t, first):
            count += sum(at in x for x in long)
            got |= {at} if count >= t else set()
        assert got == {at for at in range(first, 300) if len(sets[at] & set(asked)) >= t}


def test_query_by_brute_force(spark):
    rows = [tuple(r) for r in table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]
    assert found(queries.op11_jaccard_join(spark, SF_SMALL)) == brute_force(rows)


def test_groups_in_many_blocks(spark):
    rng = random.Random(2)
    texts = grown(rng, 3, 60, WORDS, (0, 4)) + grown(rng, 20, 2, WORDS) + ["same text as the other one"] * 30
    rows = list(enumerate(texts))
    want = brute_force(rows)
    assert 20 < len({c for _, _, c in want}) < 0.6 * len(rows)
    df = docs(spark, texts).repartition(5)
    for size in (t_occurrence.BLOCK_SHINGLES, 1500):
        got = t_occurrence.digests(t_occurrence.jaccard_classes(df, block_shingles=size))
        assert found(got) == want
    keys, some = t_occurrence.sets_and_candidates(df)
    names = {}
    for r in keys.collect():
        names.setdefault(bytes(r.key), r.doc_id)
    every = t_occurrence.links(some, every=True, block_shingles=1500).collect()
    got = {tuple(sorted((names[bytes(r.a)], names[bytes(r.b)]))) for r in every}
    distinct = {d: naive_set(texts[d]) for d in names.values()}
    assert got == naive_links(distinct) and len(got) == len(every)


def test_edges_by_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in edge_docs(spark).collect()]
    assert found(t_occurrence.digests(t_occurrence.jaccard_classes(edge_docs(spark)))) == brute_force(rows)
    assert found(t_occurrence.digests(t_occurrence.jaccard_classes(no_docs(spark)))) == []
