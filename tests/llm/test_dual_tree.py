"""Ranked search: against SQL, against all pairs, and its pruning."""

import math
import random

import duckdb
import numpy as np
from compare import compare
from edges import SF_SMALL, edge_docs, no_docs

from tallyhouse.llm import dual_tree, queries


def naive_terms(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if c >= "\x80" or c.isalnum():
            word += c.lower() if c < "\x80" else c
        else:
            out += [word] if word else []
            word = ""
    return out


def brute_force(docs, items, top=10):
    held = [(d, naive_terms(t)) for d, t in docs]
    n_docs, n_words = sum(bool(t) for _, t in held), sum(len(t) for _, t in held)
    counts = [(d, len(t), {w: t.count(w) for w in set(t)}) for d, t in held]
    df = {}
    for _, _, c in counts:
        for w in c:
            df[w] = df.get(w, 0) + 1
    rows = []
    for item, text in items:
        scored = []
        for d, n, c in counts:
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                    * (1_000_000_000 * c[w] // (1000 * c[w] + 8 * (25 + 75 * n * n_docs // n_words)))
                    for w in naive_terms(text) if w in c)
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        rows += [(item, k, x[3], -x[0]) for k, x in enumerate(sorted(scored, key=lambda x: x[:3])[:top], 1)]
    return sorted(rows, key=str)


def found(df):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()), key=str)


def items_of(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "item_id long, text string, doc_id string, score string")


def test_query_matches_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    ok, message = compare(queries.op12_ranked_search(spark, SF_SMALL), con, queries.ORACLE_SQL["op12_ranked_search"])
    assert ok, message


def test_edges_by_brute_force(spark):
    items = [(1, "tie of texts"), (2, "the same row and the same id"), (2, "the same row and the same id"), (3, None),
             (4, ""), (5, "nobody writes thissss"), (None, "word1 word2 WORD1 some more token"), (7, "ß 日本語 ÉTÉ été"),
             (8, "nul others one" * 3)]
    docs = [(r.doc_id, r.text) for r in edge_docs(spark).collect()]
    assert found(dual_tree.search(edge_docs(spark), items_of(spark, items))) == brute_force(docs, items)
    assert found(dual_tree.search(edge_docs(spark), items_of(spark, items), block_bytes=40)) == brute_force(docs, items)
    assert found(dual_tree.search(no_docs(spark), items_of(spark, items))) == []
    assert found(dual_tree.search(edge_docs(spark), items_of(spark, []))) == []


def test_pruning_is_exact_and_prunes():
    """Documents on topics: most node pairs are passed over, no result changes."""
    rng = random.Random(3)
    topics = [[f"t{k}w{i}" for i in range(30)] for k in range(40)]
    common = [f"c{i}" for i in range(20)]
    docs = [(d, " ".join(rng.choices(topics[d % 40], k=rng.randint(3, 30)) + rng.choices(common, k=20)))
            for d in range(3000)]
    rows = [(i, " ".join(rng.choices(topics[i % 40], k=8) + rng.choices(common, k=4))) for i in range(60)]

    class Row:
        def __init__(self, i, t):
            self.row, self.item_id, self.text = i, i, t

    items = dual_tree.Items([Row(*r) for r in rows])
    held = [dual_tree.terms(t) for _, t in docs]
    n_docs, n_words = len(held), sum(map(len, held))
    coords, df = [], np.zeros(len(items.vocabulary), dtype=np.int64)
    for words in held:
        known = np.array([items.vocabulary[w] for w in words if w in items.vocabulary], dtype=np.int32)
        t, tf = np.unique(known, return_counts=True)
        df[t] += 1
        coords.append((t, dual_tree.contributions(tf.astype(np.int64), dual_tree.length_norm(len(words), n_docs, n_words))))
    weights = np.array([dual_tree.weight(int(x), n_docs) for x in df])
    best = dual_tree.Search(items, weights)
    best.add([d for d, _ in docs[:1500]], coords[:1500], weights)
    best.add([d for d, _ in docs[1500:]], coords[1500:], weights)
    got = best.found(items)
    got = sorted(zip(got["item_id"], got["doc_id"], got["score"], strict=True))
    assert got == sorted((i, d, s) for i, _, d, s in brute_force(docs, rows))
    assert best.pairs < 0.25 * len(docs) * len(rows)
