"""SimHash near duplicates against all pairs."""

import random

import pytest
import xxhash
from edges import TEXTS, docs, edge_docs, no_docs

from edges import SF_SMALL
from tallyhouse.llm import near_dups, queries
from tallyhouse.llm.components import components


def naive_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in low + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def naive_components(nodes, linked):
    label = {n: n for n in nodes}

    def root(n):
        while label[n] != n:
            n = label[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return {n: root(n) for n in nodes}


def test_fingerprints_match_spark_hash_and_naive(spark):
    from pyspark.sql import functions as F
    for _, t in TEXTS[:4] + TEXTS[7:]:
        assert near_dups.fingerprint(t) == naive_fingerprint(t)
    assert near_dups.fingerprint("A b C") == spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0] % 2 ** 64


def test_query_by_brute_force(spark):
    import pyarrow.parquet as pq
    texts = pq.read_table(f"{SF_SMALL}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    fps = {r["doc_id"]: naive_fingerprint(r["text"]) for r in texts}
    want = naive_components(sorted(fps), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 2)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op5_near_duplicates(spark, SF_SMALL).collect()}
    assert got == {d: (f"{fps[d]:016x}", want[d]) for d in fps}


@pytest.mark.parametrize("crowd", [2, 5, 32])
def test_links_connect_every_pair_within_two_bits(spark, crowd):
    rng = random.Random(4)
    centre = rng.getrandbits(64)
    fps = {centre}
    for _ in range(150):   # a crowd: few bits from one centre
        x = centre
        for b in rng.sample(range(64), rng.randint(0, 4)):
            x ^= 1 << b
        fps.add(x)
    half = rng.getrandbits(32)
    fps |= {half << 32 | rng.getrandbits(32) for _ in range(60)}      # one half in common
    for _ in range(60):
        x = rng.getrandbits(64)
        fps |= {x, x ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64)}
    fps |= {0, 1, 2 ** 63, 2 ** 63 + 1, 2 ** 64 - 1}
    signed = [f - 2 ** 64 if f >= 2 ** 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    edges = near_dups.links(df, crowd)
    pairs = edges.collect()
    assert all(((r.a ^ r.b) % 2 ** 64).bit_count() <= 2 for r in pairs)
    got = {r.node: r.label for r in components(edges).collect()}
    want = naive_components(sorted(signed), lambda a, b: ((a ^ b) % 2 ** 64).bit_count() <= 2)
    assert {n: got.get(n, n) for n in signed} == want


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k + 1, k) for k in range(200)] + [(1000, 1001), (5, 5)], "a long, b long")
    got = {r.node: r.label for r in components(edges).collect()}
    assert got == {**{k: 0 for k in range(201)}, 1000: 1000, 1001: 1000}


def test_edges(spark):
    rows = near_dups.near_duplicates(edge_docs(spark)).collect()
    assert len(rows) == len(TEXTS)
    by = {r.doc_id: r for r in rows}
    assert by[6].component_id == by[7].component_id == 6
    assert by[1].fp == by[2].fp == by[8].fp == 0 and by[8].component_id == 1
    assert near_dups.near_duplicates(no_docs(spark)).count() == 0


def test_one_of_each_keeps_columns_and_one_row(spark):
    table = edge_docs(spark)
    kept = near_dups.one_of_each(table)
    assert kept.columns == table.columns
    rows = kept.collect()
    ids = sorted(r.doc_id for r in rows if r.doc_id is not None)
    assert ids == [1, 3, 4, 5, 6, 9, 10, 11, 12, 12]
    assert [r.text for r in rows if r.doc_id is None] == ["a row without an id"]
    assert near_dups.one_of_each(no_docs(spark)).count() == 0


def test_copies_are_caught(spark):
    base = " ".join(f"w{i}" for i in range(400))
    near = base.replace("w200 ", "changed ")
    got = {r.doc_id: r.component_id for r in near_dups.near_duplicates(
        docs(spark, [base, base.upper(), base + "\n", near, "something else entirely"], first=10)).collect()}
    assert got[10] == got[11] == got[12] == 10 and got[14] == 14
    close = (naive_fingerprint(base) ^ naive_fingerprint(near)).bit_count() <= 2
    assert (got[13] == 10) == close


def test_tables_with_exploded_rows_are_not_broadcast(spark, monkeypatch):
    # Spark takes the keys of a few fingerprints for as small as these: a broadcast.
    plans = []

    def planned(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    written = near_dups.written
    monkeypatch.setattr(near_dups, "written", lambda df, name: written(planned(df), name))
    fps = spark.range(300).selectExpr("xxhash64(id div 3) ^ shiftleft(1L, cast(id % 3 as int)) as fp")
    assert planned(near_dups.links(written(fps, "fps"), crowd=2)).count()
    assert len(plans) == 2 and all("Join" in p and "BroadcastHashJoin" not in p for p in plans)
