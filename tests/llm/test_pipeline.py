"""The five stages: each by brute force on its own input, and edges."""

import zlib

import numpy as np
from edges import edge_docs, no_docs
from test_near_dups import naive_components, naive_fingerprint
from test_llm_scans import naive_base, naive_overlap

import corpus_pipeline
from edges import SF_SMALL
from tallyhouse.llm.common import table, written
from tallyhouse.llm.tokens import CachedTokenizer, tokenizer_path


def test_stages_by_brute_force(spark):
    docs = table(spark, SF_SMALL, "documents")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = written(stage(spark, kept[-1], SF_SMALL), name)
        assert out.columns == docs.columns
        kept.append(out)
    rows = [{r.doc_id: r for r in k.collect()} for k in kept]
    labels = {r.doc_id: r.quality for r in table(spark, SF_SMALL, "labels").collect()}
    good = [d for d, q in labels.items() if q == 1 and d in rows[0]]
    assert np.mean([d in rows[1] for d in good]) > 0.97
    bad = [d for d, q in labels.items() if q == 0 and d in rows[0]]
    assert np.mean([d not in rows[1] for d in bad]) > 0.8
    fps = {d: naive_fingerprint(r.text) for d, r in rows[1].items()}
    roots = naive_components(sorted(fps), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 2)
    assert set(rows[2]) == set(roots.values())
    items = [(r.item_id, r.text) for r in table(spark, SF_SMALL, "benchmark").collect()]
    clean = set()
    for d, r in rows[2].items():
        n, hit, _ = naive_overlap(r.text, items)
        if not (hit and 20 * hit >= n):
            clean.add(d)
    assert set(rows[3]) == clean and len(clean) < len(rows[2])
    assert set(rows[4]) == clean
    for d, r in rows[4].items():
        before = rows[3][d]
        assert not naive_base(r.text) and (r.text == before.text) >= (not naive_base(before.text))
        assert r.n_chars == len(r.text)
    pieces = corpus_pipeline.packing(spark, kept[-1], SF_SMALL).collect()
    tok = CachedTokenizer(tokenizer_path("word_bpe_49k.json"))
    assert {p.doc_id for p in pieces} == clean
    for p in pieces:
        ids = tok.plain(rows[4][p.doc_id].text) + b"\2\0\0\0"
        assert p.ids_crc32 == zlib.crc32(ids[4 * p.start:4 * (p.start + p.length)])


def test_stages_bear_edges(spark):
    for source in (edge_docs(spark), no_docs(spark)):
        docs = source
        for name, stage in corpus_pipeline.STAGES:
            out = written(stage(spark, docs, SF_SMALL), name)
            if name != "packing":
                assert out.columns == source.columns
                docs = out
