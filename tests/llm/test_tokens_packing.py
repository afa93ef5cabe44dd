"""Token ids, harmonic packing and the token-id files against brute force."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from edges import TEXTS, edge_docs, no_docs
from hypothesis import given, settings
from hypothesis import strategies as st

from edges import SF_SMALL
from tallyhouse.llm import harmonic, idblocks, queries
from tallyhouse.llm.tokens import CachedTokenizer, tokenizer_path

ODD = ["", " a", "a  b", "a   b c ", "x\n y", "x \n\n y z", "it's a 'tis  'd", "a b c", "<|endoftext|> x <|endoftext|>",
       "é ́ x", "日本 語 a 。b", "A,! b?! c.. 12,3 d", "tab\t a  \tb", "\x00 a \x1c b", "K ſ İx ß", "a,b.c ,d .e", "...",
       "end.\nNext, line\n\nlast."]


@pytest.fixture(scope="module")
def tokenizers():
    return {f: CachedTokenizer(tokenizer_path(f), cache_pieces=40) for f in ("byte_bpe_50k.json", "word_bpe_49k.json")}


def small_texts():
    import pyarrow.parquet as pq
    return pq.read_table(f"{SF_SMALL}/documents.parquet", columns=["doc_id", "text"]).to_pylist()


@pytest.mark.parametrize("vocabulary", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_cached_ids_are_the_librarys(tokenizers, vocabulary):
    t = tokenizers[vocabulary]
    assert t.short
    for text in ODD + [r["text"] for r in small_texts()[:40]]:
        assert t.encode(text) == t.plain(text), text[:80]
    assert t.encode(None) == b""


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="abZé ,.\n\t'!1日 ", max_size=40))
def test_cached_ids_property(text):
    for t in _both():
        assert t.encode(text) == t.plain(text)


def _both(cache={}):
    if not cache:
        cache.update({f: CachedTokenizer(tokenizer_path(f)) for f in ("byte_bpe_50k.json", "word_bpe_49k.json")})
    return cache.values()


@given(st.integers(0, 30_000))
@settings(max_examples=300, deadline=None)
def test_cuts_fill_their_slots(n):
    pieces = harmonic.cut_lengths(n)
    assert sum(pieces) == n and all(0 < p <= 4096 for p in pieces)
    for p in pieces:
        slot = 4096 // (4096 // p)
        assert slot - p <= slot / 64


def check_packing(pieces, tokens, capacity=4096):
    """pieces: (doc, start, length, doc_tokens, sequence, offset) rows."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for d, s, n, total, q, o in pieces:
        by_doc[d].append((s, n))
        by_seq[q].append((o, n))
    padded = 0
    for q, parts in by_seq.items():
        at = 0
        for o, n in sorted(parts):
            assert o == at and n > 0
            at += n
        assert at <= capacity
        padded += 0 if at & (at - 1) == 0 else capacity - at
    assert padded <= 0.016 * sum(tokens.values())
    return by_doc


def test_packing_query_by_brute_force(spark, tokenizers):
    rows = queries.op4_harmonic_packing(spark, SF_SMALL).collect()
    t = tokenizers["word_bpe_49k.json"]
    want = {r["doc_id"]: np.frombuffer(t.plain(r["text"] or "") + b"\2\0\0\0", "<u4") for r in small_texts()}
    by_doc = check_packing([(r.doc_id, r.start, r.length, r.doc_tokens, r.sequence_id, r.offset) for r in rows],
                           {d: len(v) for d, v in want.items()})
    assert set(by_doc) == set(want)
    for d, parts in by_doc.items():
        at = 0
        for s, n in sorted(parts):
            assert s == at
            at += n
        assert at == len(want[d])
    for r in rows:
        assert r.doc_tokens == len(want[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(want[r.doc_id][r.start:r.start + r.length].tobytes())


def test_packing_edges(spark):
    rows = harmonic.pack(edge_docs(spark), harmonic.encode_with_end()).collect()
    assert sum(len(r.ids) // 4 for r in rows if r.doc_id == 3 and r.start == 0) > 0
    t = CachedTokenizer(tokenizer_path("word_bpe_49k.json"))
    want = sum(len(t.plain(x or "")) // 4 + 1 for _, x in TEXTS)
    assert sum(len(r.ids) // 4 for r in rows) == want
    assert harmonic.pack(no_docs(spark), harmonic.encode_with_end()).count() == 0


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 1000, 70_000])
@pytest.mark.parametrize("high", [1, 2, 50_257, 2 ** 40, 2 ** 64])
def test_blocks_round_trip(n, high):
    rng = np.random.default_rng(n)
    v = rng.integers(0, high, n, dtype=np.uint64, endpoint=False) if high < 2 ** 64 else \
        rng.integers(0, 2 ** 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    blocks = idblocks.encode_blocks(v)
    starts = np.cumsum([0] + [len(b) for b in blocks])[:-1]
    if n:
        assert (idblocks.decode_blocks(b"".join(blocks), starts) == v).all()


@given(st.lists(st.integers(0, 2 ** 64 - 1), min_size=1, max_size=300))
@settings(max_examples=100, deadline=None)
def test_blocks_property(values):
    v = np.array(values, dtype=np.uint64)
    blocks = idblocks.encode_blocks(v)
    starts = np.cumsum([0] + [len(b) for b in blocks])[:-1]
    assert idblocks.decode_blocks(b"".join(blocks), starts).tolist() == values


def test_whole_blocks_are_packed_by_words(monkeypatch):
    """Each width's layout, bit by bit; no array of single bits is made for whole blocks."""
    def bits(*_, **__):
        raise AssertionError("bits of a whole block")
    monkeypatch.setattr(np, "unpackbits", bits)
    rng = np.random.default_rng(2)
    for width in range(1, 65):
        v = rng.integers(0, 2 ** width - 1, 3 * idblocks.BLOCK, dtype=np.uint64, endpoint=True)
        v[::idblocks.BLOCK], v[1::idblocks.BLOCK] = 0, np.uint64(2 ** width - 1)
        blocks = idblocks.encode_blocks(v, percentile=1.0)
        for block, part in zip(blocks, v.reshape(-1, idblocks.BLOCK).tolist(), strict=True):
            want = sum(x << k * width for k, x in enumerate(part))
            assert int.from_bytes(block[12:], "little") == want and len(block) == 12 + 16 * width
        starts = np.cumsum([0] + [len(b) for b in blocks])[:-1]
        assert (idblocks.decode_blocks(b"".join(blocks), starts) == v).all()


def test_outliers_stand_in_the_exception_list():
    v = np.array([5] * 120 + [2 ** 30] * 8, dtype=np.uint64)
    (block,) = idblocks.encode_blocks(v)
    head = np.frombuffer(block, idblocks._HEAD, 1)[0]
    assert (head["width"], head["odd"], head["low"]) == (0, 8, 5)


def test_file_seeks_by_block_index(tmp_path):
    fs, root = idblocks.filesystem(f"file://{tmp_path}")
    rng = np.random.default_rng(3)
    docs = [(k * 7 - 50, rng.integers(0, 50_000, rng.integers(0, 900)).astype("<u4")) for k in range(200)]
    w = idblocks.IdFileWriter(fs, f"{root}/a.tidb")
    for at in range(0, 200, 13):
        w.add([(d, v.tobytes()) for d, v in docs[at:at + 13]])
    w.close()
    f = idblocks.IdFile(fs, f"{root}/a.tidb")
    whole = np.concatenate([v for _, v in docs])
    for at, n in ((0, 1), (127, 2), (5000, 700), (len(whole) - 3, 3)):
        assert (f.ids(at, n) == whole[at:at + n]).all()
    assert [(d, v.tolist()) for d, _, v in f.rows(run=1000)] == [(d, v.tolist()) for d, v in docs]


def test_id_files_query_by_brute_force(spark, tokenizers):
    rows = {r.doc_id: r for r in queries.op10_id_files(spark, SF_SMALL).collect()}
    at = 0
    t = tokenizers["byte_bpe_50k.json"]
    for r in sorted(small_texts(), key=lambda r: r["doc_id"]):
        ids = t.plain(r["text"] or "") + b"\2\0\0\0"
        got = rows.pop(r["doc_id"])
        assert (got.start, got.n_tokens, got.ids_crc32) == (at, len(ids) // 4, zlib.crc32(ids))
        at += len(ids) // 4
    assert not rows


def test_id_files_edges(spark):
    encode = harmonic.encode_with_end("byte_bpe_50k.json")
    rows = sorted(idblocks.digests(idblocks.id_files(edge_docs(spark), encode)).collect(), key=lambda r: r.start)
    assert len(rows) == len(TEXTS)
    assert [r.doc_id for r in rows] == sorted((d for d, _ in TEXTS), key=lambda d: (d is not None, d))
    at = 0
    for r in rows:
        assert r.start == at and r.n_tokens >= 1
        at += r.n_tokens
    assert idblocks.id_files(no_docs(spark), encode).count() == 0


def test_ids_are_those_of_a_bare_library_tokenizer():
    from tokenizers import Tokenizer
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        own, bare = CachedTokenizer(tokenizer_path(name)), Tokenizer.from_file(tokenizer_path(name))
        texts = [r["text"] or "" for r in small_texts()[:60]] + ODD
        for text in [*texts, "<|endoftext|> hello", "a <|startoftext|>b", "x<|endoftext|>\n, y. " * 50, "<|ENDOFTEXT|> z"]:
            want = np.array(bare.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
            assert own.encode(text) == want, text[:60]
