"""Quality classifier and masked language model: held-out results and edges."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from edges import TEXTS, docs, edge_docs, no_docs

from edges import SF_MID
from tallyhouse.llm import masked_lm, quality_model, queries


def auc(scores, labels):
    order = np.argsort(np.argsort(scores)) + 1
    ones = sum(labels)
    return (sum(o for o, y in zip(order, labels, strict=True) if y) - ones * (ones + 1) / 2) / (ones * (len(labels) - ones))


def test_quality_query_on_the_held_out_fold(spark):
    rows = {r.doc_id: r for r in queries.op2_quality(spark, SF_MID).collect()}
    texts = pq.read_table(f"{SF_MID}/documents.parquet", columns=["doc_id"]).to_pylist()
    assert len(rows) == len(texts)
    for d, r in rows.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    held = [(rows[x["doc_id"]], x["quality"]) for x in pq.read_table(f"{SF_MID}/labels.parquet").to_pylist()
            if rows[x["doc_id"]].held_out]
    assert auc([r.score for r, _ in held], [y for _, y in held]) > 0.97
    assert np.mean([r.predicted == y for r, y in held]) > 0.95


def test_features_are_words_and_grams_inside_them():
    one = np.concatenate(list(quality_model.features("ab cd")))
    two = np.concatenate(list(quality_model.features("cd\n ab")))
    assert sorted(one) == sorted(two) and len(one) == 2 + 4 + 2   # words, " ab" "ab " ..., " ab "
    assert list(quality_model.features(None)) == [] and list(quality_model.features("")) == []
    once, twice = (np.concatenate(list(quality_model.features(t))) for t in ("x1 yy", "x1 x1 yy yy"))
    mark = quality_model._buckets(np.array([quality_model._AGAIN]), 1)[0]
    assert mark not in once and list(twice).count(mark) == 2


def test_long_texts_are_cut_at_white_space(monkeypatch):
    text = " ".join(f"w{i}" for i in range(500))
    whole = np.sort(np.concatenate(list(quality_model.features(text))))
    monkeypatch.setattr(quality_model, "_RUN", 100)
    assert (np.sort(np.concatenate(list(quality_model.features(text)))) == whole).all()


def test_held_out_labels_are_never_learnt(spark):
    fold = [d for d in range(400) if zlib.crc32(str(d).encode()) % 4 == 2]
    rest = [d for d in range(400) if d not in set(fold)]
    texts = {d: ("good text here" if d % 2 else "bad junk there") + f" {d}" for d in range(400)}
    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    labels = lambda wrong: spark.createDataFrame(
        [(d, d % 2) for d in rest] + [(d, (d + wrong) % 2) for d in fold] + [(None, 1), (1, None), (3, 7)],
        "doc_id long, quality int")
    a, b = quality_model.fit(table, labels(0)), quality_model.fit(table, labels(1))
    assert (a == b).all()


def test_quality_edges(spark):
    table = edge_docs(spark)
    labels = spark.createDataFrame([(3, 1), (9, 0), (77, 1)], "doc_id long, quality int")
    margins = quality_model.fit(table, labels)
    scored = quality_model.score(table, margins)
    assert scored.columns == [c for c in table.columns if c != "score"] + ["score"]
    by = {r.doc_id: r.score for r in scored.collect()}
    assert len(scored.collect()) == len(TEXTS) and by[1] == by[2] == by[8]
    assert quality_model.score(no_docs(spark), margins).count() == 0
    assert len(quality_model.fit(no_docs(spark), labels.limit(0))) == (1 << quality_model.BITS) + 1


def test_language_model_learns_the_corpus(spark):
    rng = random.Random(6)
    nouns, verbs = [f"noun{i}" for i in range(30)], [f"verb{i}" for i in range(30)]
    texts = [" ".join(f"the {rng.choice(nouns)} will {rng.choice(verbs)} it ." for _ in range(60)) for _ in range(300)]
    table = docs(spark, texts)
    number, network = masked_lm.fit(table)
    score = lambda t: masked_lm.pseudo_likelihood(masked_lm.split(t), number, network)
    before = masked_lm.pseudo_likelihood(masked_lm.split(texts[0]), number, masked_lm.Network.start())
    assert score(texts[0]) > before / 2
    for t in texts[:20]:
        mixed = t.split()
        rng.shuffle(mixed)
        assert score(t) > score(" ".join(mixed))
    got = {r.doc_id: r.log_likelihood for r in masked_lm.score(table, number, network).collect()}
    assert all(abs(got[k] - score(t)) < 1e-2 for k, t in enumerate(texts[:30]))


def test_probabilities_sum_to_one():
    net = masked_lm.Network.start()
    around = np.full((masked_lm.VOCABULARY, 2 * masked_lm.WINDOW), 5)
    logs = net.log_probabilities(np.arange(masked_lm.VOCABULARY), around)
    assert abs(np.exp(logs.astype(float)).sum() - 1) < 1e-3


def test_gradient_step_raises_the_likelihood():
    net, used = masked_lm.Network.start(), np.zeros(masked_lm.Network.ROWS, dtype=np.float32)
    rng = np.random.default_rng(0)
    tokens, around = rng.integers(0, 50, 256), rng.integers(0, 50, (256, 4))
    before = net.log_probabilities(tokens, around).sum()
    for _ in range(5):
        net.learn(tokens, around, 0.1, used)
    assert net.log_probabilities(tokens, around).sum() > before and used.sum() > 0


def test_language_model_edges(spark):
    rows = masked_lm.score_corpus(edge_docs(spark)).collect()
    assert len(rows) == len(TEXTS)
    by = {r.doc_id: r for r in rows}
    for d in (1, 2, 8):
        assert (by[d].n_tokens, by[d].log_likelihood, by[d].mean_log_likelihood) == (0, 0.0, None)
    assert by[4].n_tokens == 40_000 * 4 + 3 and by[4].log_likelihood < 0
    assert masked_lm.score_corpus(no_docs(spark)).count() == 0


def test_vocabulary_is_the_most_frequent_words(spark):
    rng = random.Random(3)
    texts = [" ".join(f"w{int(rng.paretovariate(0.6)) % 900}" for _ in range(300)) for _ in range(40)]
    number = masked_lm.vocabulary(docs(spark, texts), size=34)
    counts = {}
    for t in texts:
        for w in t.encode().split():
            counts[w] = counts.get(w, 0) + 1
    want = sorted(counts, key=lambda w: (-counts[w], w))[:32]
    assert len(counts) > 8 * 34 and number == {w: k + 2 for k, w in enumerate(want)}


def test_every_word_has_its_own_tokens(spark):
    # Rare words are told apart, as targets and as neighbours.
    common = " ".join(f"w{i}" for i in range(masked_lm.WORDS))
    table = docs(spark, [common, common, "zebra zebu " + "x" * 300, "été 日本語"])
    number, network = masked_lm.fit(table)
    assert len(number.words) == masked_lm.WORDS - 2
    rare = [b"zebra", b"zebu", "日本語".encode(), b"zebraa", b"\xff\x00", b"x" * 300]
    spelled = [tuple(number.tokens([w])[0]) for w in rare]
    assert len(set(spelled)) == len(rare) and all(min(t) >= masked_lm.WORDS for t in spelled)
    text = {k: p for p, k in number.pieces.items()}
    for w, t in zip(rare, spelled, strict=True):
        assert b"".join(text[(k - masked_lm.WORDS) // 2] for k in t) == w and [k % 2 for k in t] == [0] * (len(t) - 1) + [1]
    score = lambda t: masked_lm.pseudo_likelihood(masked_lm.split(t), number, network)
    assert len({score(f"w1 {w} w2") for w in ("zebra", "zebu", "qqqq", "日本")}) == 4
    assert score("w5 zebra w6") - score("w5 zebu w6") != score("zebra w5 w6") - score("zebu w5 w6")


def test_the_rest_of_a_word_is_hidden():
    ids, ends = np.array([10, 21, 22, 23, 30, 31]), np.array([1, 4, 4, 4, 5, 6])
    assert masked_lm.places(ids, ends).tolist() == [[1, 1, 21, 22], [1, 10, 30, 31], [10, 21, 30, 31], [21, 22, 30, 31],
                                                    [22, 23, 31, 1], [23, 30, 1, 1]]


def test_every_place_is_a_target_once(spark):
    for n in (0, 1, 20, 5000):
        words = [b"w%d" % i for i in range(n)]
        drawn = np.concatenate([masked_lm.round_places(words, n, k) for k in range(masked_lm.ROUNDS)])
        assert sorted(drawn) == list(range(n))
    # So in one short document every word is learnt as a left and as a right neighbour.
    words = [f"v{i}" for i in range(60)]
    number, network = masked_lm.fit(docs(spark, [" ".join(words)]))
    ids = np.array([number.words[w.encode()] for w in words])
    moved = (network.rows != masked_lm.Network.start().rows).any(axis=1)
    assert moved[masked_lm.VOCABULARY + ids[:-1]].all() and moved[2 * masked_lm.VOCABULARY + ids[1:]].all()


def test_documents_are_spelled_once_and_steps_are_the_plain_ones(spark, monkeypatch):
    # The rounds and the scores read token numbers; no step spells words again.
    rng = random.Random(8)
    texts = [None, "", *(" ".join(rng.choice(["the", "of", f"w{rng.random():.3f}", "Straße"]) for _ in range(rng.randrange(1, 80)))
                         for _ in range(60))]
    calls, spell = [], masked_lm.spell
    monkeypatch.setattr(masked_lm, "spell", lambda *a: calls.append(a) or spell(*a))
    scored = {r.doc_id: r for r in masked_lm.score_corpus(docs(spark, texts)).collect()}
    assert len(calls) == 1 and len(scored) == len(texts)
    number = calls[0][1]
    for r in spell(docs(spark, texts), number).collect():
        words = masked_lm.split(texts[r.doc_id])
        assert np.frombuffer(r.ids, "<u2").tolist() == number.tokens(words)[0].tolist()
        assert r.checksum == zlib.crc32(b" ".join(words)) and scored[r.doc_id].n_tokens == len(words)
    # A step against the gradient of each row by itself.
    draw, n, size = np.random.default_rng(4), 300, masked_lm.CLASSES
    tokens, around = np.minimum(draw.zipf(1.3, n) + 1, masked_lm.VOCABULARY - 1), draw.integers(0, 40, (n, 4)) ** 2
    net, used = masked_lm.Network.start(), np.zeros(masked_lm.Network.ROWS, dtype=np.float32)
    before = net.rows.astype(np.float64)
    net.learn(tokens, around, 0.2, used)
    change, times = np.zeros_like(before), np.zeros(masked_lm.Network.ROWS)
    for t, a in zip(tokens, net.inputs(around), strict=True):
        h = np.append(np.tanh(before[a, :-1].sum(axis=0)), 1)
        back = 0
        for at, target in ((net.KINDS, t // size), (net.TOKENS + t // size * size, t % size)):
            rows = before[at:at + size]
            g = np.exp(rows @ h) / np.exp(rows @ h).sum() - (np.arange(size) == target)
            change[at:at + size] += g[:, None] * h
            times[at:at + size] += 1
            back = back + g @ rows
        change[a, :-1] += np.clip(back * (1 - h * h), -1, 1)[:-1]
        times[a] += 1
    assert (used == times).all()
    assert np.abs(before - 0.2 * change / np.sqrt(np.maximum(times, 1))[:, None] - net.rows).max() < 1e-5


def test_pieces_count_every_substring(spark, monkeypatch):
    rng = random.Random(9)
    counted = {bytes(rng.choice(b"abcd\xff\x00") for _ in range(rng.randrange(1, 30))): rng.randrange(1, 50) for _ in range(200)}
    counted[b"xy" * 70_000] = 3
    want = {}
    for w, n in counted.items():
        for size in range(2, masked_lm.LONGEST + 1):
            for k in range(len(w) - size + 1):
                want[w[k:k + size]] = want.get(w[k:k + size], 0) + n * (size - 1)
    monkeypatch.setattr(masked_lm, "_GATHERED", 1000)
    found = []
    summed = masked_lm._summed
    monkeypatch.setattr(masked_lm, "_summed", lambda *a: found.append(summed(*a)) or found[0])
    masked_lm.pieces(spark.createDataFrame([(bytearray(w), n) for w, n in counted.items()], "word binary, n long"), {})
    assert {bytes(r.word): r.n for r in found[0].collect()} == want


def test_words_are_spelled_at_once_as_one_by_one(monkeypatch):
    draw = random.Random(12)
    found = [bytes(draw.choice(b"abc\xff\x00") for _ in range(draw.randrange(2, masked_lm.LONGEST + 1))) for _ in range(80)]
    pieces = {p: k for k, p in enumerate(dict.fromkeys([*(bytes([c]) for c in range(256)), *found]))}
    texts = [[bytes(draw.choice(b"abcd\xff\x00") for _ in range(draw.choice([1, 2, 5, 9, 64, 65, 300]))) for _ in range(n)]
             for n in (0, 1, 7, 40, 200)]
    number = masked_lm.Spelling({w: k + 2 for k, w in enumerate(texts[3][:5])}, pieces)
    one = lambda w: number.words[w].to_bytes(2, "little") if w in number.words else number.cut(w)
    words = [w for t in texts for w in t]
    assert number.cut_all(words) == [number.cut(w) for w in words]
    monkeypatch.setattr(masked_lm, "_KNOWN", 20)      # generations end within and between texts
    for _ in range(3):
        assert [number.spell(t) for t in texts] == [b"".join(map(one, t)) for t in texts]
        lists = pa.array([*texts[:2], None, *texts[2:]], pa.list_(pa.binary()))
        assert number.spell_lists(lists).to_pylist() == [b"".join(map(one, t)) for t in [*texts[:2], [], *texts[2:]]]
        assert all(len(w) <= 64 or w in number.words for w in number.young)


def test_words_of_a_column_are_those_of_each_text(spark):
    draw = random.Random(13)
    texts = [None, "", " \t\n", "\x0b\x0c\r a", "A\u00a0B \u2003 É\x1c\x85x\x00Y ", *("".join(draw.choice("aB \t\r\n\x0b\x0c\x1fÄ日") for _ in range(30)) for _ in range(200))]
    want = [masked_lm.split(t) for t in texts]
    found = masked_lm._words(pa.array(texts))
    assert [[w.encode() for w in t or []] for t in found.to_pylist()] == want
    assert masked_lm._words(pa.array([b"a \xff\xfeB"], pa.binary()).view(pa.string())).flatten().cast(pa.binary()).to_pylist() == [b"a", b"\xff\xfeb"]
    counts = {bytes(r.word): r.n for r in masked_lm.word_counts(docs(spark, texts)).collect()}
    every = [w for t in want for w in t]
    assert counts == {w: every.count(w) for w in every}


def test_documents_scored_together_are_scored_alone(monkeypatch):
    monkeypatch.setattr(masked_lm, "_RUN", 1 << 13)   # some are longer
    draw = np.random.default_rng(6)
    net = masked_lm.Network(masked_lm.Network.start().rows * 8)
    ids = [draw.integers(1, masked_lm.VOCABULARY, n) for n in (0, 1, 3, 900, 0, 7000, 9000, 20_000, 2)]
    for i in ids:
        i[-1:] = 5                                    # a word's last token
    sizes, sums = masked_lm._sums([i.astype("<u2").tobytes() for i in ids], net)
    assert sizes == [int(masked_lm._last(i).sum()) for i in ids]
    for i, total in zip(ids, sums, strict=True):
        around = masked_lm.places(i, masked_lm.word_ends(i)).astype(int)
        h = np.tanh(net.rows[net.inputs(around)].astype(float)[:, :, :-1].sum(axis=1))
        want = 0.0
        for at, target in ((np.full(len(i), net.KINDS), i // masked_lm.CLASSES),
                           (net.TOKENS + i // masked_lm.CLASSES * masked_lm.CLASSES, i % masked_lm.CLASSES)):
            rows = net.rows[at[:, None] + np.arange(masked_lm.CLASSES)]
            z = np.einsum("nkd,nd->nk", rows[:, :, :-1], h) + rows[:, :, -1]
            want += float((z[np.arange(len(i)), target] - np.log(np.exp(z).sum(axis=1))).sum())
        assert abs(total - want) <= 1e-5 * abs(want)


def test_classes_are_filled_up_a_little():
    draw = np.random.default_rng(2)
    for n in (draw.poisson(draw.gamma(0.3, 40, masked_lm.CLASSES)), np.zeros(masked_lm.CLASSES, int), np.eye(masked_lm.CLASSES, dtype=int)[7] * 1024):
        runs = masked_lm._runs(n.tolist())
        held = [c for first, last, _ in runs for c in range(first, last)]
        assert len(set(held)) == len(held) and set(np.flatnonzero(n)) <= set(held)
        for first, last, most in runs:
            assert most == max(n[first:last]) and most * (last - first) - n[first:last].sum() <= masked_lm._SPARE
