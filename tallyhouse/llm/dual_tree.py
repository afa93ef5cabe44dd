"""Ranked lexical search of items in documents, by two trees that are walked together.

Items (queries) come in blocks of bounded size; a block goes to all tasks.  A
first pass over the texts keeps, of each document, its number of terms and the
items' terms that it holds; from this small table come the document frequencies,
and then the scores.

In a task, documents are put into trees: leaves of a few similar documents, each
node with the maximum of every coordinate (a term's contribution) below it.  The
items form one tree likewise, with the maxima of their term weights.  The product
of two nodes' maxima bounds every score between their items and documents.  If it
is below the weakest k-th score that the node's items have so far, the whole pair
is passed over; this loses nothing.  All arithmetic is in 64-bit integers.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import map_batches, written

TOP = 10
# The score's constants.
WEIGHT_SCALE, TF_SCALE, TF_FACTOR, LENGTH_FACTOR, LENGTH_SHARE = 1000, 1_000_000_000, 1000, 8, 75
BLOCK_BYTES = 4 << 20        # texts of the items that are searched at once
TREE_DOCS = 4096             # documents of one tree
TREE_ENTRIES = 2_000_000     # coordinates of one tree
LEAF_DOCS, DOC_FANOUT = 32, 8
LEAF_ITEMS, ITEM_FANOUT = 8, 4

_KEPT = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("term", pa.binary()), ("tf", pa.binary())])
# Letters and digits of ASCII, small, and all bytes of other characters; the rest parts terms.
_TERM_BYTES = bytes(b if b >= 128 or chr(b).isalnum() and not 65 <= b <= 90 else b + 32 if 65 <= b <= 90 else 32
                    for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """The terms of a whole text, A-Z as a-z (null: none)."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split()


# --- items -----------------------------------------------------------------------

def item_blocks(items: DataFrame, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int]:
    """The items dealt evenly to blocks of about ``block_bytes`` of text, written as a
    table (``row, item_id, text``; the block is row's upper bits), and their number."""
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(size / block_bytes))
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return written(rows.repartition(n).select(F.monotonically_increasing_id().alias("row"), "item_id", "text"), "items"), n


class Items:
    """A block's items: their terms as numbers, counted (rows without terms are left out)."""

    def __init__(self, rows: list):
        self.vocabulary: dict[bytes, int] = {}
        self.rows, self.ids, self.terms, self.counts = [], [], [], []
        for r in rows:
            held: dict[int, int] = {}
            for t in terms(r.text):
                k = self.vocabulary.setdefault(t, len(self.vocabulary))
                held[k] = held.get(k, 0) + 1
            if held:
                self.rows.append(r.row)
                self.ids.append(r.item_id)
                self.terms.append(np.array(sorted(held), dtype=np.int64))
                self.counts.append(np.array([held[k] for k in sorted(held)], dtype=np.int64))


class ItemTree:
    """Levels of item nodes, the finest first; a level has its nodes' terms, the
    maxima of their weights, and the range of its children in the level below."""

    def __init__(self, items: Items, weights: np.ndarray, leaf: int = LEAF_ITEMS, fanout: int = ITEM_FANOUT):
        vectors = [(t, weights[t] * c) for t, c in zip(items.terms, items.counts, strict=True)]
        # Items whose heaviest terms are the same stand side by side.
        self.order = sorted(range(len(vectors)), key=lambda i: (int(vectors[i][0][vectors[i][1].argmax()]), i))
        level = [vectors[i] for i in self.order]
        self.levels = [self._flat(level)]
        self.spans: list[np.ndarray] = []                  # of level k + 1 in level k
        size = leaf
        while len(level) > 1:
            cuts = list(range(0, len(level), size))
            self.spans.append(np.array(cuts + [len(level)]))
            level = [_maxima([v[0] for v in level[a:a + size]], [v[1] for v in level[a:a + size]]) for a in cuts]
            self.levels.append(self._flat(level))
            size = fanout

    @staticmethod
    def _flat(vectors: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        starts = np.concatenate([[0], np.cumsum([len(t) for t, _ in vectors])])
        return np.concatenate([t for t, _ in vectors]), np.concatenate([q for _, q in vectors]), starts

    def chosen(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Terms, weights and starts of some nodes."""
        t, q, starts = self.levels[level]
        if len(nodes) == len(starts) - 1:
            return t, q, starts[:-1]
        at = ranges(starts[nodes], starts[nodes + 1])
        return t[at], q[at], np.concatenate([[0], np.cumsum(starts[nodes + 1] - starts[nodes])[:-1]])

    def below(self, level: int, nodes: np.ndarray) -> np.ndarray:
        return ranges(self.spans[level - 1][nodes], self.spans[level - 1][nodes + 1])


def ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All numbers from each start to its end."""
    n = ends - starts
    return np.repeat(starts - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())


def _maxima(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with their largest value."""
    k, v = np.concatenate(keys), np.concatenate(values)
    order = k.argsort(kind="stable")
    k, v = k[order], v[order]
    starts = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.array([], dtype=np.int64)
    return k[starts], np.maximum.reduceat(v, starts) if len(k) else v


# --- documents --------------------------------------------------------------------

class Search:
    """The best documents of a block's items, over all trees of a task."""

    def __init__(self, items: Items, weights: np.ndarray, top: int = TOP):
        self.tree = ItemTree(items, weights)
        n = len(items.ids)
        self.top = top
        self.score = np.zeros((n, top), dtype=np.int64)
        self.doc = np.zeros((n, top), dtype=np.int64)
        self.nameless = np.ones((n, top), dtype=bool)
        self.dense = np.zeros(len(items.vocabulary), dtype=np.int64)
        self.pairs = 0                                     # item-document pairs that were scored

    def weakest(self, level: int) -> np.ndarray:
        """The smallest k-th score of the items below each node (0: fewer than k)."""
        low = self.score[:, -1]
        for spans in self.tree.spans[:level]:
            low = np.minimum.reduceat(low, spans[:-1])
        return low

    def add(self, ids: list, coords: list[tuple[np.ndarray, np.ndarray]], weights: np.ndarray) -> None:
        """Walks a tree of documents; coords are (terms, contributions) of each."""
        heavy = [int(t[(c * weights[t]).argmax()]) for t, c in coords]
        order = sorted(range(len(ids)), key=heavy.__getitem__)
        nodes = []
        for a in range(0, len(order), LEAF_DOCS):
            docs = order[a:a + LEAF_DOCS]
            nodes.append((*_maxima([coords[d][0] for d in docs], [coords[d][1] for d in docs]), docs, None))
        while len(nodes) > 1:
            nodes = [(*_maxima([n[0] for n in nodes[a:a + DOC_FANOUT]], [n[1] for n in nodes[a:a + DOC_FANOUT]]), None,
                      nodes[a:a + DOC_FANOUT]) for a in range(0, len(nodes), DOC_FANOUT)]
        level = len(self.tree.levels) - 1
        start = np.arange(len(self.tree.levels[level][2]) - 1)
        walk = [(nodes[0], level, start, self._bounds(nodes[0], level, start))]
        while walk:
            node, level, active, bounds = walk.pop()
            keep = (bounds > 0) & (bounds >= self.weakest(level)[active])
            active = active[keep]
            if not len(active):
                continue
            if node[3] is None:
                while level:
                    active = self.tree.below(level, active)
                    level -= 1
                    bounds = self._bounds(node, level, active)
                    active = active[(bounds > 0) & (bounds >= self.weakest(level)[active])]
                    if not len(active):
                        break
                if len(active):
                    self._score(node[2], ids, coords, active)
                continue
            if level:
                active, level = self.tree.below(level, active), level - 1
            near = [(kid, level, active, self._bounds(kid, level, active)) for kid in node[3]]
            walk += sorted(near, key=lambda x: int(x[3].sum()))     # the most promising is taken next

    def _bounds(self, node: tuple, level: int, items: np.ndarray) -> np.ndarray:
        t, q, starts = self.tree.chosen(level, items)
        self.dense[node[0]] = node[1]
        bounds = np.add.reduceat(q * self.dense[t], starts)
        self.dense[node[0]] = 0
        return bounds

    def _score(self, docs: list[int], ids: list, coords: list, active: np.ndarray) -> None:
        t, q, starts = self.tree.chosen(0, active)
        self.pairs += len(active) * len(docs)
        scores = np.empty((len(active), len(docs)), dtype=np.int64)
        for k, d in enumerate(docs):
            self.dense[coords[d][0]] = coords[d][1]
            scores[:, k] = np.add.reduceat(q * self.dense[t], starts)
            self.dense[coords[d][0]] = 0
        rows = np.flatnonzero((scores >= np.maximum(self.score[active, -1], 1)[:, None]).any(axis=1))
        if not len(rows):
            return
        which = active[rows]
        doc = np.array([0 if ids[d] is None else ids[d] for d in docs], dtype=np.int64)
        none = np.array([ids[d] is None for d in docs])
        score = np.concatenate([self.score[which], scores[rows]], axis=1)
        doc = np.concatenate([self.doc[which], np.broadcast_to(doc, (len(rows), len(docs)))], axis=1)
        none = np.concatenate([self.nameless[which], np.broadcast_to(none, (len(rows), len(docs)))], axis=1)
        best = np.lexsort((doc, none, -score), axis=1)[:, :self.top]
        self.score[which] = np.take_along_axis(score, best, 1)
        self.doc[which] = np.take_along_axis(doc, best, 1)
        self.nameless[which] = np.take_along_axis(none, best, 1)

    def found(self, items: Items) -> dict[str, list]:
        """row, item_id, doc_id, score of all that was kept."""
        at, k = np.nonzero(self.score > 0)
        which = [self.tree.order[i] for i in at.tolist()]
        docs = [None if x else d for d, x in zip(self.doc[at, k].tolist(), self.nameless[at, k].tolist(), strict=True)]
        return {"row": [items.rows[i] for i in which], "item_id": [items.ids[i] for i in which], "doc_id": docs,
                "score": self.score[at, k].tolist()}


def contributions(tf: np.ndarray, m: int) -> np.ndarray:
    """(10^9 tf) div (1000 tf + 8 m)."""
    return TF_SCALE * tf // (TF_FACTOR * tf + LENGTH_FACTOR * m)


def length_norm(n: int, docs: int, terms_: int) -> int:
    return 100 - LENGTH_SHARE + LENGTH_SHARE * n * docs // terms_


def weight(df: int, docs: int) -> int:
    return math.floor(WEIGHT_SCALE * math.log((2 * docs + 2) / (2 * df + 1)))


def _search_block(docs: DataFrame, items: Items, top: int) -> DataFrame:
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast(items)                           # bounded by BLOCK_BYTES

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.vocabulary.get
        for b in batches:
            n, held, tfs = [], [], []
            for text in b.column(1):
                words = terms(text.as_py())
                n.append(len(words))
                known = np.array([k for k in map(number, words) if k is not None], dtype=np.int32)
                t, tf = np.unique(known, return_counts=True)
                held.append(t.tobytes())
                tfs.append(tf.astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(held, pa.binary()),
                                              pa.array(tfs, pa.binary())], schema=_KEPT)

    def frequencies(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, docs_, words = np.zeros(len(shared.value.vocabulary), dtype=np.int64), 0, 0
        for b in batches:
            n = b.column(0).to_numpy()
            docs_ += int((n > 0).sum())
            words += int(n.sum())
            df += np.bincount(np.frombuffer(b"".join(b.column(1).to_pylist()), dtype=np.int32), minlength=len(df))
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([[-2, -1], some]).astype(np.int64)),
             pa.array(np.concatenate([[docs_, words], df[some]]).astype(np.int64))], names=["term", "n"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    kept = written(map_batches(rows, keep, "doc_id long, n long, term binary, tf binary"), "item-terms")
    # One row for each distinct term of the block, and two.
    counted = {r.term: r.n for r in map_batches(kept.select("n", "term"), frequencies, "term long, n long", rows=4096)
               .groupBy("term").agg(F.sum("n").alias("n")).collect()}
    n_docs, n_words = counted.pop(-2, 0), counted.pop(-1, 0)
    weights = np.zeros(len(items.vocabulary), dtype=np.int64)
    for t, df in counted.items():
        weights[t] = weight(df, n_docs)
    weigh = sc.broadcast(weights)
    out = pa.schema([("row", pa.int64()), ("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, w = shared.value, weigh.value
        best = Search(block, w, top)
        ids: list = []
        coords: list = []
        entries = 0
        for b in batches:
            for doc, n, t, tf in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                if t:
                    tf = np.frombuffer(tf, dtype=np.int32).astype(np.int64)
                    coords.append((np.frombuffer(t, dtype=np.int32), contributions(tf, length_norm(n, n_docs, n_words))))
                    ids.append(doc)
                    entries += len(tf)
                if len(ids) >= TREE_DOCS or entries >= TREE_ENTRIES:
                    best.add(ids, coords, w)
                    ids, coords, entries = [], [], 0
        if ids:
            best.add(ids, coords, w)
        found = best.found(block)
        yield pa.RecordBatch.from_arrays([pa.array(found[f.name], f.type) for f in out], schema=out)

    return map_batches(kept, search, "row long, item_id long, doc_id long, score long", rows=4096)


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``top`` documents with a score
    above 0, equal scores by ascending doc_id (null last).

    Every row of ``items`` and of ``docs`` counts by itself, also repeated ones and
    those without id; null texts have no terms.  Only columns item_id, doc_id and text
    are read.  Empty tables give no rows.
    """
    numbered, n = item_blocks(items, block_bytes)
    parts = []
    for block in range(n):
        rows = numbered.where(F.shiftrightunsigned("row", 33) == block).collect()
        held = Items(rows)
        if held.ids:
            parts.append(written(_search_block(docs, held, top), "best"))
    spark = docs.sparkSession
    best = parts[0] if parts else spark.createDataFrame([], "row long, item_id long, doc_id long, score long")
    for p in parts[1:]:
        best = best.unionByName(p)
    order = Window.partitionBy("row").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return best.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= top) \
        .select("item_id", "rank", "doc_id", "score")


def oracle_sql(top: int = TOP) -> str:
    """The same in DuckDB SQL."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    words = (f"unnest(regexp_extract_all(translate(text, '{capitals}', '{capitals.lower()}'), "
             r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))")
    return f"""
with d as (select row_number() over () as r, doc_id, text from documents),
i as (select row_number() over () as r, item_id, text from benchmark),
dw as (select r, {words} as term from d),
iw as (select r, {words} as term from i),
q as (select r, term, cast(count(*) as bigint) as k from iw group by all),
len as (select r, cast(count(*) as bigint) as n from dw group by r),
total as (select cast(count(*) as bigint) as big_n, cast(sum(n) as bigint) as big_l from len),
tf as (select r, term, cast(count(*) as bigint) as tf from dw where term in (select term from q) group by all),
df as (select term, count(*) as df from tf group by term),
w as (select term, cast(floor({WEIGHT_SCALE} * ln(cast(2 * big_n + 2 as double) / cast(2 * df + 1 as double))) as bigint)
  as w from df, total),
c as (select tf.r, term, ({TF_SCALE} * tf)
  // ({TF_FACTOR} * tf + {LENGTH_FACTOR} * ({100 - LENGTH_SHARE} + ({LENGTH_SHARE} * n * big_n) // big_l)) as c
  from tf join len on tf.r = len.r, total),
s as (select q.r as item, c.r as doc, cast(sum(k * w * c) as bigint) as score
  from q join w using (term) join c using (term) group by all having sum(k * w * c) > 0),
ranked as (select i.item_id, d.doc_id, s.score, cast(row_number() over (partition by s.item
  order by s.score desc, d.doc_id asc nulls last) as integer) as rank from s join i on i.r = s.item join d on d.r = s.doc)
select item_id, rank, doc_id, score from ranked where rank <= {top}"""
