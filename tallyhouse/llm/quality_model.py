"""Quality classifier by supervised subword embeddings.

A text is the average of learned vectors of its words and of the character
n-grams inside them (white space marks their ends), all hashed into one table; a
word that repeats the one before counts as a mark of repetition.  A softmax layer
tells the classes apart.  Both are trained by stochastic gradient
descent in numpy on a bounded sample of labelled texts.  As averaging is linear,
a trained model gives each bucket one number (the difference of the classes'
outputs), so a text is scored by one lookup a feature.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.common import map_batches, written

BITS = 17                    # log2 of the hash table's buckets
DIMENSIONS = 16
GRAMS = (3, 4)
PER_CLASS = 3000             # bound of the training sample, for each class
UPDATES = 60_000             # steps of gradient descent
RATE = 1.0
THRESHOLD = 0.7
_RUN = 1 << 20               # characters that are hashed at once

_PRIME, _MIX = np.uint32(16777619), np.uint32(2654435761)
_AGAIN = np.uint32(0x5EED)   # stands for a word that repeats the one before
_POWERS = np.cumprod(np.full(1024, _PRIME, dtype=np.uint32), dtype=np.uint32)


def _buckets(h: np.ndarray, salt: int) -> np.ndarray:
    return ((h + np.uint32(salt)) * _MIX) >> np.uint32(32 - BITS)


def features(text: str | None) -> Iterator[np.ndarray]:
    """Buckets of all words and n-grams, a run of the text at a time.  Runs end at
    white space, unless a run of a million characters has none."""
    text = text or ""
    at = 0
    while at < len(text):
        end = at + _RUN
        if end < len(text):
            cut = max(text.rfind(" ", at, end), text.rfind("\n", at, end))
            end = cut if cut > at else end
        yield _run_features(text[at:end])
        at = end


def _run_features(text: str) -> np.ndarray:
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    gap = (c == 32) | ((c >= 9) & (c <= 13))
    c = np.where(gap, np.uint32(32), c)
    c = np.concatenate([[np.uint32(32)], c, [np.uint32(32)]])
    gap = np.concatenate([[True], gap, [True]])
    starts = np.flatnonzero(gap[:-1] & ~gap[1:]) + 1
    if not len(starts):
        return np.zeros(0, dtype=np.uint32)
    inside = np.flatnonzero(~gap)
    lengths = np.flatnonzero(~gap[:-1] & gap[1:]) + 1 - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(len(inside)) - np.repeat(first, lengths)
    word = np.add.reduceat(c[inside] * _POWERS[place % len(_POWERS)], first, dtype=np.uint32)
    again = np.concatenate([[False], word[1:] == word[:-1]])
    out = [_buckets(np.where(again, _AGAIN, word), 1)]
    for n in GRAMS:
        if len(c) < n:
            continue
        size = len(c) - n + 1
        h = np.zeros(size, dtype=np.uint32)
        whole = np.ones(size, dtype=bool)
        for k in range(n):
            h = h * _PRIME + c[k:k + size]
            if 0 < k < n - 1:
                whole &= ~gap[k:k + size]
        out.append(_buckets(h[whole], n))
    return np.concatenate(out)


@dataclass
class Model:
    """Embeddings (buckets x dimensions), output weights (2 x dimensions), bias (2)."""

    vectors: np.ndarray
    output: np.ndarray
    bias: np.ndarray

    def probabilities(self, buckets: np.ndarray, weights: np.ndarray) -> np.ndarray:
        x = weights @ self.vectors[buckets] if len(buckets) else np.zeros(self.vectors.shape[1])
        z = self.output @ x + self.bias
        e = np.exp(z - z.max())
        return e / e.sum()

    def margins(self) -> np.ndarray:
        """Each bucket's share of the logit of class 1; the last is the bias."""
        w = self.output[1] - self.output[0]
        return np.append(self.vectors @ w, self.bias[1] - self.bias[0]).astype(np.float32)


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], prior: float, updates: int = UPDATES, rate: float = RATE,
          seed: int = 7) -> Model:
    """Fit on rows of (label, buckets, their shares of the text's features); texts
    are drawn again and again at a falling rate.  Classes weigh as ``prior`` (the
    share of class 1) says, whatever their share of the sample."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (1 << BITS, DIMENSIONS)).astype(np.float32)
    model = Model(vectors, np.zeros((2, DIMENSIONS), dtype=np.float32), np.zeros(2, dtype=np.float32))
    if not rows:
        model.bias[1] = math.log(max(prior, 1e-3) / max(1 - prior, 1e-3))
        return model
    ones = sum(r[0] for r in rows) / len(rows)
    share = {0: (1 - prior) / max(1 - ones, 1e-9), 1: prior / max(ones, 1e-9)}
    step = 0
    while step < updates:
        for k in rng.permutation(len(rows)):
            label, buckets, weights = rows[k]
            lr = rate * (1 - step / updates) * share[label]
            step += 1
            if step >= updates:
                break
            x = weights @ vectors[buckets] if len(buckets) else np.zeros(DIMENSIONS, dtype=np.float32)
            z = model.output @ x + model.bias
            e = np.exp(z - z.max())
            g = (e / e.sum()).astype(np.float32)
            g[label] -= 1
            back = model.output.T @ g
            model.output -= lr * np.outer(g, x)
            model.bias -= 0.1 * lr * g
            if len(buckets):
                vectors[buckets] -= lr * np.outer(weights, back)
    return model


def held_out(doc_id: Column) -> Column:
    """The fold that training never sees: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


_SAMPLE = pa.schema([("label", pa.int32()), ("buckets", pa.binary()), ("weights", pa.binary())])


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> np.ndarray:
    """The margins of a model fitted to ``labels`` (doc_id, quality 0 or 1) outside
    the held-out fold.  At most ``per_class`` labelled ids of each class are used,
    in the order of a hash; of rows with one id the smallest quality and text count.
    Labels that are null or other numbers, and ids without a text, are passed over.
    """
    usable = labels.select(F.col("doc_id").cast("long").alias("label_id"), F.col("quality").cast("int").alias("label")) \
        .where("label_id is not null and label in (0, 1)").where(~held_out(F.col("label_id"))) \
        .groupBy("label_id").agg(F.min("label").alias("label"))
    counts = {r["label"]: r["n"] for r in usable.groupBy("label").agg(F.count("*").alias("n")).collect()}
    prior = counts.get(1, 0) / max(1, sum(counts.values())) if counts else 0.5
    order = F.xxhash64(F.lit(11), "label_id")
    sample = None
    for label in (0, 1):
        part = usable.where(F.col("label") == label).orderBy(order, "label_id").limit(per_class)
        sample = part if sample is None else sample.union(part)
    # The sample's size is fixed, so it is broadcast: only its own texts are shuffled.
    texts = docs.select(F.col("doc_id").cast("long").alias("label_id"), "text") \
        .join(F.broadcast(sample), "label_id").groupBy("label_id") \
        .agg(F.min("label").alias("label"), F.min("text").alias("text"))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = []
            for label, t in zip(b.column(1).to_pylist(), b.column(2), strict=True):
                runs = list(features(t.as_py()))
                found, n = np.unique(np.concatenate(runs), return_counts=True) if runs else (np.zeros(0), np.zeros(0))
                got.append({"label": label, "buckets": found.astype("<u4").tobytes(),
                            "weights": (n / max(1, n.sum())).astype("<f4").tobytes()})
            yield pa.RecordBatch.from_pylist(got, schema=_SAMPLE)

    def learn(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = {}
        for b in batches:
            for r in b.to_pylist():
                rows[(r["buckets"], r["weights"], r["label"])] = (
                    r["label"], np.frombuffer(r["buckets"], "<u4"), np.frombuffer(r["weights"], "<f4"))
        model = train([rows[k] for k in sorted(rows)], prior)
        yield pa.RecordBatch.from_pydict({"margins": [model.margins().tobytes()]})

    counted = written(map_batches(texts, count, "label int, buckets binary, weights binary", rows=128), "sample")
    row = map_batches(counted.coalesce(1), learn, "margins binary").first()
    return np.frombuffer(row["margins"], dtype=np.float32) if row else train([], prior).margins()


def score(docs: DataFrame, margins: np.ndarray, result: str = "score") -> DataFrame:
    """``docs`` with a double column ``result``: the probability of class 1.

    All columns stay (one of the result's name is replaced).  Null and empty texts
    have no features and get the bias alone; repeated rows are scored each.
    """
    kept = [c for c in docs.columns if c.lower() != result.lower()]
    rows = docs.select(*kept)
    at = kept.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(margins)   # 2**BITS + 1 numbers

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        table, bias = m[:-1], float(m[-1])
        for b in batches:
            out = np.empty(b.num_rows)
            for k, t in enumerate(b.column(at)):
                total, n = 0.0, 0
                for buckets in features(t.as_py()):
                    total += float(table[buckets].sum(dtype=np.float64))
                    n += len(buckets)
                out[k] = 1 / (1 + math.exp(-min(max(bias + total / max(n, 1), -500), 500)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out)], names=[*kept, result])

    return map_batches(rows, run, T.StructType([*rows.schema.fields, T.StructField(result, T.DoubleType())]))


def digests(scored: DataFrame, result: str = "score") -> DataFrame:
    return scored.select(F.col("doc_id"), held_out(F.col("doc_id").cast("long")).alias("held_out"),
                         F.col(result).alias("score"),
                         (F.col(result) >= THRESHOLD).cast("int").alias("predicted"))
