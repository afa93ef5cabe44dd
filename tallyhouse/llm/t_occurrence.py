"""Jaccard self-join of word n-gram sets by T-occurrence search.

A set of n shingles that is linked with any other has at least 85 % of its shingles
in that one.  So, first, shingles are counted over all distinct sets, dealt by hash
into buckets; only sets that have enough shared shingles go on (twice, as those that
fall out make more shingles unshared).  Of the rest, two linked ones share one of
their rarest shingles (as many as may be missing, and one), so sets that are joined
by no chain of such shingles are searched apart, in islands.

In an island every set asks an inverted index of the smaller ones for those that
have T of its shingles (DivideSkip): the long lists are put aside, the short ones
merged by a heap that skips over what cannot reach the rest of T, and a candidate is
looked up in the long lists by binary search until it has or cannot reach the
overlap that its size requires.  Sets that are already linked by others are not
verified again, unless every link is wanted.  A large island is searched by pairs
of blocks; pairs whose sets are all linked by then are left out.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_left
from collections import OrderedDict
from collections.abc import Callable, Iterable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import map_batches, written
from tallyhouse.llm.components import components

SHINGLE = 4
PERCENT = 85
BUCKET_VALUES = 3 << 20      # shingles of a bucket, about
CHUNK_VALUES = 1 << 20       # shingles that a task deals out at once
OFTEN = 16                   # a shingle in so many sets of a chunk is not listed set by set
HOT = (1 << 31) - 1          # the frequency of such a shingle
BLOCK_SHINGLES = 2 << 20     # of the sets that are searched in one task
TASK_SHINGLES = 1 << 18      # that a search task has on average
_MIX = np.uint64(0x9E3779B97F4A7C15)     # an odd number
_LOW = 48                    # bits of a shingle that are stored; its bucket tells more
_HUBS = 3


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """The set as sorted 64-bit hashes: A-Z as a-z, words without space and ASCII
    control 9 to 13; a text of fewer words than ``size`` is one shingle, none or null
    an empty set."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    size = min(size, len(words))
    if not size:
        return np.array([], dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    n = len(words) - size + 1
    out = np.full(n, size, dtype=np.uint64)
    for k in range(size):
        out = (out ^ h[k:k + n]) * _MIX
        out ^= out >> np.uint64(32)
    return np.unique(out)


def least_shared(n: int, percent: int = PERCENT) -> int:
    """How many shingles a set of n has in common with any that it is linked with."""
    return -(-percent * n // 100)


def linked(a: int, b: int, both: int, percent: int = PERCENT) -> bool:
    return 100 * both >= percent * (a + b - both)


# --- shared shingles -------------------------------------------------------------

_DEALT = pa.schema([("part", pa.int32()), ("doc_id", pa.int64()), ("text_key", pa.int64()), ("key", pa.binary()),
                    ("n", pa.int64()), ("target", pa.int32()), ("vals", pa.binary()), ("keys", pa.binary()),
                    ("sizes", pa.binary()), ("counts", pa.binary())])
_DEALT_SQL = ("part int, doc_id long, text_key long, key binary, n long, target int, vals binary, keys binary, "
              "sizes binary, counts binary")
_SHARED = pa.schema([*list(_DEALT)[1:], pa.field("freq", pa.binary())])
_SHARED_SQL = _DEALT_SQL.removeprefix("part int, ") + ", freq binary"


class _Dealer:
    """Deals the shingles of sets into buckets by their upper bits."""

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.seen: OrderedDict[bytes, None] = OrderedDict()
        self.clear()

    def clear(self) -> None:
        self.keys: list[bytes] = []
        self.sizes: list[int] = []
        self.values: list[np.ndarray] = []
        self.held = 0

    def add(self, key: bytes, n: int, values: np.ndarray) -> Iterator[tuple]:
        if key in self.seen:                               # a copy
            return
        self.seen[key] = None
        if len(self.seen) > 200_000:
            self.seen.popitem(last=False)
        self.keys.append(key)
        self.sizes.append(n)
        self.values.append(values)
        self.held += len(values)
        if self.held >= CHUNK_VALUES:
            yield from self.flush()

    def flush(self) -> Iterator[tuple]:
        """Rows as in ``_DEALT``: of a bucket, the lower bytes of its ``n`` frequent values
        and of the values of all sets that have some, set by set; and of the sets'
        frequent values, a row for each target."""
        if not self.values:
            return
        values = np.concatenate(self.values)
        doc = np.repeat(np.arange(len(self.values)), [len(v) for v in self.values])
        order = values.argsort(kind="stable")
        starts = np.flatnonzero(np.concatenate([[True], np.diff(values[order]) != 0]))
        count = np.diff(np.append(starts, len(values)))
        often = np.zeros(len(values), dtype=bool)
        often[order] = np.repeat(count >= OFTEN, count)
        hot = values[order][starts[count >= OFTEN]]
        frequent = _stored(values[often], self._part(values[often]))
        for target, rows in _by_target(frequent, doc[often], self.keys, self.sizes, self.buckets):
            yield (target, None, None, None, None, target, *rows[0])
        values, doc = values[~often], doc[~often]
        part, hot_part = self._part(values), self._part(hot)
        order = part.argsort(kind="stable")
        values, doc, part = values[order], doc[order], part[order]
        ends = np.searchsorted(part, np.arange(self.buckets + 1))
        for b in range(self.buckets):
            v, d = values[ends[b]:ends[b + 1]], doc[ends[b]:ends[b + 1]]
            h = hot[hot_part == b]
            if len(v) or len(h):
                keys, sizes, counts = _sets_of(d, self.keys, self.sizes)
                yield (b, None, None, None, len(h), None, _low_bytes(np.concatenate([h, v])), keys, sizes, counts)
        self.clear()

    def _part(self, values: np.ndarray) -> np.ndarray:
        return (values >> np.uint64(40)) * np.uint64(self.buckets) >> np.uint64(24)


def _sets_of(d: np.ndarray, keys: list[bytes], sizes: list[int]) -> tuple[bytes, bytes, bytes]:
    """Keys, sizes and numbers of values of the sets in an ascending array of sets."""
    some, n = np.unique(d, return_counts=True)
    return (b"".join(keys[k] for k in some.tolist()), np.array([sizes[k] for k in some.tolist()], dtype=np.int64).tobytes(),
            n.astype(np.int32).tobytes())


def _by_target(v: np.ndarray, d: np.ndarray, keys: list[bytes], sizes: list[int], targets: int,
               *more: np.ndarray) -> Iterator[tuple[int, list]]:
    """Values of sets (d), and whatever goes with them, dealt by the sets' keys:
    (target, [(vals, keys, sizes, counts), *more])."""
    if not len(v):
        return
    target = (np.frombuffer(b"".join(k[:4] for k in keys), dtype="<u4").astype(np.int64) * targets >> 32)[d]
    order = np.lexsort((d, target))
    v, d, target = v[order], d[order], target[order]
    starts = np.flatnonzero(np.concatenate([[True], np.diff(target) != 0]))
    for a, b in zip(starts, np.append(starts[1:], len(v)), strict=True):
        yield int(target[a]), [(v[a:b].tobytes(), *_sets_of(d[a:b], keys, sizes)),
                               *(x[order][a:b].tobytes() for x in more)]


def _low_bytes(values: np.ndarray) -> bytes:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_LOW // 8].tobytes()


def _from_low_bytes(data: bytes, part: int) -> np.ndarray:
    rows = np.zeros((len(data) * 8 // _LOW, 8), dtype=np.uint8)
    rows[:, :_LOW // 8] = np.frombuffer(data, dtype=np.uint8).reshape(len(rows), -1)
    return _stored(rows.view("<u8").ravel(), np.uint64(part))


def _stored(values: np.ndarray, part: np.ndarray) -> np.ndarray:
    """What is kept of a value: its lower bits, and its bucket above them."""
    return (values & np.uint64((1 << _LOW) - 1)) | (part << np.uint64(_LOW))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)


def _deal_texts(buckets: int, size: int) -> Callable:
    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dealer = _Dealer(buckets)
        for b in batches:
            rows = []
            for doc, text_key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                values = shingles(text.as_py(), size)
                key = hashlib.md5(values.tobytes()).digest() if len(values) else None
                rows.append((len(dealer.seen) % buckets, doc, text_key, key, len(values), None, None, None, None, None))
                if key:
                    for r in dealer.add(key, len(values), values):
                        rows.append(r)
            yield _batch(rows, _DEALT)
        yield _batch(list(dealer.flush()), _DEALT)

    return deal


def _deal_sets(buckets: int) -> Callable:
    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dealer = _Dealer(buckets)
        for b in batches:
            rows: list[tuple] = []
            for key, n, vals in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                values = np.frombuffer(vals, dtype=np.uint64) * _MIX     # upper bits that tell values apart again
                rows += dealer.add(key, n, np.sort(values ^ (values >> np.uint64(32))))
            yield _batch(rows, _DEALT)
        yield _batch(list(dealer.flush()), _DEALT)

    return deal


def _count_bucket(part: int, rows: list[tuple], targets: int) -> Iterator[tuple]:
    """The shared values of the sets in one bucket, with the number of sets that have
    them (HOT: frequent in some chunk), a row for each target."""
    seen: set[bytes] = set()
    keys: list[bytes] = []
    sizes: list[int] = []
    values, docs, hot = [], [], []
    for n_hot, vals, ks, ns, counts in rows:
        v = _from_low_bytes(vals, part)
        hot.append(v[:n_hot])
        counts = np.frombuffer(counts, dtype=np.int32)
        mine = [ks[at:at + 16] for at in range(0, len(ks), 16)]
        fresh = np.array([k not in seen for k in mine], dtype=bool)
        seen.update(mine)
        values.append(v[n_hot:][np.repeat(fresh, counts)])
        docs.append(np.repeat(np.arange(len(keys), len(keys) + int(fresh.sum())), counts[fresh]))
        keys += [k for k, f in zip(mine, fresh.tolist(), strict=True) if f]
        sizes += np.frombuffer(ns, dtype=np.int64)[fresh].tolist()
    v, d = np.concatenate(values), np.concatenate(docs)
    if not len(v):
        return
    order = v.argsort(kind="stable")
    v, d = v[order], d[order]
    starts = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
    count = np.diff(np.append(starts, len(v)))
    freq = np.repeat(np.where(np.isin(v[starts], np.concatenate(hot)), HOT, count), count)
    shared = freq > 1
    v, d, freq = v[shared], d[shared], freq[shared].astype(np.int32)
    for target, (sets, f) in _by_target(v, d, keys, sizes, targets, freq):
        yield (None, None, None, None, target, *sets, f)


def _shared_values(targets: int) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, []
        for b in batches:
            out = []
            for p, *row in zip(*(b.column(i).to_pylist() for i in range(10)), strict=True):
                if row[6] is None or row[4] is not None:   # a document's own row, or frequent values: handed on
                    out.append((*row, None))
                    continue
                if p != part:
                    if held:
                        out += _count_bucket(part, held, targets)
                    part, held = p, []
                held.append((row[3], *row[5:]))
            yield _batch(out, _SHARED)
        if held:
            yield _batch(list(_count_bucket(part, held, targets)), _SHARED)

    return run


def _enough(percent: int) -> Callable:
    """The sets that have enough shared values, these by ascending frequency, and how
    many of the first of them a linked set may not miss all of."""
    schema = pa.schema([("key", pa.binary()), ("n", pa.int64()), ("vals", pa.binary()), ("few", pa.int32())])

    def close(number: dict[bytes, int], sizes: list[int], values: list, sets: list, freq: list) -> list[tuple]:
        v, d, f = np.concatenate(values), np.concatenate(sets), np.concatenate(freq)
        order = np.lexsort((v, d))
        v, d, f = v[order], d[order], f[order]
        # A value may be listed twice (frequent in one chunk, not in another); both are HOT.
        once = np.concatenate([[True], (v[1:] != v[:-1]) | (d[1:] != d[:-1])])
        v, d, f = v[once], d[once], f[once]
        least = np.array([least_shared(n, percent) for n in sizes])
        count = np.bincount(d, minlength=len(sizes))
        enough = count >= least
        v, f, d = v[enough[d]], f[enough[d]], d[enough[d]]
        v = v[np.lexsort((v, f, d))]
        keys, ends = list(number), np.cumsum(np.where(enough, count, 0))
        return [(keys[k], sizes[k], v[ends[k] - count[k]:ends[k]].tobytes(), int(count[k] - least[k]) + 1)
                for k in np.flatnonzero(enough).tolist()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, held = None, None
        for b in batches:
            out = []
            for t, vals, ks, ns, counts, f in zip(*(b.column(i).to_pylist() for i in range(6)), strict=True):
                if t != target:
                    if held:
                        out += close(*held)
                    target, held, seen = t, ({}, [], [], [], []), set()
                number, sizes, values, sets, freq = held
                v, counts = np.frombuffer(vals, dtype=np.uint64), np.frombuffer(counts, dtype=np.int32)
                keys = [ks[at:at + 16] for at in range(0, len(ks), 16)]
                for k, n in zip(keys, np.frombuffer(ns, dtype=np.int64).tolist(), strict=True):
                    if number.setdefault(k, len(number)) == len(sizes):
                        sizes.append(n)
                if f is None:                              # frequent values come again with each task's copy
                    ends = np.cumsum(counts)
                    new = np.ones(len(keys), dtype=bool)
                    for i, k in enumerate(keys):
                        mark = (k, hash(v[ends[i] - counts[i]:ends[i]].tobytes()))
                        new[i] = mark not in seen
                        seen.add(mark)
                    v = v[np.repeat(new, counts)]
                    keys, counts = [k for k, x in zip(keys, new.tolist(), strict=True) if x], counts[new]
                values.append(v)
                sets.append(np.repeat(np.array([number[k] for k in keys], dtype=np.int64), counts))
                freq.append(np.full(len(v), HOT, dtype=np.int32) if f is None else np.frombuffer(f, dtype=np.int32))
            yield _batch(out, schema)
        if held:
            yield _batch(close(*held), schema)

    return run


def _candidates(dealt: DataFrame, buckets: int, percent: int, name: str) -> tuple[DataFrame, DataFrame]:
    counted = written(map_batches(dealt.repartition("part").sortWithinPartitions("part"), _shared_values(buckets),
                                  _SHARED_SQL, rows=256), f"{name}-shared")
    by_set = counted.where("target is not null").select("target", "vals", "keys", "sizes", "counts", "freq") \
        .repartition("target").sortWithinPartitions("target")
    return counted, written(map_batches(by_set, _enough(percent), "key binary, n long, vals binary, few int", rows=64),
                            f"{name}-candidates")


def _bucket_number(values: int) -> int:
    return min(max(4, math.ceil(values / BUCKET_VALUES)), 1 << 16)


def sets_and_candidates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """``doc_id, text_key, key, n`` of every row (key: digest of its set, null if empty),
    and ``key, n, vals, few`` of the distinct sets that may be linked with another."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    volume = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = _bucket_number(volume // 6)
    counted, some = _candidates(map_batches(rows, _deal_texts(buckets, size), _DEALT_SQL), buckets, percent, "texts")
    left = some.agg(F.sum(F.octet_length("vals"))).first()[0] or 0
    buckets = _bucket_number(left // 8)
    dealt = map_batches(some.select("key", "n", "vals"), _deal_sets(buckets), _DEALT_SQL)
    return counted.where("target is null").select("doc_id", "text_key", "key", "n"), \
        _candidates(dealt, buckets, percent, "sets")[1]


# --- T-occurrence search ----------------------------------------------------------

class _Index:
    """Inverted lists of set positions (ascending), and the DivideSkip search."""

    def __init__(self) -> None:
        self.lists: dict[int, list[int]] = {}

    def add(self, at: int, values: list[int]) -> None:
        for v in values:
            held = self.lists.get(v)
            if held is None:
                self.lists[v] = [at]
            else:
                held.append(at)

    def search(self, values: list[int], t: int, first: int) -> Iterator[tuple[int, int, list[list[int]]]]:
        """``position, count, long lists`` of all from ``first`` on that may have t of the
        values: count in the short lists, the rest to be looked up."""
        found = [x for x in map(self.lists.get, values) if x is not None and x[-1] >= first]
        if len(found) < t:
            return
        found.sort(key=len)
        # As many long lists as pay off by DivideSkip's rule (its factor for unit costs).
        put_aside = min(t - 1, int(t / (0.0085 * math.log2(len(found[-1]) + 1) + 1)))
        short, long = found[:len(found) - put_aside], found[len(found) - put_aside:]
        rest = t - put_aside
        heap = []
        for k, x in enumerate(short):
            at = bisect_left(x, first)
            if at < len(x):
                heap.append((x[at], k, at))
        heapify(heap)
        while len(heap) >= rest:
            here = heap[0][0]
            popped = []
            while heap and heap[0][0] == here:
                popped.append(heappop(heap))
            if len(popped) >= rest:
                yield here, len(popped), long
                ahead = here + 1
            else:
                # Fewer than ``rest`` lists stand before the next one's place: skip to it.
                while heap and len(popped) < rest - 1:
                    popped.append(heappop(heap))
                if not heap:
                    return
                ahead = heap[0][0]
            for _, k, at in popped:
                x = short[k]
                at = bisect_left(x, ahead, at)
                if at < len(x):
                    heappush(heap, (x[at], k, at))


class _Classes:
    """Which sets of a block are linked by now."""

    def __init__(self, labels: list):
        first: dict = {}
        self.up = [first.setdefault(x, k) for k, x in enumerate(labels)]
        self.indexed: set[int] = set()                     # classes that have a set in an index

    def root(self, k: int) -> int:
        while self.up[k] != k:
            self.up[k] = self.up[self.up[k]]
            k = self.up[k]
        return k

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        self.up[b] = a
        if b in self.indexed:
            self.indexed.discard(b)
            self.indexed.add(a)


def search_block(sets: list[tuple], percent: int = PERCENT, every: bool = False) -> Iterator[tuple[int, int]]:
    """Pairs of positions in ``sets`` (n, values, side, label): all links, or with
    ``every`` false as many as connect what is linked.  Sets with sides 0 and 1 are
    searched across, sets of side None among each other."""
    order = sorted(range(len(sets)), key=lambda k: sets[k][0])
    sizes = [sets[k][0] for k in order]
    classes = _Classes([sets[k][3] for k in order])
    index = {side: _Index() for side in (None, 0, 1)}
    hubs: list[int] = []
    arrays: dict[int, np.ndarray] = {}
    for at, k in enumerate(order):
        n, values, side, _ = sets[k]
        listed = values.tolist()
        other = None if side is None else 1 - side
        first = bisect_left(sizes, least_shared(n, percent))

        def alone() -> bool:
            """No indexed set is outside of this one's class."""
            return not every and classes.indexed <= {classes.root(at)}  # noqa: B023

        if not every:
            for hub in hubs:
                if hub >= first and sets[order[hub]][2] == other and classes.root(hub) != classes.root(at):
                    both = len(np.intersect1d(values, arrays[hub], assume_unique=True))
                    if linked(n, sizes[hub], both, percent):
                        classes.join(hub, at)
                        yield order[hub], k
                        break
        if not alone():
            for found, count, long in index[other].search(listed, least_shared(n, percent), first):
                if not every and classes.root(found) == classes.root(at):
                    continue
                need = -(-percent * (n + sizes[found]) // (100 + percent))
                left = len(long)
                for x in long:
                    if count + left < need:
                        break
                    left -= 1
                    place = bisect_left(x, found)
                    count += place < len(x) and x[place] == found
                if linked(n, sizes[found], count, percent):
                    classes.join(found, at)
                    yield order[found], k
                    if not every:
                        if found in hubs:
                            hubs.remove(found)
                        hubs.insert(0, found)
                        arrays[found] = sets[order[found]][1]
                        for gone in hubs[_HUBS:]:
                            arrays.pop(gone)
                        del hubs[_HUBS:]
                        if alone():
                            break
        index[side].add(at, listed)
        classes.indexed.add(classes.root(at))


def _search_groups(percent: int, every: bool) -> Callable:
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def close(held: list[tuple]) -> list[tuple]:
        sets = [(n, np.frombuffer(v, dtype=np.uint64), side, label) for _, n, v, side, label in held]
        return [(held[a][0], held[b][0]) for a, b in search_block(sets, percent, every)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, []
        for b in batches:
            out = []
            for i, j, h, key, n, v, side, label in zip(*(b.column(c).to_pylist() for c in range(8)), strict=True):
                if (i, j, h) != group:
                    out += close(held)
                    group, held = (i, j, h), []
                held.append((key, n, v, side, label))
            yield _batch(out, schema)
        yield _batch(close(held), schema)

    return run


def islands(some: DataFrame) -> DataFrame:
    """``key, n, vals, island``: sets of one island share rare values by some chain.
    (Sets are told apart by a hash here; if two had the same, islands would merge.)"""
    rare = some.select(F.xxhash64("key").alias("node"), F.explode(F.expr(
        "transform(sequence(0, few - 1), i -> substring(vals, 8 * i + 1, 8))")).alias("v"))
    rare = written(rare.select("node", F.xxhash64("v").alias("v")), "rare-values")
    shared = rare.groupBy("v").agg(F.min("node").alias("a"), F.max("node").alias("most")).where("a < most")
    edges = rare.join(shared, "v").where("a < node").select("a", F.col("node").alias("b")).distinct()
    found = components(edges).withColumnRenamed("label", "island")
    return some.withColumn("node", F.xxhash64("key")).join(found, "node").select("key", "n", "vals", "island")


def links(some: DataFrame, percent: int = PERCENT, every: bool = False, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """``a, b``: links between distinct sets (key, n, vals, few)."""
    placed = islands(some)
    volume = placed.groupBy("island").agg(F.sum(F.octet_length("vals")).alias("volume"))
    blocks = volume.select("island", F.ceil(F.col("volume") / (8 * block_shingles)).cast("int").alias("blocks"))
    sets = written(placed.join(blocks, "island").withColumn(
        "block", F.expr("cast(pmod(xxhash64(key, 1), blocks) as int)")), "island-sets")
    columns = ["island", "i", "j", "key", "n", "vals", "side", "label"]
    # Searching takes far longer than reading, so tasks are small.
    whole = sets.agg(F.sum(F.octet_length("vals"))).first()[0] or 0
    tasks = max(sets.sparkSession.sparkContext.defaultParallelism, math.ceil(whole / (8 * TASK_SHINGLES)))

    def search(rows: DataFrame) -> DataFrame:
        dealt = rows.select(*columns).repartition(tasks, "island", "i", "j").sortWithinPartitions("island", "i", "j")
        return written(map_batches(dealt, _search_groups(percent, every), "a binary, b binary", rows=1024), "set-links")

    none = F.lit(None)
    found = search(sets.select("island", F.col("block").alias("i"), F.col("block").alias("j"), "key", "n", "vals",
                               none.cast("int").alias("side"), F.col("key").alias("label")))
    large = sets.where("blocks > 1")
    if not large.limit(1).count():
        return found
    # First all blocks against the first one, then whatever pairs are not linked as a whole.
    for later in (False, True):
        labels = components(found)
        known = large.join(labels.withColumnRenamed("node", "key"), "key", "left") \
            .withColumn("label", F.coalesce("label", "key"))
        uniform = known.groupBy("island", "block", "blocks").agg(F.min("label").alias("low"), F.max("label").alias("high"))
        others = "sequence(block + 1, blocks - 1)" if later else "sequence(1, blocks - 1)"
        left = uniform.where(F.expr("block > 0 and block < blocks - 1" if later else "block = 0")).select(
            "island", F.col("block").alias("i"), "low", "high", F.explode(F.expr(others)).alias("j"))
        right = uniform.select("island", F.col("block").alias("j"), F.col("low").alias("low2"),
                               F.col("high").alias("high2"))
        pairs = left.join(right, ["island", "j"])
        if not every:
            pairs = pairs.where("not (low = high and low2 = high2 and low = low2)")
        pairs = written(pairs.select("island", "i", "j"), "block-pairs")
        one = known.withColumnRenamed("block", "i").join(pairs, ["island", "i"]).withColumn("side", F.lit(0))
        two = known.withColumnRenamed("block", "j").join(pairs, ["island", "j"]).withColumn("side", F.lit(1))
        found = found.unionByName(search(one.select(*columns).unionByName(two.select(*columns))))
    return found


def jaccard_classes(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT,
                    block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """``doc_id, text_key, n_shingles, label, component_id`` for each row of ``docs``.

    Two rows are linked when their sets of ``size``-word shingles have a Jaccard
    similarity of at least ``percent`` %; component_id is the smallest doc_id that
    links reach (null if none has one), label the component's digest.  A row without
    words is linked with nothing: its component_id is its own doc_id, its label null.
    Rows of equal doc_id count each by itself; text_key (a hash of the text) tells them
    apart.  An empty table gives no rows.
    """
    rows, some = sets_and_candidates(docs, size, percent)
    firsts = rows.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("first_id"))
    found = components(links(some, percent, block_shingles=block_shingles)).withColumnRenamed("node", "key")
    labelled = written(firsts.join(found, "key", "left").withColumn("label", F.coalesce("label", "key")), "set-labels")
    smallest = labelled.groupBy("label").agg(F.min("first_id").alias("component_id"))
    by_key = written(labelled.select("key", "label").join(smallest, "label"), "set-classes")
    full = rows.where("key is not null").join(by_key, "key").select("doc_id", "text_key", "n", "label", "component_id")
    empty = rows.where("key is null").select("doc_id", "text_key", "n", F.lit(None).cast("binary").alias("label"),
                                             F.col("doc_id").alias("component_id"))
    return full.unionByName(empty).withColumnRenamed("n", "n_shingles")


def digests(classes: DataFrame) -> DataFrame:
    return classes.select("doc_id", "n_shingles", "component_id")
