"""The prefix trie of conversations, by adaptive radix trees over turn ids.

A turn is a fixed-width id of 16 bytes (a digest of role and text).  A
conversation is cut into segments of at most ``SEGMENT`` turns, so no row, key or
tree grows with a conversation's length.  A segment stands below its *anchor*, the
node of all turns before it.  Distinct segments are counted first (copies shrink
to one row a map task), then dealt by ranges of (anchor, key): every task builds
radix trees over its runs of sorted keys and emits a node at each turn-aligned
byte depth, also inside compressed paths.

A node of several runs lies on the path of a run's first or last key.  Such nodes
(at most two paths a run) are merged afterwards; all others are whole where they
are emitted.  What lies below an anchor reaches the nodes above it by doubling
steps over the anchors.

A node's key is the exclusive or of two 64-bit hashes of each (turn id, place), so
it can be had from any of its members without a walk, and a long conversation's
anchors are prefix sums.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import map_batches, written
from tallyhouse.llm.radix_tree import RadixTree

SEGMENT = 32                 # turns of a key
WIDTH = 16                   # bytes of a turn id
SEED = 42
HEAD = 6                     # the query's heads have fewer turns than this
GROUP = 100                  # conversations that share a head
RUN_BYTES = 4 << 20         # key bytes of one tree
_BLOCK = 4096                # segments whose anchors are summed in one window
_PIECE = 1 << 20             # characters of member ids hashed at once

_ROW = pa.schema([
    ("k1", pa.int64()), ("k2", pa.int64()), ("p1", pa.int64()), ("p2", pa.int64()), ("depth", pa.int64()),
    ("turn_id", pa.binary()), ("n_convs", pa.int64()), ("conv_id", pa.int64()), ("chars", pa.int64()),
    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved", pa.int64()), ("parent_conv_id", pa.int64()),
    ("anchor", pa.bool_()), ("shared", pa.bool_()), ("goes_on", pa.bool_()),
    ("path1", pa.list_(pa.int64())), ("path2", pa.list_(pa.int64()))])
_ROW_SQL = ("k1 long, k2 long, p1 long, p2 long, depth long, turn_id binary, n_convs long, conv_id long, chars long, "
            "n_children long, n_leaves long, saved long, parent_conv_id long, anchor boolean, shared boolean, "
            "goes_on boolean, path1 array<long>, path2 array<long>")


# --- turns in order ------------------------------------------------------------

def turn_id(role: Column, text: Column) -> Column:
    return F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, pos, id, chars``: turns numbered from 0 in each conversation.

    Ordered by turn (null first), then by id, so ties and repeated rows have one
    order.  Null role or text is empty.  Rows without conv_id belong to no
    conversation and are left out.  The table is sorted by ranges, so one
    conversation may lie in many tasks; each task numbers its rows, and where a
    conversation goes on from the task before, that task's count is added.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        turn_id(F.coalesce(F.col("role").cast("string"), F.lit("")), text).alias("id"),
        F.length(text).alias("chars"))
    out = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("id", pa.binary()), ("chars", pa.int32()),
                     ("part", pa.int32()), ("opens", pa.bool_())])

    def number(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from pyspark import TaskContext
        part, first, last, count = TaskContext.get().partitionId(), None, None, 0
        for b in batches:
            conv = b.column(0).to_numpy(zero_copy_only=False)
            if not len(conv):
                continue
            first = conv[0] if first is None else first
            starts = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
            place = np.arange(len(conv)) - np.repeat(starts, np.diff(np.append(starts, len(conv))))
            if conv[0] == last:
                place[:starts[1] if len(starts) > 1 else len(conv)] += count
            last, count = conv[-1], int(place[-1]) + 1
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(place), b.column(1), b.column(2),
                                              pa.array(np.full(len(conv), part, dtype=np.int32)),
                                              pa.array(conv == first)], schema=out)

    by = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("id")]
    ranged = turns.repartitionByRange(*by).sortWithinPartitions(*by).select("conv_id", "id", "chars")
    rows = written(map_batches(ranged, number, "conv_id long, place long, id binary, chars int, part int, opens boolean",
                               rows=10_000), "ordered-turns")
    runs = rows.groupBy("conv_id", "part").agg(F.count("*").alias("n"), F.first("opens").alias("opens"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    # At most one row for each task of the sort.
    moved = runs.withColumn("before", before).where("opens and before > 0").select("conv_id", "part", "before")
    return rows.join(F.broadcast(moved), ["conv_id", "part"], "left").select(
        "conv_id", (F.col("place") + F.coalesce("before", F.lit(0))).alias("pos"), "id", "chars")


def with_shared_heads(turns: DataFrame, group: int = GROUP, head: int = HEAD) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt with a head that a group shares: ``conv_id, pos, id,
    chars, total`` and ``conv_id, total``.

    Conversation c gets the first h turns of c - c % group (all if fewer), then its
    own after its first h; h is the crc32 of c's decimal digits modulo ``head``, and %
    has the sign of c, as in SQL.
    """
    turns = written(turns, "numbered-turns")
    first = F.col("conv_id") - F.col("conv_id") % group
    heads = turns.where((first == F.col("conv_id")) & (F.col("pos") < head - 1)).groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("pos", "id", "chars"))).alias("head"))
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("n")).select(
        "conv_id", "n", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % head).alias("h"),
        first.alias("head_of"))
    plan = convs.join(heads.withColumnRenamed("conv_id", "head_of"), "head_of", "left").select(
        "conv_id", "h", "n", F.expr("slice(coalesce(head, array()), 1, cast(h as int))").alias("head"))
    plan = written(plan.withColumn("total", F.size("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "heads")
    own = turns.join(plan.select("conv_id", "h", F.size("head").alias("taken"), "total"), "conv_id") \
        .where("pos >= h").select("conv_id", F.expr("pos - h + taken").alias("pos"), "id", "chars", "total")
    taken = plan.select("conv_id", F.explode("head").alias("t"), "total").select(
        "conv_id", "t.pos", "t.id", "t.chars", "total")
    return own.unionByName(taken), plan.select("conv_id", "total")


# --- segments --------------------------------------------------------------------

def _signed(n: int) -> int:
    return n - (1 << 64) if n >> 63 else n


def _terms() -> tuple[Column, Column]:
    """The two hashes of (id, pos)."""
    at = F.unhex(F.lpad(F.hex(F.col("pos").cast("long")), 16, "0"))
    return F.xxhash64(F.concat("id", at)), F.xxhash64(F.concat(at, F.col("id")))


def segments(turns: DataFrame) -> DataFrame:
    """``conv_id, seg, a1, a2, ids, lens, e1, e2, ends``: every conversation's turns
    (conv_id, pos, id, chars, total) in segments below their anchors (a1, a2);
    (e1, e2) is the node behind the segment, ``ends`` whether the conversation ends
    there."""
    z1, z2 = _terms()
    cut = turns.groupBy("conv_id", F.expr("pos div %d" % SEGMENT).alias("seg"), "total").agg(
        F.sort_array(F.collect_list(F.struct("pos", "id", "chars"))).alias("t"),
        F.bit_xor(z1).alias("z1"), F.bit_xor(z2).alias("z2")).select(
        "conv_id", "seg", "total", "z1", "z2",
        F.unhex(F.array_join(F.transform("t", lambda x: F.hex(x["id"])), "")).alias("ids"),
        F.unhex(F.array_join(F.transform("t", lambda x: F.lpad(F.hex(x["chars"]), 8, "0")), "")).alias("lens"))
    cut = written(cut, "segments")
    one = cut.where(F.col("total") <= SEGMENT).withColumn("a1", F.lit(0).cast("long")) \
        .withColumn("a2", F.lit(0).cast("long"))
    many = cut.where(F.col("total") > SEGMENT).withColumn("block", F.expr("seg div %d" % _BLOCK))
    blocks = many.groupBy("conv_id", "block").agg(F.bit_xor("z1").alias("z1"), F.bit_xor("z2").alias("z2"))

    def before(z: str, *keys: str, by: str) -> Column:
        w = Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.bit_xor(z).over(w), F.lit(0).cast("long"))

    outer = blocks.select("conv_id", "block", before("z1", "conv_id", by="block").alias("o1"),
                          before("z2", "conv_id", by="block").alias("o2"))
    inner = many.withColumn("i1", before("z1", "conv_id", "block", by="seg")) \
        .withColumn("i2", before("z2", "conv_id", "block", by="seg"))
    placed = inner.join(outer, ["conv_id", "block"]).withColumn("a1", F.col("i1").bitwiseXOR(F.col("o1"))) \
        .withColumn("a2", F.col("i2").bitwiseXOR(F.col("o2"))).select(*one.columns)
    return one.unionByName(placed).select(
        "conv_id", "seg", "a1", "a2", "ids", "lens", F.col("a1").bitwiseXOR(F.col("z1")).alias("e1"),
        F.col("a2").bitwiseXOR(F.col("z2")).alias("e2"),
        ((F.col("seg") + 1) * SEGMENT >= F.col("total")).alias("ends"))


# --- one run of keys -------------------------------------------------------------

class _Run:
    """The tree of one run of sorted keys below one anchor, and its nodes."""

    def __init__(self, seg: int, a1: int, a2: int, open_left: bool):
        self.depth0, self.a, self.open_left = seg * SEGMENT, (a1, a2), open_left
        self.tree, self.first, self.last, self.bytes = RadixTree(), None, None, 0

    def insert(self, ids: bytes, value: tuple) -> None:
        self.tree.insert(ids, value)
        self.first = ids if self.first is None else self.first
        self.last = ids
        self.bytes += len(ids)

    def rows(self, open_right: bool) -> dict[str, list]:
        """The nodes at turn-aligned depths.  A shared node's children, leaves and
        saved count what hangs on it by nodes that are not shared."""
        edges = ([self.first] if self.open_left else []) + ([self.last] if open_right else [])
        out: dict[str, list] = {f.name: [] for f in _ROW}
        h = xxhash.xxh64_intdigest
        # Down: every tree node with its path and the keys of its aligned depths.
        walk = [(self.tree.top, -1, b"", (self.a,))]
        order = []
        while walk:
            node, above, start, keys = walk.pop()
            path = start + node.prefix
            for d in range(len(keys), len(path) // WIDTH + 1):
                ident = path[(d - 1) * WIDTH:d * WIDTH]
                at = (self.depth0 + d - 1).to_bytes(8, "big")
                k1, k2 = keys[-1]
                keys += ((_signed((k1 ^ h(ident + at, SEED)) & _ALL), _signed((k2 ^ h(at + ident, SEED)) & _ALL)),)
            here = len(order)
            order.append((node, above, len(start), path, keys))
            for byte, kid in node.children():
                walk.append((kid, here, path + bytes([byte]), keys))
        # Up: [members, first, value of one key, children, leaves, saved, rows without parent].
        sums = [[0, None, None, 0, 0, 0, []] for _ in order]
        for here in range(len(order) - 1, -1, -1):
            node, above, start, path, keys = order[here]
            s = sums[here]
            if node.value is not None:
                n, first, ends, lens = node.value
                s[0] += n
                s[1] = first if s[1] is None else min(s[1], first)
                s[2] = node.value
            # Depths behind the branching byte; the byte itself is start's last one.
            low = 0 if above < 0 else (start - 1) // WIDTH
            for d in range(len(path) // WIDTH, low, -1):
                self._emit(out, s, d, path, keys, edges, node if d * WIDTH == len(path) else None)
            if above >= 0:
                t = sums[above]
                t[0] += s[0]
                t[1] = s[1] if t[1] is None else min(t[1], s[1])
                t[2] = s[2]
                t[3] += s[3]
                t[4] += s[4]
                t[5] += s[5]
                t[6] += s[6]
        top = sums[0]
        self._put(out, self.a, None, self.depth0, b"", 0, None, 0, top, True, bool(edges), False, (), ())
        return out

    def _emit(self, out, s, d, path, keys, edges, node) -> None:
        shared = any(e.startswith(path[:d * WIDTH]) for e in edges)
        chars = int.from_bytes(s[2][3][(d - 1) * 4:d * 4], "big")
        goes_on = node is not None and node.value is not None and d == SEGMENT and node.value[0] > node.value[2]
        if not shared:
            s[4] += 0 if s[3] or goes_on else 1
            s[5] += (s[0] - 1) * chars
        for row in s[6] if not shared else ():
            out["parent_conv_id"][row] = s[1]
        up = keys[d - 1::-1] if shared or goes_on else ()
        self._put(out, keys[d], keys[d - 1], self.depth0 + d, path[(d - 1) * WIDTH:d * WIDTH], s[0], s[1], chars, s, False,
                  shared, goes_on, [k[0] for k in up], [k[1] for k in up])
        if shared:
            s[3] = s[4] = s[5] = 0
            s[6] = []
        else:
            s[3] = 1
            s[6] = [len(out["k1"]) - 1]

    @staticmethod
    def _put(out, key, parent, depth, ident, n, first, chars, s, anchor, shared, goes_on, path1, path2) -> None:
        for name, v in zip(out, (key[0], key[1], parent and parent[0], parent and parent[1], depth, ident, n, first, chars,
                                 s[3], s[4], s[5], None, anchor, shared, goes_on, path1, path2), strict=True):
            out[name].append(v)


_ALL = (1 << 64) - 1


def _tree_grower(run_bytes: int):
    """Sorted distinct segments to the node rows of their runs."""
    def batch_of(run: _Run, open_right: bool) -> pa.RecordBatch:
        rows = run.rows(open_right)
        return pa.RecordBatch.from_arrays([pa.array(rows[f.name], f.type) for f in _ROW], schema=_ROW)

    def grow(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, key, opened = None, None, True
        for b in batches:
            for seg, a1, a2, ids, lens, n, first, ends in zip(*(b.column(i).to_pylist() for i in range(8)), strict=True):
                if key != (seg, a1, a2) or run.bytes >= run_bytes:
                    same = key == (seg, a1, a2)
                    if run is not None:
                        yield batch_of(run, same)
                        opened = same
                    run, key = _Run(seg, a1, a2, opened), (seg, a1, a2)
                run.insert(ids, (n, first, ends, lens))
        if run is not None:
            yield batch_of(run, True)

    return grow


# --- the trie ----------------------------------------------------------------------

def _tree_rows(segs: DataFrame, run_bytes: int) -> DataFrame:
    keys = segs.groupBy("seg", "a1", "a2", "ids", "lens").agg(
        F.count("*").alias("n"), F.min("conv_id").alias("first"), F.count_if("ends").alias("ends"))
    by = ["seg", "a1", "a2", "ids"]
    ranged = keys.repartitionByRange(*by).sortWithinPartitions(*by).select(*by, "lens", "n", "first", "ends")
    return written(map_batches(ranged, _tree_grower(run_bytes), _ROW_SQL, rows=5_000), "tree-nodes")


def _merged(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The shared nodes and the anchors, each in one row, with all that hangs on
    them inside their segment."""
    own = rows.where("shared or anchor").groupBy("anchor", "k1", "k2").agg(
        *[F.first(c).alias(c) for c in ("p1", "p2", "depth", "turn_id", "chars", "path1", "path2")],
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")],
        F.min("conv_id").alias("conv_id"), F.bool_or("goes_on").alias("goes_on"))
    # A shared node's parent is shared or the anchor; the anchor's own row has no parent.
    kids = own.where("not anchor").groupBy((F.size("path1") == 1).alias("anchor"), F.col("p1").alias("k1"),
                                           F.col("p2").alias("k2")).agg(F.count("*").alias("more"))
    own = own.join(kids, ["anchor", "k1", "k2"], "left").withColumn(
        "n_children", F.col("n_children") + F.coalesce("more", F.lit(0))).drop("more")
    childless = F.expr("not anchor and n_children = 0 and not goes_on").cast("long")
    own = written(own.withColumn("n_leaves", F.col("n_leaves") + childless).withColumn(
        "saved", F.col("saved") + F.expr("if(anchor, 0L, (n_convs - 1) * chars)")), "shared-nodes")
    above = own.where("not anchor").select("n_leaves", "saved", F.posexplode(F.arrays_zip("path1", "path2")),
                                           F.size("path1").alias("up"))
    added = above.groupBy((F.col("pos") == F.col("up") - 1).alias("anchor"), F.col("col.path1").alias("k1"),
                          F.col("col.path2").alias("k2")).agg(F.sum("n_leaves").alias("l"), F.sum("saved").alias("s"))
    whole = written(own.join(added, ["anchor", "k1", "k2"], "left").withColumn(
        "n_leaves", F.col("n_leaves") + F.coalesce("l", F.lit(0))).withColumn(
        "saved", F.col("saved") + F.coalesce("s", F.lit(0))).drop("l", "s"), "merged-nodes")
    return whole.where("not anchor").drop("anchor"), whole.where("anchor").select(
        "k1", "k2", "n_children", "n_leaves", "saved")


def _below_anchors(anchors: DataFrame, ends: DataFrame) -> DataFrame:
    """The anchors with the sums of all segments below: each step adds what the
    anchors at twice the distance have gathered."""
    jump = ends.select("k1", "k2", F.expr("element_at(path1, -1)").alias("j1"), F.expr("element_at(path2, -1)").alias("j2"))
    now = written(anchors.join(jump, ["k1", "k2"], "left"), "anchors")
    while now.where("j1 is not null").limit(1).count():
        add = now.where("j1 is not null").groupBy(F.col("j1").alias("k1"), F.col("j2").alias("k2")).agg(
            F.sum("n_leaves").alias("l"), F.sum("saved").alias("s"))
        far = now.select(F.col("k1").alias("j1"), F.col("k2").alias("j2"), F.col("j1").alias("f1"), F.col("j2").alias("f2"))
        now = written(now.join(add, ["k1", "k2"], "left").join(far, ["j1", "j2"], "left").select(
            "k1", "k2", "n_children", (F.col("n_leaves") + F.coalesce("l", F.lit(0))).alias("n_leaves"),
            (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"), F.col("f1").alias("j1"), F.col("f2").alias("j2")),
            "anchors")
    return now.select("k1", "k2", "n_children", "n_leaves", "saved")


def trie(turns: DataFrame, convs: DataFrame, run_bytes: int = RUN_BYTES) -> DataFrame:
    """The nodes of all conversations: ``k1, k2`` (key), ``p1, p2`` (parent's; the
    root's is null), ``depth, turn_id`` (the last turn's; empty for the root),
    ``chars`` (code points of its text), ``conv_id`` (smallest member),
    ``parent_conv_id, n_convs, n_children, n_leaves, saved`` and ``ends_sha256``.

    ``turns`` has conv_id, pos (from 0, without gaps), id, chars and total (turns of
    the conversation); ``convs`` conv_id and total, also of those without turns, each
    once.  No conversations give no nodes, turnless ones the root alone.
    """
    segs = written(segments(turns), "anchored-segments")
    rows = _tree_rows(segs, run_bytes)
    shared, anchors = _merged(rows)
    columns = ["k1", "k2", "p1", "p2", "depth", "turn_id", "n_convs", "conv_id", "chars", "n_children", "n_leaves", "saved",
               "parent_conv_id", "goes_on", "path1", "path2"]
    nodes = rows.where("not shared and not anchor").select(*columns).unionByName(
        shared.withColumn("parent_conv_id", F.lit(None).cast("long")).select(*columns))
    going = written(nodes.where("goes_on").select("k1", "k2", "path1", "path2", "conv_id"), "long-nodes")
    below = _below_anchors(anchors, going)
    # What lies behind a segment counts for its last node and for all nodes above it in the segment.
    ends = going.join(below, ["k1", "k2"])
    more = ends.select(F.explode(F.concat(
        F.array(F.struct("k1", "k2", F.col("n_children").alias("c"))),
        F.transform(F.expr("slice(arrays_zip(path1, path2), 1, size(path1) - 1)"),
                    lambda x: F.struct(x["path1"].alias("k1"), x["path2"].alias("k2"), F.lit(0).cast("long").alias("c"))),
    )).alias("x"), "n_leaves", "saved").groupBy("x.k1", "x.k2").agg(
        F.sum("x.c").alias("c"), F.sum("n_leaves").alias("l"), F.sum("saved").alias("s"))
    counts = ["n_children", "n_leaves", "saved"]
    root = convs.select(F.lit(1).cast("long").alias("n_convs"), "conv_id",
                        *[F.lit(0).cast("long").alias(c) for c in counts]).unionByName(
        below.where("k1 = 0 and k2 = 0").select(F.lit(0).cast("long").alias("n_convs"),
                                                F.lit(None).cast("long").alias("conv_id"), *counts)).agg(
        F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in counts]).where("n_convs > 0").withColumn("n_leaves", F.greatest("n_leaves", F.lit(1)))
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = root.select(zero.alias("k1"), zero.alias("k2"), none.alias("p1"), none.alias("p2"), zero.alias("depth"),
                       F.unhex(F.lit("")).alias("turn_id"), "n_convs", "conv_id", zero.alias("chars"), "n_children",
                       "n_leaves", "saved", none.alias("parent_conv_id"))
    grown = nodes.drop("goes_on", "path1", "path2").join(more, ["k1", "k2"], "left").withColumn(
        "n_children", F.col("n_children") + F.coalesce("c", F.lit(0))).withColumn(
        "n_leaves", F.col("n_leaves") + F.coalesce("l", F.lit(0))).withColumn(
        "saved", F.col("saved") + F.coalesce("s", F.lit(0))).drop("c", "l", "s").unionByName(root)
    parents = shared.select("k1", "k2", "conv_id").unionByName(going.select("k1", "k2", "conv_id")).unionByName(
        root.select("k1", "k2", "conv_id")).distinct().toDF("p1", "p2", "of_parent")
    member = member_digests(segs.where("ends").select("conv_id", F.col("e1").alias("k1"), F.col("e2").alias("k2"))
                            .unionByName(convs.where("total = 0").select("conv_id", zero.alias("k1"), zero.alias("k2"))))
    known = grown.where("parent_conv_id is not null or p1 is null")
    found = grown.where("parent_conv_id is null and p1 is not null").join(parents, ["p1", "p2"]).withColumn(
        "parent_conv_id", F.col("of_parent")).select(*known.columns)
    return known.unionByName(found).join(member, ["k1", "k2"], "left").withColumn(
        "ends_sha256", F.coalesce("sha", F.lit(hashlib.sha256().hexdigest()))).drop("sha")


def member_digests(members: DataFrame) -> DataFrame:
    """``k1, k2, sha``: the SHA-256 of a node's conv_ids, ascending, joined by commas.

    Sorted by ranges, so a node's members may lie in many tasks.  A task hashes the
    nodes that are its own; those at its edges, and large ones, are joined in pieces
    and the pieces hashed one after the other.
    """
    by = ["k1", "k2", "conv_id"]
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("at", pa.int64()), ("sha", pa.string()),
                        ("piece", pa.string())])

    def join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, length, cut = None, [], 0, True
        out: list[tuple] = []

        def close(cut: bool) -> None:
            text = ",".join(map(str, held))
            out.append((*key, held[0], None if cut else hashlib.sha256(text.encode()).hexdigest(), text if cut else None))

        for b in batches:
            for k1, k2, conv in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                if (k1, k2) != key:
                    if held:
                        close(cut)
                    cut = key is None
                    key, held, length = (k1, k2), [], 0
                elif length > _PIECE:
                    cut = True
                    close(True)
                    held, length = [], 0
                held.append(conv)
                length += 20
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in out], schema=schema)
            out.clear()
        if held:
            close(True)
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in out], schema=schema)

    def hash_pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("sha", pa.string())])
        key, digest = None, None
        for b in batches:
            done = []
            for k1, k2, piece in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                if (k1, k2) == key:
                    digest.update(b"," + piece.encode())
                    continue
                if key is not None:
                    done.append({"k1": key[0], "k2": key[1], "sha": digest.hexdigest()})
                key, digest = (k1, k2), hashlib.sha256(piece.encode())
            yield pa.RecordBatch.from_pylist(done, schema=whole)
        if key is not None:
            yield pa.RecordBatch.from_pylist([{"k1": key[0], "k2": key[1], "sha": digest.hexdigest()}], schema=whole)

    rows = written(map_batches(members.select(*by).repartitionByRange(*by).sortWithinPartitions(*by), join,
                               "k1 long, k2 long, at long, sha string, piece string", rows=10_000), "member-digests")
    pieces = rows.where("piece is not null").repartition("k1", "k2").sortWithinPartitions("k1", "k2", "at") \
        .select("k1", "k2", "piece")
    return rows.where("sha is not null").select("k1", "k2", "sha").unionByName(
        map_batches(pieces, hash_pieces, "k1 long, k2 long, sha string", rows=64))


def with_last_turn(nodes: DataFrame, conversations: DataFrame) -> DataFrame:
    """``nodes`` with the role and text of each node's last turn (root: null)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.select(turn_id(role, text).alias("turn_id"), role.alias("role"), text.alias("text"))
    return nodes.join(turns.dropDuplicates(["turn_id"]), "turn_id", "left")


def digests(nodes: DataFrame) -> DataFrame:
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                        F.col("saved").alias("saved_tokens"), "ends_sha256")
