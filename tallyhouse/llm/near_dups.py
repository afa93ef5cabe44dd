"""SimHash near duplicates by deletion-variant signatures.

Two 64-bit fingerprints that differ in at most two bits agree, but for at most
one bit, in one of their two 32-bit halves.  So each distinct fingerprint is
indexed under 64 keys: a half with one of its 32 bits wiped out.  Fingerprints
that differ by at most one bit in a half meet under such a key (equality join)
and are verified by their full distance.

Fingerprints that crowd in one half (large groups of near copies) would meet in
squares.  A key with more than ``crowd`` fingerprints is not compared by pairs:
its fingerprints are indexed whole instead, each under itself and its 64
one-bit neighbours.  Two fingerprints share such a neighbour exactly if they
differ in at most two bits, and a neighbour has at most 65 fingerprints, so
links of the crowd stay complete and linear in number.

Spark sizes exploded rows like those they come from, 64 times too low, and written
ones by their compressed files.  Joins of either name a sort-merge join, so that no
such table is sent to the driver and broadcast.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import map_batches, written
from tallyhouse.llm.components import components

SHINGLE = 3
SEED = 42
DISTANCE = 2
CROWD = 32
_RUN = 1 << 16               # shingles that are counted at once


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint: a bit is set if it is set in over half of the
    shingles' hashes.  A-Z are lower-cased, words are runs without space and ASCII
    control 9 to 13; fewer words than a shingle form one; none: 0 (null, too)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    first, last = starts[:len(words) - k + 1], ends[k - 1:]
    counts = np.zeros(64, dtype=np.int64)
    h = xxhash.xxh64_intdigest
    for at in range(0, len(first), _RUN):
        run = [h(joined[a:b], SEED) for a, b in zip(first[at:at + _RUN].tolist(), last[at:at + _RUN].tolist(),
                                                    strict=True)]
        bits = np.unpackbits(np.array(run, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(first), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, text_key, fp``: text_key is a hash of the text, to tell apart rows
    of one doc_id; fp is the fingerprint as a signed number."""
    out = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in b.column(2)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps.view(np.int64))], schema=out)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"), "text")
    return map_batches(rows, run, "doc_id long, text_key long, fp long")


def text_key() -> F.Column:
    return F.xxhash64("text")


def variants(fps: DataFrame) -> DataFrame:
    """``key, fp``: the 64 one-wildcard halves of each fingerprint.  A key holds the
    wiped bit's number (0 to 63, so the half, too) and the half without it."""
    low, high = "(fp & 4294967295L)", "shiftrightunsigned(fp, 32)"
    return fps.select("fp", F.expr(
        f"explode(transform(sequence(0, 63), j -> shiftleft(cast(j as bigint), 32) | "
        f"if(j < 32, {low} & ~shiftleft(1L, j), {high} & ~shiftleft(1L, j - 32))))").alias("key"))


# Under one key, pairs are told apart by the wiped bit; a pair whose halves are
# equal meets under all 32 keys of the half, and counts under the first alone.
_ONCE = ("(a.fp < b.fp) and bit_count(a.fp ^ b.fp) <= {d} and "
         "(pmod(shiftright(a.key, 32), 32) = 0 or "
         "(shiftright(a.fp ^ b.fp, cast(shiftright(a.key, 32) as int)) & 1L) = 1)")


def links(fps: DataFrame, crowd: int = CROWD) -> DataFrame:
    """``a, b``: links that connect all distinct fingerprints (column fp) which
    differ in at most two bits.  Every linked pair below ``crowd`` is listed; in a
    crowd, a neighbour's fingerprints are linked to its smallest."""
    keys = variants(fps)
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = written(keys.join(shared.hint("merge"), "key"), "shared-keys")
    few = members.where(F.col("n") <= crowd).select("key", "fp")
    pairs = few.alias("a").join(few.alias("b").hint("merge"), F.expr("a.key = b.key and " + _ONCE.format(d=DISTANCE))) \
        .select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))
    crowded = members.where(F.col("n") > crowd).select("fp").distinct()
    near = crowded.select("fp", F.expr(
        "explode(transform(sequence(0, 64), j -> if(j = 64, fp, fp ^ shiftleft(1L, j))))").alias("near"))
    least = near.groupBy("near").agg(F.min("fp").alias("least"), F.max("fp").alias("most")).where("least < most")
    stars = near.join(least.hint("merge"), "near").where("fp > least").select(F.col("least").alias("a"), F.col("fp").alias("b"))
    return pairs.unionByName(stars).distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, crowd: int = CROWD) -> DataFrame:
    """``doc_id, text_key, fp, label, component_id`` for each row of ``docs``.

    label is the component's smallest fingerprint (as a signed number),
    component_id its smallest doc_id; it is null only if no row of the component
    has a doc_id.  Rows of equal doc_id are separate documents here; equal texts
    (null and empty alike) have equal fingerprints.  An empty table gives none.
    """
    rows = written(fingerprints(docs, shingle), "fingerprints")
    distinct = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    found = components(links(distinct, crowd)).withColumnRenamed("node", "fp")
    labelled = distinct.join(found, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    smallest = labelled.groupBy("label").agg(F.min("first_id").alias("component_id"))
    by_fp = written(labelled.select("fp", "label").join(smallest, "label"), "classes")
    return rows.join(by_fp, "fp").select("doc_id", "text_key", "fp", "label", "component_id")


def digests(classes: DataFrame) -> DataFrame:
    return classes.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` with one document of each component: that of the
    smallest doc_id (rows without doc_id last), of several such rows the one with the
    smallest hash of its text, and one of equal rows.  All columns stay."""
    classes = near_duplicates(docs, **options)
    first = classes.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id",
                                                        "text_key")).alias("first"))
    kept = written(first.select(F.col("first.doc_id").alias("kept_id"), F.col("first.text_key").alias("kept_key")),
                   "kept")
    columns = docs.columns
    keyed = docs.withColumn("kept_key", text_key())
    on = keyed["doc_id"].eqNullSafe(kept["kept_id"]) & (keyed["kept_key"] == kept["kept_key"])
    rest = keyed.join(kept, on, "left_semi")
    return rest.dropDuplicates(["doc_id", "kept_key"]).select(*columns)
