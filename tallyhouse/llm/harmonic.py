"""Harmonic packing of tokenized documents into fixed-length sequences.

A piece of length ``n`` belongs to class ``k = capacity // n``: ``k`` pieces of
at most ``capacity // k`` tokens fill one sequence of that class, so a bin is
complete after a fixed count and needs no search.  Every worker (task) fills its
own bins, so no shuffle and no shared state is needed.

Documents may be cut.  A document longer than the capacity gives whole
sequences first.  What is left keeps its class if at most ``slack`` of the slot
stays empty; else a piece that fills a slot of the next class is cut off and the
rest (now far shorter) is treated alike.  Bins that are incomplete when a
worker's input ends are closed by laying their pieces end to end: full sequences
first, then sequences whose lengths are powers of two, which need no padding.
So padding is at most ``slack`` of the tokens plus ``k - 1`` tokens in a class
``k`` that doesn't divide the capacity, at every input size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import map_batches
from tallyhouse.llm.tokens import END_ID, worker_tokenizer

CAPACITY = 4096
SLACK = 1 / 64
VOCABULARY = "word_bpe_49k.json"

PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary()),
                    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
PIECES_DDL = "doc_id long, start long, ids binary, doc_tokens long, sequence_id long, offset long"


def cut_lengths(n: int, capacity: int = CAPACITY, slack: float = SLACK) -> list[int]:
    """The lengths of the pieces that a document of ``n`` tokens is cut into."""
    out = [capacity] * (n // capacity)
    n %= capacity
    while n:
        k = capacity // n
        slot = capacity // k
        if slot - n <= slack * slot:
            out.append(n)
            break
        out.append(capacity // (k + 1))
        n -= out[-1]
    return out


class Bins:
    """One worker's bins.  ``place`` and ``finish`` yield (piece, sequence, offset);
    a piece is (document, start, ids, tokens of the document).  Sequence numbers
    rise from ``first``."""

    def __init__(self, capacity: int, slack: float, first: int):
        self.capacity, self.slack, self.next = capacity, slack, first
        self.open: dict[int, list] = {}

    def _close(self, pieces: list) -> Iterator[tuple]:
        offset = 0
        for p in pieces:
            yield p, self.next, offset
            offset += len(p[2]) // 4
        self.next += 1

    def place(self, doc, ids: bytes) -> Iterator[tuple]:
        tokens, start = len(ids) // 4, 0
        for n in cut_lengths(tokens, self.capacity, self.slack):
            k = self.capacity // n
            slot = self.open.setdefault(k, [])
            slot.append((doc, start, ids[4 * start:4 * (start + n)], tokens))
            start += n
            if len(slot) == k:
                yield from self._close(self.open.pop(k))

    def finish(self) -> Iterator[tuple]:
        rest = [p for k in sorted(self.open) for p in self.open[k]]
        self.open = {}
        left = sum(len(p[2]) // 4 for p in rest)
        room, bin_ = 0, []
        for doc, start, ids, tokens in rest:
            while ids:
                if not room:   # a full sequence, or the largest power of two that is left
                    room = self.capacity if left >= self.capacity else 1 << (left.bit_length() - 1)
                n = min(room, len(ids) // 4)
                bin_.append((doc, start, ids[:4 * n], tokens))
                start, ids, room, left = start + n, ids[4 * n:], room - n, left - n
                if not room:
                    yield from self._close(bin_)
                    bin_ = []


def pack(docs: DataFrame, encode: Callable[[], Callable[[str | None], bytes]],
         capacity: int = CAPACITY, slack: float = SLACK) -> DataFrame:
    """Pieces of the packed documents: ``doc_id, start, ids`` (little-endian
    uint32)``, doc_tokens, sequence_id, offset``.

    ``encode()`` makes a worker's function from text to ids.  Other columns of
    ``docs`` are ignored, repeated rows and null doc_ids are packed like any row,
    null texts are empty, an empty table gives no pieces.  A document whose ids
    are empty has no piece.  Sequence ids are unique; they hold the task's number,
    so they depend on how the table is split, but not on retries.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = Bins(capacity, slack, TaskContext.get().partitionId() << 33)
        to_ids = encode()

        def rows(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([
                pa.array([p[0] for p, _, _ in found], pa.int64()),
                pa.array([p[1] for p, _, _ in found], pa.int64()),
                pa.array([p[2] for p, _, _ in found], pa.binary()),
                pa.array([p[3] for p, _, _ in found], pa.int64()),
                pa.array(np.array([s for _, s, _ in found], dtype=np.int64)),
                pa.array(np.array([o for _, _, o in found], dtype=np.int64))], schema=PIECES)

        for b in batches:
            found = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                found.extend(bins.place(doc, to_ids(text.as_py())))
                if len(found) >= 4096:
                    yield rows(found)
                    found = []
            yield rows(found)
        yield rows(list(bins.finish()))

    return map_batches(docs.select(F.col("doc_id").cast("long"), "text"), run, PIECES_DDL, rows=256)


def encode_with_end(vocabulary: str = VOCABULARY) -> Callable[[], Callable[[str | None], bytes]]:
    """Ids by a public vocabulary file, then the end id."""

    def make():
        tok = worker_tokenizer(vocabulary)
        end = np.array([END_ID], dtype="<u4").tobytes()
        return lambda text: tok.encode(text) + end

    return make


def digests(pieces: DataFrame) -> DataFrame:
    """The pieces with the checksum and length of their ids instead of the ids."""
    return pieces.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("length"),
                         F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
