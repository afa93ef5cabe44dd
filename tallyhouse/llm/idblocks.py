"""Token-id files of patched frame-of-reference blocks.

File layout, little-endian throughout:

    magic ``TIDB1\\0\\0\\0``
    blocks        one after the other (ids, then the document table's columns)
    index         uint64 start of each block
    footer        uint64: start of the index, id blocks, ids, documents, and how
                  many of these, the first ones, have no doc_id; magic

A stream of unsigned numbers (the ids of all documents one after the other, then
the documents' lengths, then their doc_ids as gaps) is cut into blocks of 128.
A block subtracts its minimum and packs the differences at a width chosen by
percentile: the fewest bits that hold ``PERCENTILE`` of them.  The outliers'
high bits stand in an exception list:

    uint64 minimum | uint8 count - 1 | uint8 width | uint8 exceptions | uint8 0
    packed differences (low bits) | uint8 places | uint64 high bits

As the index has every block's start, a reader seeks to any id or document.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import map_batches, written
from tallyhouse.session import scratch_path

MAGIC = b"TIDB1\0\0\0"
BLOCK = 128
PERCENTILE = 0.9
FILE_IDS = 1 << 24          # ids after which a task starts its next file
_CHUNK = BLOCK * 512        # numbers that are packed at once
_HEAD = np.dtype([("low", "<u8"), ("n", "u1"), ("width", "u1"), ("odd", "u1"), ("zero", "u1")])

_BIT_LENGTHS = np.uint64(1) << np.arange(64, dtype=np.uint64)


def _room(width: int) -> int:
    """The bytes of the smallest number type that holds so many bits."""
    return next(b for b in (1, 2, 4, 8) if width <= 8 * b)


def _bit_length(x: np.ndarray) -> np.ndarray:
    if x.max() < 1 << 53:                                # exact as doubles, whose exponents tell
        return np.maximum((x.astype(np.float64).view(np.int64) >> 52) - 1022, 0).astype(np.uint8)
    return np.searchsorted(_BIT_LENGTHS, x, side="right").astype(np.uint8)


def _words(width: int) -> Iterator[tuple[int, int, int]]:
    """For each of 64 packed numbers the 64-bit word that its lowest bit is in, the bit's
    place there, and how many bits run over into the next word."""
    for k in range(64):
        word, shift = divmod(k * width, 64)
        yield word, shift, max(0, shift + width - 64)


def _pack_full(rest: np.ndarray, width: int) -> np.ndarray:
    """Whole blocks (a row each) packed at ``width``: 64 numbers fill that many words."""
    if width in (8, 16, 32, 64):
        return rest.astype(f"<u{width // 8}").view(np.uint8)
    low = np.uint64((1 << width) - 1)
    columns = np.ascontiguousarray((rest & low).reshape(-1, 64).T)
    words = np.zeros((width, columns.shape[1]), dtype=np.uint64)
    for v, (word, shift, over) in zip(columns, _words(width), strict=True):
        words[word] |= v << np.uint64(shift)
        if over:
            words[word + 1] |= v >> np.uint64(width - over)
    return np.ascontiguousarray(words.T).astype("<u8").view(np.uint8).reshape(len(rest), -1)


def _unpack_full(raw: np.ndarray, width: int) -> np.ndarray:
    """The numbers of whole blocks' packed bytes (a row each)."""
    if width in (8, 16, 32, 64):
        return np.ascontiguousarray(raw).view(f"<u{width // 8}").astype(np.uint64)
    low = np.uint64((1 << width) - 1)
    words = np.ascontiguousarray(np.ascontiguousarray(raw).view("<u8").astype(np.uint64, copy=False).reshape(-1, width).T)
    columns = np.empty((64, words.shape[1]), dtype=np.uint64)
    for v, (word, shift, over) in zip(columns, _words(width), strict=True):
        np.right_shift(words[word], np.uint64(shift), out=v)
        if over:
            v |= words[word + 1] << np.uint64(width - over)
    columns &= low
    return np.ascontiguousarray(columns.T).reshape(len(raw), BLOCK)


def encode_blocks(values: np.ndarray, percentile: float = PERCENTILE) -> list[bytes]:
    """The blocks of an array of unsigned numbers."""
    out: list[bytes] = []
    for at in range(0, len(values), _CHUNK):
        out += _encode_chunk(np.asarray(values[at:at + _CHUNK], dtype=np.uint64), percentile)
    return out


def _encode_chunk(v: np.ndarray, percentile: float) -> list[bytes]:
    full = len(v) // BLOCK * BLOCK
    out: list[bytes] = []
    for part in (v[:full].reshape(-1, BLOCK), v[full:].reshape(1, -1)):
        if not part.size:
            continue
        n = part.shape[1]
        low = part.min(axis=1)
        rest = part - low[:, None]
        bits = _bit_length(rest.ravel()).reshape(rest.shape)
        at = min(n - 1, int(np.ceil(percentile * n)) - 1)
        widths = np.partition(bits, at, axis=1)[:, at]
        odd = bits > widths[:, None]
        packed: list[bytes] = [b""] * len(part)
        for w in np.unique(widths[widths > 0]):
            which = np.flatnonzero(widths == w)
            if n == BLOCK:
                for k, row in zip(which.tolist(), _pack_full(rest[which], int(w)), strict=True):
                    packed[k] = row.tobytes()
                continue
            room = _room(int(w))
            raw = np.unpackbits(rest[which].astype(f"<u{room}").view(np.uint8).reshape(len(which), n, room), axis=2,
                                count=int(w), bitorder="little")
            for k, row in zip(which, np.packbits(raw.reshape(len(which), -1), axis=1, bitorder="little"), strict=True):
                packed[k] = row.tobytes()
        heads = np.zeros(len(part), dtype=_HEAD)
        heads["low"], heads["n"], heads["width"], heads["odd"] = low, n - 1, widths, odd.sum(axis=1)
        of, places = np.nonzero(odd)
        high = (rest[of, places] >> widths[of].astype(np.uint64)).astype("<u8")
        places = places.astype(np.uint8)
        ends = np.cumsum(heads["odd"], dtype=np.int64).tolist()
        begin = 0
        heads, size, places, high = heads.tobytes(), _HEAD.itemsize, places.tobytes(), high.tobytes()
        for k, (body, end) in enumerate(zip(packed, ends, strict=True)):
            out.append(heads[size * k:size * k + size] + body + places[begin:end] + high[8 * begin:8 * end])
            begin = end
    return out


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one after the other."""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))


def decode_blocks(raw: bytes, starts: np.ndarray) -> np.ndarray:
    """The numbers of the blocks that start at ``starts`` in ``raw``."""
    data = np.frombuffer(raw, np.uint8)
    heads = data[starts[:, None] + np.arange(_HEAD.itemsize)].view(_HEAD).ravel()
    counts = heads["n"].astype(np.int64) + 1
    widths = heads["width"].astype(np.int64)
    sizes = (counts * widths + 7) // 8
    out = np.zeros((len(starts), BLOCK), dtype=np.uint64)
    body = starts + _HEAD.itemsize
    for n, w in {*zip(counts.tolist(), widths.tolist(), strict=True)}:
        if not w:
            continue
        same = np.flatnonzero((counts == n) & (widths == w))
        if n == BLOCK:
            out[same] = _unpack_full(data[body[same][:, None] + np.arange(n * w // 8)], w)
            continue
        for which in np.array_split(same, -(-len(same) // 512)):
            bits = np.unpackbits(data[body[which][:, None] + np.arange((n * w + 7) // 8)], axis=1,
                                 count=n * w, bitorder="little").reshape(len(which), n, w)
            room = _room(w)
            padded = np.zeros((len(which), n, 8 * room), np.uint8)
            padded[:, :, :w] = bits
            out[which, :n] = np.packbits(padded, axis=2, bitorder="little").view(f"<u{room}")[:, :, 0]
    odd = heads["odd"].astype(np.int64)
    at = body + sizes
    of = np.repeat(np.arange(len(starts)), odd)
    high = np.frombuffer(data[_ranges(at + odd, 8 * odd)].tobytes(), "<u8") << widths[of].astype(np.uint64)
    out[of, data[_ranges(at, odd)]] |= high
    out += heads["low"][:, None]
    return out.ravel() if (counts == BLOCK).all() else out[np.arange(BLOCK) < counts[:, None]]


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with its scheme: without one it is on Spark's default file system."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()


def filesystem(folder: str) -> tuple[pafs.FileSystem, str]:
    """The store and path of a folder; a path without a scheme is a local one."""
    if folder.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + folder[len("file:"):].lstrip("/")
    return pafs.FileSystem.from_uri(folder) if "://" in folder else (pafs.LocalFileSystem(), folder)


class IdFileWriter:
    """Writes one file; ids are packed as they come, so memory holds the numbers of
    the documents alone (lengths and doc_ids) and less than a chunk of ids."""

    def __init__(self, fs: pafs.FileSystem, path: str):
        self.out = fs.open_output_stream(path)
        self.at = self.out.write(MAGIC) or len(MAGIC)
        self.starts: list[int] = []
        self.lengths: list[int] = []
        self.doc_ids: list[int] = []
        self.ids = self.nameless = 0
        self.rest = np.zeros(0, dtype="<u4")

    def _blocks(self, values: np.ndarray) -> None:
        for b in encode_blocks(values):
            self.starts.append(self.at)
            self.out.write(b)
            self.at += len(b)

    def add(self, docs: list[tuple[int, bytes]]) -> None:
        for doc, ids in docs:
            self.nameless += doc is None
            self.doc_ids.append(doc or 0)
            self.lengths.append(len(ids) // 4)
        new = np.frombuffer(b"".join(ids for _, ids in docs), "<u4")
        self.ids += len(new)
        v = np.concatenate([self.rest, new])
        full = len(v) // BLOCK * BLOCK
        self._blocks(v[:full])
        self.rest = v[full:].copy()

    def close(self) -> None:
        self._blocks(self.rest)
        id_blocks = len(self.starts)
        self._blocks(np.array(self.lengths, dtype=np.uint64))
        ids = np.array(self.doc_ids, dtype=np.int64)
        self._blocks(np.diff(ids, prepend=np.int64(0)).view(np.uint64))   # gaps, modulo 2**64
        tail = io.BytesIO()
        tail.write(np.array(self.starts + [self.at], dtype="<u8").tobytes())
        tail.write(np.array([self.at, id_blocks, self.ids, len(ids), self.nameless], dtype="<u8").tobytes() + MAGIC)
        self.out.write(tail.getvalue())
        self.out.close()


class IdFile:
    """Reads one file through its index."""

    def __init__(self, fs: pafs.FileSystem, path: str):
        self.file = fs.open_input_file(path)
        size = self.file.size()
        foot = self.file.read_at(48, size - 48)
        if foot[40:] != MAGIC:
            raise ValueError(f"not a token-id file: {path}")
        index, self.id_blocks, self.n_ids, self.n_docs, self.nameless = np.frombuffer(foot, "<u8", 5).tolist()
        self.starts = np.frombuffer(self.file.read_at(size - 48 - index, index), "<u8").astype(np.int64)

    def numbers(self, first: int, last: int) -> np.ndarray:
        """The numbers of blocks ``first`` to ``last`` (exclusive), read at once."""
        if first >= last:
            return np.zeros(0, dtype=np.uint64)
        at = self.starts[first:last + 1]
        raw = self.file.read_at(int(at[-1] - at[0]), int(at[0]))
        return decode_blocks(raw, at[:-1] - at[0])

    def ids(self, first: int, count: int) -> np.ndarray:
        """``count`` ids from the ``first`` on, by way of the block index."""
        block = first // BLOCK
        v = self.numbers(block, -(-(first + count) // BLOCK)) if count else np.zeros(0, np.uint64)
        return v[first - block * BLOCK:][:count].astype("<u4")

    def documents(self) -> tuple[np.ndarray, np.ndarray]:
        """doc_ids and lengths."""
        per = -(-self.n_docs // BLOCK)
        lengths = self.numbers(self.id_blocks, self.id_blocks + per)
        gaps = self.numbers(self.id_blocks + per, self.id_blocks + 2 * per)
        return np.cumsum(gaps.view(np.int64)), lengths.astype(np.int64)

    def rows(self, run: int = 1 << 18) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, ids before it in this file, ids), a run of blocks at a time."""
        docs, lengths = self.documents()
        ends = np.cumsum(lengths)
        at = 0
        while at < len(docs):
            begin = int(ends[at] - lengths[at])
            last = max(at + 1, int(np.searchsorted(ends, begin + run, side="right")))
            v = self.ids(begin, int(ends[last - 1]) - begin)
            for k in range(at, last):
                stop = int(ends[k]) - begin
                yield None if k < self.nameless else int(docs[k]), int(ends[k] - lengths[k]), v[stop - int(lengths[k]):stop]
            at = last


FILES = "path string, part int, file int, n_ids long, n_docs long"
_FILES = pa.schema([("path", pa.string()), ("part", pa.int32()), ("file", pa.int32()),
                    ("n_ids", pa.int64()), ("n_docs", pa.int64())])


def write_files(docs: DataFrame, folder: str, encode: Callable[[], Callable[[str | None], bytes]],
                partitions: int | None = None, file_ids: int = FILE_IDS) -> DataFrame:
    """Write the ids of all documents under ``folder`` in ascending doc_id order;
    returns the list of files, itself a written table (one row a file).

    Tasks hold ranges of doc_ids and start a new file after ``file_ids`` ids.  A
    file's name has its attempt in it, and only files of finished tasks are in the
    list, so a task that is run again does no harm.  Ties of doc_id stand in the
    order of their texts' hashes, rows without doc_id come first, null texts are empty, an
    empty table gives no file.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    n = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    # A doc_id of very many rows is parted by the hash of their texts.
    by = ["doc_id", F.xxhash64("text")]
    ordered = rows.repartitionByRange(n, *by).sortWithinPartitions(*by, "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        part, to_ids, writer, path, count = TaskContext.get().partitionId(), None, None, "", 0

        def done() -> pa.RecordBatch:
            writer.close()
            return pa.RecordBatch.from_pylist([{"path": path, "part": part, "file": count, "n_ids": writer.ids,
                                                "n_docs": len(writer.doc_ids)}], schema=_FILES)

        for b in batches:
            if to_ids is None:
                fs.create_dir(root, recursive=True)
                to_ids = encode()
            encoded = [(d, to_ids(t.as_py())) for d, t in zip(b.column(0).to_pylist(), b.column(1), strict=True)]
            if encoded and writer is None:
                path = f"{root}/part-{part:06d}-{count:04d}-{uuid.uuid4().hex}.tidb"
                writer = IdFileWriter(fs, path)
            if encoded:
                writer.add(encoded)
            if writer is not None and writer.ids >= file_ids:
                yield done()
                writer, count = None, count + 1
        if writer is not None:
            yield done()

    return written(map_batches(ordered, run, FILES, rows=256), "id-files")


ROWS = "doc_id long, start long, ids binary"
_ROWS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())])


def read_files(files: DataFrame, folder: str) -> DataFrame:
    """The documents of the listed files: doc_id, the ids of all documents before
    it, its ids (little-endian uint32).  Files are read by tasks, a run of blocks
    at a time; the sum of the ids before each file is taken over the list alone."""
    before = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    listed = files.select("path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long").alias("base"))
    n = max(1, int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def batch(got: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([row[k] for row in got], f.type) for k, f in enumerate(_ROWS)], schema=_ROWS)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = filesystem(folder)
        for b in batches:
            for path, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                got, size = [], 0
                for doc, start, ids in IdFile(fs, path).rows():
                    got.append((doc, base + start, ids.tobytes()))
                    size += 4 * len(ids)
                    if size > 4 << 20:
                        yield batch(got)
                        got, size = [], 0
                yield batch(got)

    return map_batches(listed.repartition(n, "path"), run, ROWS)


def id_files(docs: DataFrame, encode: Callable[[], Callable[[str | None], bytes]]) -> DataFrame:
    """Write the documents' id files to the shared folder and read them back."""
    folder = qualified(docs.sparkSession, scratch_path(docs.sparkSession, "token-ids"))
    return read_files(write_files(docs, folder, encode), folder)


def digests(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.crc32("ids").alias("ids_crc32"))
