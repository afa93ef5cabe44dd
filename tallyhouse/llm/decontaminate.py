"""Benchmark decontamination by one Aho-Corasick automaton.

Texts are normalised to words (A-Z lower-cased; digits, letters and everything
beyond ASCII belong to words).  The patterns are the windows of each benchmark
item; the automaton's alphabet are the words, numbered by the items' vocabulary,
so a text is scanned once, word by word, and a match's place is a range of word
numbers, which maps to offsets in the original text.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.common import map_batches, written

WINDOW = 13
SHARE = 20                  # contaminated: at least one word in so many is hit
BLOCK_BYTES = 32 << 20      # benchmark text that one automaton takes

# Separators (ASCII but for letters and digits) become spaces, A-Z become a-z.
_TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
                  for b in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TO_WORDS).split()


class Windows:
    """The automaton of some items' windows; ``items`` are (item_id, text)."""

    def __init__(self, items: Iterable[tuple[str, str | None]], window: int = WINDOW):
        self.number: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = tuple(self.number.setdefault(w, len(self.number) + 1) for w in words(text))
            size = min(window, len(ids))
            for at in range(len(ids) - size + 1 if size else 0):
                owners.setdefault(ids[at:at + size], set()).add(item)
        self.automaton = None
        if owners:
            self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
            for pattern, of in owners.items():
                self.automaton.add_word(pattern, (len(pattern), tuple(sorted(of))))
            self.automaton.make_automaton()

    def scan(self, found: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """The ranges of word numbers that windows cover, joined where they meet,
        and the items whose windows occur."""
        get = self.number.get
        ids = tuple([get(w, 0) for w in found])
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        if self.automaton is None or not any(ids):
            return spans, items
        for end, (size, of) in self.automaton.iter(ids):
            first, last = end + 1 - size, end + 1
            items.update(of)
            while spans and spans[-1][1] >= first:
                first = min(first, spans.pop()[0])
            spans.append((first, last))
        return spans, items


def offsets(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges of word numbers as code point ranges of the original text."""
    if not spans:
        return []
    places = [m.span() for m in _WORD.finditer(text)]
    return [(places[a][0], places[b - 1][1]) for a, b in spans]


RESULT = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
                       T.StructField("item_ids", T.ArrayType(T.StringType())),
                       T.StructField("spans", T.ArrayType(T.StructType([
                           T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])))])
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_RESULT = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("item_ids", pa.list_(pa.string())),
                     ("spans", pa.list_(_SPAN))])


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, str]]]:
    """The items in blocks of bounded size.  Spark deals them to blocks in a written
    table; the driver holds one block at a time."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text") \
        .where("item_id is not null and text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(size / block_bytes))
    dealt = written(items.repartition(n).select(F.spark_partition_id().alias("block"), "item_id", "text"), "benchmark")
    for block in range(n):
        yield [(r.item_id, r.text) for r in dealt.where(F.col("block") == block).collect()]


def overlaps(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, result: str = "overlap",
             block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with a struct column ``result``: n_words, n_hit (words inside any
    occurrence of a window), item_ids (sorted strings), spans (code points).

    All columns of ``docs`` stay (one of the result's name is replaced).  Null and
    empty texts have no words; items without words, text or item_id are passed over;
    repeated rows are scanned each; empty tables give no rows or no hits.

    The benchmark's text goes to every task, at most ``block_bytes`` of it: a
    larger one is taken in blocks, each by a pass of its own over written tables.
    """
    kept = [c for c in docs.columns if c.lower() != result.lower()]
    for k, block in enumerate(_blocks(benchmark, block_bytes)):
        docs = _scan(docs.select(*kept, *([result] if k else [])), block, window, result)
        if len(block) and k:
            docs = written(docs, "overlaps")
    return docs


def _scan(docs: DataFrame, items: list[tuple[str, str]], window: int, result: str) -> DataFrame:
    again = result in docs.columns
    text_at = docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(items)
    schema = T.StructType([f for f in docs.schema.fields if f.name != result] + [T.StructField(result, RESULT)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(shared.value, window)
        for b in batches:
            columns = list(b.columns)
            before = columns.pop() if again else [None] * b.num_rows
            rows = []
            for t, old in zip(b.column(text_at), before, strict=True):
                text = t.as_py()
                found = words(text)
                spans, of = windows.scan(found)
                hit = sum(e - s for s, e in spans)
                spans = offsets(text, spans)
                if again:
                    old = old.as_py()
                    spans = _merge(spans + [(x["start"], x["end"]) for x in old["spans"]])
                    of.update(old["item_ids"])
                    hit = sum(len(_WORD.findall(text, s, e)) for s, e in spans)
                rows.append({"n_words": len(found), "n_hit": hit, "item_ids": sorted(of),
                             "spans": [{"start": s, "end": e} for s, e in spans]})
            names = [n for n in b.schema.names if n != result] + [result]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(rows, _RESULT)], names=names)

    return map_batches(docs, run, schema)


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def contaminated(result: str = "overlap", share: int = SHARE) -> F.Column:
    r = F.col(result)
    return (r["n_hit"] > 0) & (share * r["n_hit"] >= r["n_words"])


def digests(found: DataFrame, result: str = "overlap") -> DataFrame:
    r = F.col(result)
    return found.select("doc_id", r["n_words"].alias("n_words"), r["n_hit"].alias("n_hit"),
                        F.size(r["item_ids"]).cast("long").alias("n_items"),
                        F.sha2(F.array_join(r["item_ids"], ","), 256).alias("items_sha256"),
                        contaminated(result).alias("contaminated"))


def oracle_sql(window: int = WINDOW, share: int = SHARE) -> str:
    """The digests stated for DuckDB."""
    found = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
             r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
    return f"""
with d as (select row_number() over () as r, doc_id, {found} as w from documents),
i as (
  select item_id::varchar as item_id, w, least(len(w), {window}) as size
  from (select item_id, {found} as w from benchmark where item_id is not null) where len(w) > 0),
iw as (
  select distinct item_id, size, array_to_string(list_slice(w, p, p + size - 1), ' ') as g
  from (select *, unnest(generate_series(1, len(w) - size + 1)) as p from i)),
dw as (
  select r, p, size, array_to_string(list_slice(w, p, p + size - 1), ' ') as g
  from (select r, w, size, unnest(generate_series(1, len(w) - size + 1)) as p
        from d, (select distinct size from iw) where len(w) >= size)),
hit as (select r, p, size, item_id from dw join iw using (size, g)),
words as (
  select r, count(*) as n_hit from (
    select distinct r, unnest(generate_series(p, p + size - 1)) as place from hit) group by r),
items as (
  select r, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
  from (select distinct r, item_id from hit) group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(ids, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and {share} * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join words using (r) left join items using (r)"""
