"""Secret scans: fixed forms, and a randomness test battery for the rest.

Runs of 20 or more characters of the usual encodings are candidates.  For each,
the encoding is inferred from its characters, and three tests compare it with
ordinary text written in that alphabet:

* chi-squared of the characters' uniformity.  Ordinary text is far from uniform,
  so its statistic follows a noncentral distribution whose centre grows with the
  length; a random string's is small.  The lower tail is the first p-value.
* runs: changes between small letters, capitals, digits and signs.  Ordinary
  names change rarely; the upper binomial tail is the second p-value.  Where the
  encoding has one class alone the test says nothing and is left out.
* lag-one serial correlation, of vowels and consonants: in words they alternate,
  in a random string neighbours know nothing of each other.  The lower binomial
  tail of the alternations among neighbouring letters is the third p-value; it is
  left out where the alphabet's letters end at F.

How often ordinary text repeats a character or changes class depends on the
encoding, so each has its own rates.  Serial correlation of the codes beyond
chance, and too even a spread, strike out sequences such as alphabets, counters
and repeated blocks (p-value 1).

Fisher's method joins the p-values.  The false-discovery rate is controlled by
Benjamini and Hochberg's rule over the candidates of the whole table, apart for
each class of lengths, as short strings are many and say little.  The p-values
are counted in fine logarithmic bins, so only these counts are gathered, and
every candidate of a bin is judged by the bin's larger edge.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.common import map_batches

KINDS = ("assign", "access", "hex", "random")

# Fixed forms.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.I | re.A)
_ASSIGN_HINTS = ("passw", "secret", "token", "key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")

_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
# Encodings: name, characters, alphabet size; in ordinary text written in it, the
# coincidence rate, the rate of class changes and of vowel changes (None: no test).
_ENCODINGS = (
    ("hex", re.compile(r"[0-9a-f]+|[0-9A-F]+"), 16, 0.1, 0.2, None),
    ("letters of one case", re.compile(r"[a-z]+|[A-Z]+"), 26, 0.06, None, 0.6),
    ("base32", re.compile(r"[A-Z2-7]+"), 32, 0.055, 0.12, 0.6),
    ("base36", re.compile(r"[a-z0-9]+|[A-Z0-9]+"), 36, 0.055, 0.2, 0.6),
    ("letters", re.compile(r"[A-Za-z]+"), 52, 0.05, 0.3, 0.6),
    ("base62", re.compile(r"[A-Za-z0-9]+"), 62, 0.05, 0.3, 0.6),
    ("base64", re.compile(r"[A-Za-z0-9+/_-]+"), 66, 0.05, 0.3, 0.6),
)
_VOWELS = frozenset("aeiouAEIOU")
VETO = 1e-3            # level of the tests that strike out sequences
FDR = 0.01
LENGTHS = (20, 32, 64)  # where the classes of lengths begin
BINS_PER_DECADE, LAST_BIN = 20, 800


def _normal(z: float) -> float:
    return 0.5 * math.erfc(-z / math.sqrt(2))


def chi_squared_below(x: float, df: int, shift: float = 0.0) -> float:
    """P(X <= x) of the (noncentral) chi-squared law, by Sankaran's approximation."""
    if x <= 0:
        return 0.0
    s = df + shift
    h = 1 - 2 * s * (df + 3 * shift) / (3 * (df + 2 * shift) ** 2)
    p = (df + 2 * shift) / s ** 2
    m = (h - 1) * (1 - 3 * h)
    mean = 1 + h * p * (h - 1 - 0.5 * (2 - h) * m * p)
    return _normal(((x / s) ** h - mean) / (h * math.sqrt(2 * p) * (1 + 0.5 * m * p)))


def binomial_at_least(k: int, n: int, rate: float) -> float:
    """P(X >= k), exact for short strings, by the normal law for long ones."""
    if k <= 0:
        return 1.0
    if n > 400:
        return _normal((n * rate + 0.5 - k) / math.sqrt(n * rate * (1 - rate)))
    return min(1.0, sum(math.comb(n, i) * rate ** i * (1 - rate) ** (n - i) for i in range(k, n + 1)))


def _class(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


def _fisher(ps: list[float]) -> float:
    """Fisher's joint p-value of independent ones."""
    half = -sum(math.log(max(p, 1e-30)) for p in ps)
    return math.exp(-half) * sum(half ** i / math.factorial(i) for i in range(len(ps)))


def random_p(candidate: str) -> float:
    """The joint p-value that the string is ordinary text; small: it looks random."""
    body = candidate.strip("=-_+/")
    n = len(body)
    counts = Counter(body)
    if n < LENGTHS[0] or body.isdigit() or sum(v for c, v in counts.items() if c.isalnum()) < 0.75 * n:
        return 1.0
    _, _, size, rate, changing, alternating = next((e for e in _ENCODINGS if e[1].fullmatch(body)), _ENCODINGS[-1])
    chi = size * sum(v * v for v in counts.values()) / n - n
    if chi_squared_below(chi, size - 1) < VETO:
        return 1.0
    codes = [ord(c) for c in body]
    mean = sum(codes) / n
    var = sum((x - mean) ** 2 for x in codes)
    if not var:
        return 1.0
    pairs = list(zip(body, body[1:], strict=False))
    r = sum((ord(a) - mean) * (ord(b) - mean) for a, b in pairs) / var
    if 2 * _normal(-abs(r * math.sqrt(n) + 1 / math.sqrt(n))) < VETO:
        return 1.0
    ps = [chi_squared_below(chi, size - 1, n * (size * rate - 1))]
    if changing is not None:
        ps.append(binomial_at_least(sum(_class(a) != _class(b) for a, b in pairs), n - 1, changing))
    if alternating is not None:
        letters = [(a in _VOWELS, b in _VOWELS) for a, b in pairs if a.isalpha() and b.isalpha()]
        # at most k changes: at least m - k neighbours of one kind
        ps.append(binomial_at_least(sum(a == b for a, b in letters), len(letters), 1 - alternating))
    return _fisher(ps)


def p_bin(p: float) -> int:
    """Bins count from 0 (p of 1) upwards; a bin's p-values are at most its edge."""
    return LAST_BIN if p <= 0 else min(LAST_BIN, int(-math.log10(p) * BINS_PER_DECADE))


def length_class(n: int) -> int:
    return sum(n >= x for x in LENGTHS) - 1


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's place, end) of the fixed forms, in code points."""
    out = []
    low = text.lower()
    if any(h in low for h in _ASSIGN_HINTS):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def candidates(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int, int]]:
    """(start, end, class of length, bin) of each run that no fixed form covers."""
    for m in _CANDIDATE.finditer(text):
        s, e = m.span()
        if not any(b <= s and e <= f for b, _, f in base):
            yield s, e, length_class(e - s), p_bin(random_p(m[0]))


def thresholds(docs: DataFrame, rate: float = FDR) -> dict[int, int]:
    """The smallest accepted bin for each class of lengths, over all of ``docs``."""
    out = pa.schema([("length_class", pa.int32()), ("bin", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in batches:
            for t in b.column(0):
                text = t.as_py() or ""
                seen.update((c, k) for _, _, c, k in candidates(text, base_spans(text)))
        yield pa.RecordBatch.from_pylist([{"length_class": c, "bin": k, "n": n} for (c, k), n in seen.items()],
                                         schema=out)

    counts = map_batches(docs.select("text"), run, "length_class int, bin int, n long") \
        .groupBy("length_class", "bin").agg(F.sum("n").alias("n")).collect()   # classes times bins at most
    return {c: accepted_bin({r["bin"]: r["n"] for r in counts if r["length_class"] == c}, rate)
            for c in range(len(LENGTHS))}


def accepted_bin(counts: dict[int, int], rate: float) -> int:
    """Benjamini and Hochberg's rule on binned p-values."""
    total, found, best = sum(counts.values()), 0, LAST_BIN + 1
    for k in sorted(counts, reverse=True):
        found += counts[k]
        if 10 ** (-k / BINS_PER_DECADE) * total <= rate * found:
            best = k
    return best


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                                  T.StructField("end", T.LongType())]))
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def find_secrets(docs: DataFrame, result: str = "secrets", rate: float = FDR, redact_as: str | None = None) -> DataFrame:
    """``docs`` with an array column ``result`` of (kind, start, end), by start and
    kind; with ``redact_as`` their places in ``text`` are replaced by that string.

    Other columns stay (one of the result's name is replaced).  Null texts have no
    secrets and stay null; repeated rows are scanned each; an empty table gives none.
    The table is read twice: for the false-discovery control, then for the spans.
    """
    accepted = thresholds(docs, rate)
    kept = [c for c in docs.columns if c.lower() != result.lower()]
    rows = docs.select(*kept)
    at = kept.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found, texts = [], []
            for t in b.column(at):
                text = t.as_py()
                base = base_spans(text or "")
                more = [(s, 3, e) for s, e, c, k in candidates(text or "", base) if k >= accepted[c]]
                spans = sorted(base + more)
                found.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans])
                texts.append(redact(text, spans, redact_as) if redact_as is not None and spans else text)
            columns = list(b.columns)
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns + [pa.array(found, _SPANS)], names=[*kept, result])

    schema = T.StructType([*rows.schema.fields, T.StructField(result, SPANS)])
    return map_batches(rows, run, schema)


def redact(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    out, at = [], 0
    for s, _, e in spans:
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join(out) + text[at:]


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digests(found: DataFrame, result: str = "secrets") -> DataFrame:
    spans = F.col(result)
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in KINDS[:3]],
                        F.sha2(_joined(F.filter(spans, lambda s: s["kind"] != "random")), 256).alias("base_sha256"),
                        _joined(spans).alias("spans"))
