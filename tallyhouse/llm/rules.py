"""Quality rules: a threshold table compiled into one projection.

Every measure is a built-in expression over the text's words and lines, so the
whole table runs in one pass on the executors' JVM, without user functions
and without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import SPACE

# Frequent short function words of the four languages.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "for", "it", "was", "with", "on", "are", "as", "this", "by",
    "der", "die", "das", "und", "den", "ist", "von", "mit", "zu", "ein", "eine", "nicht", "auf", "im", "für", "als",
    "le", "la", "les", "de", "des", "et", "un", "une", "du", "est", "que", "qui", "en", "pour", "dans", "avec",
    "el", "los", "las", "y", "una", "por", "con", "para", "se", "no", "lo", "su", "es", "al",
)
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
REPEATED_PERCENT = 20


@dataclass(frozen=True)
class Rule:
    """``low * below <= above <= high * below`` must hold from ``min_words`` words on."""

    name: str
    above: str
    below: str
    low: float | None
    high: float | None
    min_words: int = MIN_WORDS


# The threshold table.  A text is kept if no rule and no base check rejects it.
RULES = (
    Rule("word_length", "word_chars", "n_words", 2.0, 20.0),
    Rule("symbols_per_word", "n_symbols", "n_words", None, 0.2),
    Rule("stop_words", "n_stop_words", "n_words", 0.02, None, min_words=50),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", None, 0.5),
    Rule("shouted_words", "n_shouted_words", "n_words", None, 0.5),
    Rule("words_per_line", "n_words", "n_lines", 1.5, None, min_words=50),
)

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words",
            "n_shouted_words")


def _let(value: Column, body) -> Column:
    """``body(v)`` with ``value`` computed once: an array of one is transformed."""
    return F.transform(F.array(value), body)[0]


def _repeated_words(words: Column) -> Column:
    """Words inside windows of five words that stand at two places or more: the
    windows' hashes are sorted with their places; equal neighbours are repeated;
    their places in order, each counts its words up to the next place."""

    def of(w: Column) -> Column:
        places = F.when(F.size(w) >= WINDOW, F.sequence(F.lit(0), F.size(w) - WINDOW)).otherwise(
            F.array().cast("array<int>"))
        hashes = F.sort_array(F.transform(places, lambda i: F.struct(
            F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]).alias("h"), i.alias("i"))))
        return _let(hashes, repeated)

    def repeated(s: Column) -> Column:
        none = F.array(F.lit(None).cast("bigint"))
        h = F.transform(s, lambda x: x["h"])
        # Whether a window equals the one behind it, and the one before it.
        equal = F.zip_with(h, F.concat(F.slice(h, 2, F.greatest(F.size(h), F.lit(1))), none),
                           lambda a, b: F.coalesce(a == b, F.lit(False)))
        return _let(equal, lambda e: covered(F.sort_array(F.transform(F.filter(
            F.zip_with(s, F.zip_with(e, F.concat(F.array(F.lit(False)), e), lambda a, b: a | F.coalesce(b, F.lit(False))),
                       lambda x, r: F.when(r, x["i"])), lambda i: i.isNotNull()), lambda i: i))))

    def covered(places: Column) -> Column:
        return _let(places, lambda p: F.aggregate(
            F.zip_with(p, F.concat(F.slice(p, 2, F.greatest(F.size(p), F.lit(1))),
                                   F.array(F.lit(None).cast("int"))),
                       lambda a, b: F.when(a.isNotNull(), F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))))),
            F.lit(0).cast("bigint"), lambda total, n: total + F.coalesce(n, F.lit(0)).cast("bigint")))

    return _let(words, of)


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, f"[{SPACE}]+"), lambda w: w != "")


def lines_of(text: Column) -> Column:
    """The lines that have a word."""
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE}]"))


def measures(text: Column, words: Column, lines: Column) -> dict[str, Column]:
    """Each measure of a text as an expression."""
    size = lambda a: F.size(a).cast("bigint")
    return {
        "n_words": size(words),
        "word_chars": F.length(F.array_join(words, "")).cast("bigint"),
        "n_symbols": (F.octet_length(text) - F.octet_length(F.regexp_replace(text, f"[{SYMBOLS}]+", ""))).cast("bigint"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint"),
        "n_repeat_words": _repeated_words(words).cast("bigint"),
        "n_lines": size(lines),
        "n_stop_words": size(F.filter(words, lambda w: F.lower(w).isin(*STOP_WORDS))),
        # Words of three characters or more that have letters, none of them small.
        "n_shouted_words": size(F.filter(words, lambda w: (F.length(w) >= 3) & (w == F.upper(w)) & (w != F.lower(w)))),
    }


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """True where no rule of the table rejects."""
    out = F.lit(True)
    for r in rules:
        a, b = F.col(r.above).cast("double"), F.col(r.below)
        holds = F.lit(True)
        if r.low is not None:
            holds = holds & (a >= F.lit(r.low) * b)
        if r.high is not None:
            holds = holds & (a <= F.lit(r.high) * b)
        out = out & (holds | (F.col("n_words") < r.min_words))
    return out


def apply_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id``, the measures, base_failed and kept for every row.

    Null and empty texts have no words and fail the base check; other columns are
    ignored; repeated rows count each; an empty table gives none.
    """
    text = F.coalesce("text", F.lit(""))
    # Words and lines are cut once: Spark keeps apart projections whose columns are
    # dear and used several times.
    cut = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                      words_of(text).alias("words"), lines_of(text).alias("lines"))
    measured = cut.select("doc_id", *[c.alias(n) for n, c in measures(
        F.col("text"), F.col("words"), F.col("lines")).items()])
    return measured.select("doc_id", *MEASURES, base_failed().alias("base_failed"),
                           (~base_failed() & verdict(rules)).alias("kept"))


def oracle_sql(rules: tuple[Rule, ...] = RULES) -> str:
    """The same table stated for DuckDB."""
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    holds = []
    for r in rules:
        parts = ([f"{r.above} >= {r.low}::double * {r.below}"] if r.low is not None else []) + \
            ([f"{r.above} <= {r.high}::double * {r.below}"] if r.high is not None else [])
        holds.append(f"(({' and '.join(parts)}) or n_words < {r.min_words})")
    return f"""
with t as (
  select row_number() over () as r, doc_id::bigint as doc_id, coalesce(text, '') as text from documents),
w as (
  select r, doc_id, text,
    list_filter(regexp_split_to_array(text, '[{SPACE}]+'), lambda x: x <> '') as words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^{SPACE}]')) as lines from t),
p as (
  select r, unnest(generate_series(1, len(words) - {WINDOW - 1})) as i, words from w),
g as (
  select r, i, list_slice(words, i, i + {WINDOW - 1}) as g from p),
rep as (
  select r, i from (select r, i, count(*) over (partition by r, g) as n from g) where n > 1),
cov as (
  select r, count(*) as n_repeat_words from (
    select distinct r, i + k as at from rep, (select unnest(range({WINDOW})) as k)) group by r),
m as (
  select doc_id, len(words)::bigint as n_words,
    length(regexp_replace(text, '[{SPACE}]+', '', 'g'))::bigint as word_chars,
    (length(text) - length(regexp_replace(text, '[{SYMBOLS}]', '', 'g')))::bigint as n_symbols,
    (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
    coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
    len(lines)::bigint as n_lines,
    len(list_filter(words, lambda x: lower(x) in ({stop})))::bigint as n_stop_words,
    len(list_filter(words, lambda x: length(x) >= 3 and x = upper(x) and x <> lower(x)))::bigint as n_shouted_words
  from w left join cov using (r)),
b as (
  select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {REPEATED_PERCENT} * n_words as base_failed from m)
select {", ".join(("doc_id", *MEASURES))}, base_failed,
  not base_failed and {" and ".join(holds)} as kept
from b"""
