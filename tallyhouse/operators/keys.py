"""W-4 / W-5: dense surrogate keys ``row_number() over (order by d)`` without a
single-partition sort.

A global ``row_number()`` with no PARTITION BY moves every row to one task.
Here the same numbering is produced in parallel:

1. rows are collapsed to (distinct row, multiplicity) with a map-side combined
   aggregation, so a group of identical copies -- however large -- becomes one
   row before any shuffle.  The hash below is computed where rows are put in order
   and takes no part in a shuffle, of which it would be half;
2. within a date rows stand in the order of a hash of their columns, and the
   window that numbers them is partitioned by (date, bucket), a bucket being the
   hash's first hex digits: none on an ordinary date, as many as keep a bucket
   near ``rows_per_bucket`` rows on a hot one.  As buckets are prefixes of the
   order's own hash, their number changes the work's split, never the order;
3. the start offset of every (date, bucket) is a running sum over the small
   table of per-(date, bucket) counts, whose size is bounded by
   days + 16 * rows / rows_per_bucket;
4. copies are expanded back with a two-level ``explode`` whose arrays never hold
   more than ``chunk`` elements.

The total order is (date NULLS LAST, hash, the other columns NULLS LAST).  It
is a deterministic refinement of "order by date" (whose ties the reference
leaves arbitrary); :func:`key_order_sql` states it for an SQL oracle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 1 << 21
DEFAULT_CHUNK = 1 << 20


# Hex digits a bucket may take: 16 ** 6 buckets a date.
MAX_DIGITS = 6


def content_sql(*columns: str) -> str:
    """A hash of the columns, valid in Spark SQL and DuckDB: equal rows share it, others
    spread evenly even if they differ in one column alone."""
    parts = ", ".join(f"coalesce(cast({c} as string), '~')" for c in columns)
    return f"md5(concat_ws('|', {parts}))"


def key_order_sql(order_col: str, content: str, tie_cols: list[str],
                  rows_per_bucket: int | None = None) -> str:
    """The ORDER BY list of the numbering, for ``row_number() over (...)`` in SQL
    (the same whatever ``rows_per_bucket`` is)."""
    ties = ", ".join(f"{c} nulls last" for c in tie_cols)
    return f"{order_col} nulls last, {content}, {ties}"


def dense_key(df: DataFrame, key: str, order_col: str, content: Column,
              rows_per_bucket: int = ROWS_PER_BUCKET, chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """Add ``key`` = 1..N in the order (order_col, content, other columns).

    Every column of ``df`` except ``order_col`` takes part in the tie-break, so
    rows that compare equal are identical and any numbering of them gives the
    same result.  ``content`` is a hash of the row in hex digits.
    """
    others = [c for c in df.columns if c != order_col]
    day = ["_dnull", "_d"]
    staged = df.select(
        F.col(order_col).isNull().alias("_dnull"),
        F.coalesce(F.col(order_col), F.lit("1970-01-01").cast("date")).alias("_d"),
        *others, F.col(order_col))

    # 1. collapse copies (partial aggregation runs before the shuffle)
    counted = staged.groupBy(*day, *others, order_col).agg(
        F.count(F.lit(1)).alias("_n"))

    # 2. hex digits per date.  One row per calendar day: bounded by the span of
    #    the history, so it is broadcast.
    buckets = F.sum("_n") / F.lit(float(rows_per_bucket))
    per_day = counted.groupBy(*day).agg(F.least(F.lit(MAX_DIGITS), F.greatest(
        F.lit(0), F.ceil(F.log(buckets) / math.log(16)).cast("int"))).alias("_digits"))
    bucketed = counted.join(F.broadcast(per_day), day).withColumn(
        "_b", F.when(F.col("_digits") == 0, F.lit("")).otherwise(content.substr(F.lit(1), F.col("_digits")))) \
        .drop("_digits")

    part = Window.partitionBy(*day, "_b").orderBy(
        "_h", *[F.col(c).asc_nulls_last() for c in others]
    ).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = bucketed.repartition(*day, "_b").withColumn("_h", content).withColumn("_cum", F.sum("_n").over(part))

    # 3. offsets over the (date, bucket) count table: days + 16 * rows/rows_per_bucket
    #    rows at most, so the one-partition running sum stays small; the join
    #    back is left to AQE (broadcast when its runtime size allows).
    sizes = bucketed.groupBy(*day, "_b").agg(F.sum("_n").alias("_bn"))
    before = Window.orderBy(*day, "_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*day, "_b",
                           F.coalesce(F.sum("_bn").over(before), F.lit(0)).alias("_base"))
    placed = numbered.join(offsets, [*day, "_b"])

    # 4. expand copies in bounded chunks
    start = F.col("_base") + F.col("_cum") - F.col("_n") + 1
    last = F.col("_base") + F.col("_cum")
    out = (placed
           .withColumn("_start", start)
           .withColumn("_c", F.explode(F.sequence(
               F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / chunk).cast("long"))))
           .withColumn("_lo", F.col("_start") + F.col("_c") * chunk)
           .withColumn(key, F.explode(F.sequence(
               F.col("_lo"), F.least(F.col("_lo") + (chunk - 1), last)))))
    return out.select(F.col(key).cast("bigint").alias(key), order_col, *others)
