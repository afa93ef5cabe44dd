"""Helpers shared by the operators: table access, Arrow maps, written tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.session import scratch_path, ship_package

# Rows per Arrow batch sent to a Python worker.  Texts can be very long, so the
# batch is kept small: memory per worker is about this many texts.
BATCH_ROWS = 512

# White space of the word rules: space and the ASCII controls 9 to 13.
SPACE = "\\x20\\x09-\\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]],
                schema: str | T.StructType, rows: int = BATCH_ROWS) -> DataFrame:
    """``mapInArrow`` with small batches and the package shipped to the workers."""
    spark = df.sparkSession
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return df.mapInArrow(fn, schema)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: later
    jobs read the files, so a lost executor never recomputes what stands above."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def long_id(col: str = "doc_id") -> F.Column:
    return F.col(col).cast("long").alias(col)


def batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type)
         for c, f in zip(columns, schema, strict=True)], schema=schema)
