"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
and read again as the next one's ``docs``.  All but the last return the columns
of ``documents``, whatever further ones there are and whatever their names.  Texts
of any length are taken whole; empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import decontaminate, harmonic, near_dups, quality_model, secret_scan
from tallyhouse.llm.common import table, written

REDACTED = "[secret]"

# The stages read vocabulary files, labels and fingerprints that SQL lacks.
ORACLE_SQL = None


def _free(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` doesn't have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts.  Null and empty texts have the
    model's bias as their only score; repeated rows stay or go together."""
    score = _free(docs, "quality_score")
    margins = quality_model.fit(docs, table(spark, sf_dir, "labels"))
    return quality_model.score(docs, margins, score).where(F.col(score) >= quality_model.THRESHOLD).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the smallest doc_id (rows
    without one last), of several such rows the one with the smallest hash of its text,
    one of equal rows.  Null and empty texts are a group."""
    return near_dups.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark.  Null and empty texts have
    no words, so they stay; so do all where the benchmark is empty."""
    overlap = _free(docs, "benchmark_overlap")
    found = decontaminate.overlaps(docs, table(spark, sf_dir, "benchmark"), result=overlap)
    return found.where(~decontaminate.contaminated(overlap)).select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced (and n_chars counted again).  Null
    and empty texts stay as they are."""
    spans = _free(docs, "secret_spans")
    found = secret_scan.find_secrets(docs, spans, redact_as=REDACTED)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        found = found.withColumn("n_chars", F.when(F.size(spans) > 0, F.length("text").cast(kind))
                                 .otherwise(F.col("n_chars")))
    return found.select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the remaining documents in their training sequences.  Null texts are
    empty: their end token alone; rows without doc_id are packed like any."""
    return harmonic.digests(harmonic.pack(docs, harmonic.encode_with_end()))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("secrets", secrets), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
