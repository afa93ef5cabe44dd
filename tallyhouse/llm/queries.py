"""The ``opN_<name>`` queries: each operator over its whole table, as digests.

Each callable takes (spark, sf_dir).  ``ORACLE_SQL`` has the queries that DuckDB
can state; the others are tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.llm import (decontaminate, dual_tree, harmonic, idblocks, masked_lm, near_dups, prefix_trie, quality_model,
                            rules, secret_scan, slots, surrogates, t_occurrence)
from tallyhouse.llm.common import long_id, table

SURROGATE_KEY = "tallyhouse-surrogates-1"
ID_VOCABULARY = "byte_bpe_50k.json"


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(long_id(), "text")


def op1_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced by keyed surrogates."""
    return surrogates.replace_entities(_documents(spark, sf_dir), SURROGATE_KEY)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality by a subword model fitted outside the held-out fold."""
    docs = _documents(spark, sf_dir)
    return quality_model.digests(quality_model.score(docs, quality_model.fit(docs, table(spark, sf_dir, "labels"))))


def op3_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's masked pseudo-likelihood by a network trained on all of them."""
    return masked_lm.score_corpus(_documents(spark, sf_dir))


def op4_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences of 4096 tokens."""
    return harmonic.digests(harmonic.pack(_documents(spark, sf_dir), harmonic.encode_with_end()))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and component of near duplicates."""
    return near_dups.digests(near_dups.near_duplicates(_documents(spark, sf_dir)))


def op6_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard and place, by fixed virtual slots of near equal bytes."""
    return slots.digests(slots.assign_shards(_documents(spark, sf_dir)))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets of every document: fixed forms, and random-looking strings."""
    return secret_scan.digests(secret_scan.find_secrets(_documents(spark, sf_dir)))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's overlap with the benchmark."""
    return decontaminate.digests(decontaminate.overlaps(_documents(spark, sf_dir), table(spark, sf_dir, "benchmark")))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's measures and verdict by the threshold table."""
    return rules.apply_rules(_documents(spark, sf_dir))


def op10_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, written to block files and read back."""
    docs = _documents(spark, sf_dir)
    return idblocks.digests(idblocks.id_files(docs, harmonic.encode_with_end(ID_VOCABULARY)))


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shingle count and component of documents with similar sets."""
    return t_occurrence.digests(t_occurrence.jaccard_classes(_documents(spark, sf_dir)))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return dual_tree.search(_documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of all conversations, rebuilt with shared heads."""
    turns = prefix_trie.ordered_turns(table(spark, sf_dir, "conversations"))
    return prefix_trie.digests(prefix_trie.trie(*prefix_trie.with_shared_heads(turns)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_surrogates, op2_quality, op3_pseudo_likelihood, op4_harmonic_packing, op5_near_duplicates, op6_virtual_slots,
    op7_secret_scan, op8_decontamination, op9_quality_rules, op10_id_files, op11_jaccard_join, op12_ranked_search,
    op13_prefix_trie)}

ORACLE_SQL: dict[str, str] = {"op8_decontamination": decontaminate.oracle_sql(), "op9_quality_rules": rules.oracle_sql(),
                              "op12_ranked_search": dual_tree.oracle_sql()}
