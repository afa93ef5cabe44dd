"""Staging layer (P-1..P-4): typed, 1:1 views of the raw tables.

No filtering and no deduplication happen here; every function is a pure
projection, so Catalyst folds it into whatever reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import money, normalize_sku


def _strip_prefix_id(col: str, prefix: str):
    # Strict (ANSI) cast: a malformed id fails the job instead of becoming NULL.
    return F.replace(F.col(col), F.lit(prefix), F.lit("")).cast("bigint")


def stg_orders(raw: DataFrame) -> DataFrame:
    """P-1: order and refund rows, ``SHOP-`` stripped to a bigint id."""
    return raw.select(
        _strip_prefix_id("order_id", "SHOP-").alias("order_id"),
        F.col("created_at").cast("timestamp").alias("order_ts"),
        F.col("created_at").cast("timestamp").cast("date").alias("order_date"),
        F.col("sku"),
        F.col("quantity").cast("int").alias("quantity"),
        money("price", 12).alias("unit_price"),
        F.col("record_type"),
        money("refund_amount", 12).alias("refund_amount"),
        F.col("source_file"),
    )


def stg_settlements(raw: DataFrame) -> DataFrame:
    """P-2: settlement rows; currency upper-cased with a USD default."""
    return raw.select(
        _strip_prefix_id("amazon_order_id", "AMZ-").alias("order_id"),
        F.col("sku"),
        F.col("quantity").cast("int").alias("quantity"),
        money("gross_amount", 12).alias("gross_amount"),
        money("fee_amount", 12).alias("fee_amount"),
        money("net_amount", 12).alias("net_amount"),
        F.upper(F.coalesce(F.col("currency"), F.lit("USD"))).alias("currency"),
        F.col("settlement_date").cast("date").alias("settlement_date"),
        F.col("source_file"),
    )


def stg_pos(raw: DataFrame) -> DataFrame:
    """P-3: point-of-sale rows; negative quantities and txn_type kept as landed."""
    return raw.select(
        F.col("store_id"),
        F.col("txn_timestamp").cast("timestamp").alias("txn_ts"),
        F.col("txn_timestamp").cast("timestamp").cast("date").alias("txn_date"),
        F.col("sku"),
        F.col("quantity").cast("int").alias("quantity"),
        money("amount", 12).alias("amount"),
        F.col("txn_type"),
        F.col("source_file"),
    )


def stg_products(raw: DataFrame) -> DataFrame:
    """P-4: product master rows with the SKU format drift normalized."""
    return raw.select(
        normalize_sku(F.col("sku")).alias("sku_normalized"),
        F.col("sku").alias("sku_raw"),
        F.col("product_name"),
        F.col("category"),
        money("unit_cost", 12).alias("unit_cost"),
        money("unit_price", 12).alias("unit_price"),
        F.col("source_file"),
    )
