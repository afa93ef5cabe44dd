"""Intermediate layer (M-1..M-4): the documented cleaning rulings.

Both "keep one row per key" rulings (W-1, W-2) are written as aggregations with
``min_by`` instead of ``row_number() ... = 1``: the aggregate combines map-side,
so a key that holds a third of all rows (a retry storm, a hot SKU) collapses to
one row per map task before the shuffle instead of landing whole in one sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import fx_to_usd, round_money

DEDUP_KEY = ("order_id", "sku", "quantity", "unit_price")


def orders_deduplicated(stg: DataFrame, key: tuple[str, ...] = DEDUP_KEY) -> DataFrame:
    """M-1 / W-1: one row per (order_id, sku, quantity, unit_price) order line.

    The copy kept is the first by ``source_file`` (then ``order_ts``, NULL
    first), the same choice as ``row_number() over (partition by key order by
    source_file)``.  NULL key parts group together, as in PARTITION BY.
    ``stg`` is the output of :func:`stg_orders`.
    """
    orders = stg.where(F.col("record_type") == "order")
    kept = orders.groupBy(*key).agg(
        F.min_by(F.struct("order_ts", "order_date"),
                 F.struct("source_file", "order_ts")).alias("_kept"))
    return kept.select(
        "order_id", F.col("_kept.order_ts").alias("order_ts"),
        F.col("_kept.order_date").alias("order_date"),
        "sku", "quantity", "unit_price", F.lit("shopify").alias("channel"))


def shopify_refunds(stg: DataFrame) -> DataFrame:
    """P-5: refund rows of the order feed (not deduplicated, quirk Q-11)."""
    return stg.where(F.col("record_type") == "refund")


def settlements_usd(stg: DataFrame, rates=None) -> DataFrame:
    """M-2 / P-8: settlement money converted to USD, rounded to cents per line."""
    fx = fx_to_usd(F.col("currency"), rates)
    return stg.select(
        "order_id", "sku", "quantity",
        round_money(F.col("gross_amount") * fx).alias("gross_amount_usd"),
        round_money(F.col("fee_amount") * fx).alias("fee_amount_usd"),
        round_money(F.col("net_amount") * fx).alias("net_amount_usd"),
        F.col("currency").alias("original_currency"),
        "settlement_date",
        F.lit("amazon").alias("channel"))


def pos_classified(stg: DataFrame) -> DataFrame:
    """M-3 / P-6, P-7: training rows dropped; negative quantity = return."""
    sales = stg.where(F.col("txn_type") == "sale")
    return sales.select(
        "store_id", "txn_ts", "txn_date", "sku", "quantity", "amount",
        F.when(F.col("quantity") < 0, F.lit("return")).otherwise(F.lit("sale"))
        .alias("line_type"),
        F.lit("pos").alias("channel"))


def products_resolved(stg: DataFrame) -> DataFrame:
    """M-4 / W-2: one row per normalized SKU, lowest unit cost wins.

    NULL cost sorts last (a missing cost must never win).  Ties on cost are
    broken by the raw SKU and the remaining columns so the result is
    reproducible.  ``stg`` is the output of :func:`stg_products`.
    """
    rank = F.struct(F.col("unit_cost").isNull(), "unit_cost", "sku_raw",
                    "product_name", "category", "unit_price")
    best = stg.groupBy("sku_normalized").agg(
        F.min_by(F.struct("product_name", "category", "unit_cost", "unit_price"),
                 rank).alias("_best"))
    return best.select(
        F.col("sku_normalized").alias("sku"),
        "_best.product_name", "_best.category", "_best.unit_cost", "_best.unit_price")
