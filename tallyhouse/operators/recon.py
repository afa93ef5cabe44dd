"""Reconciliation (M-10, C-15) and revenue reports (R-1, J-8)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import total
from tallyhouse.functions.money import RATIO

# The reconciliation tolerance, the guardrail, and the residual
# reason texts.
TOLERANCE = Decimal("0.005")
GUARDRAIL = Decimal("0.10")
AMAZON_REASON = "Amazon refunds settle in a later period not captured in this window"
TIMING_REASON = "Refund-date vs order-date timing difference"

CHANNELS = ("shopify", "pos", "amazon")


def channel_nets(orders: DataFrame, refunds: DataFrame, pos: DataFrame,
                 settlements: DataFrame) -> DataFrame:
    """A-1..A-5, U-2: warehouse net revenue per channel as (channel, warehouse_net_revenue).

    Each channel's total is a *global* aggregate, so a channel with no rows
    still yields a row (with a NULL total), like the SQL it mirrors.  All four
    inputs go through a single global aggregation: every task pre-aggregates
    its partition and only four partial sums per task are shuffled.
    """
    nul = F.lit(None).cast("decimal(38,2)")
    parts = (
        orders.select((F.col("quantity") * F.col("unit_price")).cast("decimal(38,2)").alias("g"),
                      nul.alias("r"), nul.alias("p"), nul.alias("a"))
        .unionByName(refunds.select(nul.alias("g"), F.col("refund_amount").cast("decimal(38,2)")
                                    .alias("r"), nul.alias("p"), nul.alias("a")))
        .unionByName(pos.select(nul.alias("g"), nul.alias("r"),
                                F.col("amount").cast("decimal(38,2)").alias("p"), nul.alias("a")))
        .unionByName(settlements.select(nul.alias("g"), nul.alias("r"), nul.alias("p"),
                                        F.col("net_amount_usd").cast("decimal(38,2)").alias("a"))))
    totals = parts.agg(F.sum("g").alias("g"), F.coalesce(F.sum("r"), F.lit(0)).alias("r"),
                       F.sum("p").alias("p"), F.sum("a").alias("a"))
    return totals.select(F.explode(F.array(
        F.struct(F.lit("shopify").alias("channel"),
                 total(F.col("g") - F.col("r")).alias("warehouse_net_revenue")),
        F.struct(F.lit("pos").alias("channel"), total(F.col("p")).alias("warehouse_net_revenue")),
        F.struct(F.lit("amazon").alias("channel"), total(F.col("a")).alias("warehouse_net_revenue")),
    )).alias("c")).select("c.channel", "c.warehouse_net_revenue")


def reconcile(nets: DataFrame, bank: DataFrame, tolerance: Decimal = TOLERANCE) -> DataFrame:
    """M-10: channel nets against the bank control, with status and reason.

    ``bank`` is the per-channel control (channel, bank_net_revenue): one row per
    channel, so broadcasting it is bounded by the number of channels.  The join
    is inner, so a channel missing from the control drops out (quirk Q-8).
    """
    j = nets.join(F.broadcast(bank.select("channel", "bank_net_revenue")), "channel")
    diff = F.col("warehouse_net_revenue") - F.col("bank_net_revenue")
    ratio = F.abs(diff).cast(RATIO) / F.nullif(F.col("bank_net_revenue").cast(RATIO), F.lit(0))
    tol = F.lit(tolerance)
    over = ratio > tol
    return j.select(
        "channel", "warehouse_net_revenue", "bank_net_revenue",
        total(diff).alias("gap"),
        F.round(ratio, 4).cast("decimal(10,4)").alias("gap_pct"),
        F.when(ratio <= tol, F.lit("RECONCILED")).otherwise(F.lit("RESIDUAL")).alias("status"),
        F.when((F.col("channel") == "amazon") & over, F.lit(AMAZON_REASON))
        .when(over, F.lit(TIMING_REASON)).alias("residual_reason"),
    ).orderBy("channel")


def corruption_drill(nets: DataFrame, bank: DataFrame, channel: str = "shopify",
                     factor: int = 2, guardrail: Decimal = GUARDRAIL) -> DataFrame:
    """C-15: reconcile with one channel's revenue multiplied (a join fan-out bug)
    and flag every channel whose gap breaches the guardrail."""
    bad = nets.select("channel", F.when(
        F.col("channel") == channel, total(F.col("warehouse_net_revenue") * factor))
        .otherwise(F.col("warehouse_net_revenue")).alias("warehouse_net_revenue"))
    r = reconcile(bad, bank)
    return r.select("channel", "warehouse_net_revenue", "bank_net_revenue", "gap_pct",
                    (F.col("gap_pct") > F.lit(guardrail)).alias("breaches_guardrail"))


def daily_revenue(orders: DataFrame, refunds: DataFrame, pos: DataFrame,
                  settlements: DataFrame) -> DataFrame:
    """R-1: net revenue per (activity_date, channel).

    Shopify lines count on the order date and refunds on the refund date; POS
    rows (returns already negative) on the transaction date; Amazon on the
    settlement date, net of fees.  Summed over all dates this equals
    :func:`channel_nets`.
    """
    dec = "decimal(38,2)"
    parts = (
        orders.select(F.col("order_date").alias("activity_date"), "channel",
                      (F.col("quantity") * F.col("unit_price")).cast(dec).alias("amount"))
        .unionByName(refunds.select(F.col("order_date").alias("activity_date"),
                                    F.lit("shopify").alias("channel"),
                                    (-F.col("refund_amount")).cast(dec).alias("amount")))
        .unionByName(pos.select(F.col("txn_date").alias("activity_date"), "channel",
                                F.col("amount").cast(dec).alias("amount")))
        .unionByName(settlements.select(F.col("settlement_date").alias("activity_date"),
                                        "channel", F.col("net_amount_usd").cast(dec)
                                        .alias("amount"))))
    return parts.groupBy("activity_date", "channel").agg(
        total(F.sum("amount")).alias("net_revenue"),
        F.count(F.lit(1)).alias("lines"))


def daily_gap(daily: DataFrame, deposits: DataFrame) -> DataFrame:
    """R-2: per (activity_date, channel), net revenue against the bank's deposits of
    that day.  Days that only one side has count 0 on the other; both sides are
    summed in one aggregation, so nothing is joined (dates may be NULL)."""
    none = F.lit(Decimal("0.00")).cast("decimal(38,2)")
    both = (daily.select("activity_date", "channel", "net_revenue", none.alias("net_deposit"))
            .unionByName(deposits.select(F.col("deposit_date").alias("activity_date"), "channel",
                                         none.alias("net_revenue"), total("net_deposit").alias("net_deposit"))))
    summed = both.groupBy("activity_date", "channel").agg(
        total(F.sum("net_revenue")).alias("net_revenue"), total(F.sum("net_deposit")).alias("net_deposit"))
    return summed.withColumn("gap", total(F.col("net_revenue") - F.col("net_deposit")))


def revenue_by_category(order_lines: DataFrame, settlement_lines: DataFrame,
                        dim_product: DataFrame) -> DataFrame:
    """J-8: gross revenue by (category, channel) through the product dimension.

    The facts are first reduced to one row per (product_key, channel), so the
    join sees at most products x channels rows on the fact side whatever the fact
    size; the join is a left join so lines with an unknown product are kept
    under a NULL category instead of silently dropping out.
    """
    dec = "decimal(38,2)"
    per_product = (
        order_lines.select("product_key", "channel", F.col("gross_revenue").cast(dec).alias("g"))
        .unionByName(settlement_lines.select("product_key", "channel",
                                             F.col("gross_amount_usd").cast(dec).alias("g")))
        .groupBy("product_key", "channel")
        .agg(F.sum("g").alias("g"), F.count(F.lit(1)).alias("n")))
    joined = per_product.join(dim_product.select("product_key", "category"),
                              "product_key", "left")
    return joined.groupBy("category", "channel").agg(
        total(F.sum("g")).alias("gross_revenue"),
        F.sum("n").cast("bigint").alias("lines"))
