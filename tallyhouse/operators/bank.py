"""Bank control (A-8, A-9, A-15).

The bank feed is the cash the business actually received: receipts on the
order date, refunds on the refund date, Amazon net of its fee.  It is computed
here from ground-truth order lines (order_date, channel, gross_revenue,
is_refunded, refund_date, refund_amount) as a partitioned aggregation.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import round_money, total

# Marketplace fee rate and the channel it applies to.
AMAZON_FEE_RATE = Decimal("0.15")
FEE_CHANNEL = "amazon"


def _kept_share(channel) -> F.Column:
    return (F.when(channel == FEE_CHANNEL, F.lit(Decimal(1) - AMAZON_FEE_RATE))
            .otherwise(F.lit(Decimal("1.00"))))


def bank_by_channel_day(truth: DataFrame) -> DataFrame:
    """A-9: net deposit per (deposit_date, channel), each line rounded to cents first."""
    share = _kept_share(F.col("channel"))
    receipts = truth.select(
        F.col("order_date").alias("deposit_date"), "channel",
        round_money(F.col("gross_revenue") * share).alias("amount"))
    refunds = truth.where(F.col("is_refunded")).select(
        F.col("refund_date").alias("deposit_date"), "channel",
        round_money(-F.col("refund_amount") * share).alias("amount"))
    return (receipts.unionByName(refunds)
            .groupBy("deposit_date", "channel")
            .agg(total(F.sum("amount")).alias("net_deposit")))


def bank_by_channel(deposits: DataFrame) -> DataFrame:
    """A-8: the per-channel bank control (what the seed file holds)."""
    return deposits.groupBy("channel").agg(
        round_money(F.sum("net_deposit"), precision=38).alias("bank_net_revenue"))


def bank_identity(truth: DataFrame, deposits: DataFrame,
                  tolerance: Decimal = Decimal("50")) -> DataFrame:
    """A-15: bank total = gross - fee - (refunds - refund fee), within a tolerance.

    One aggregation over the union of both inputs (no join of the two totals).
    """
    zero = F.lit(Decimal("0.00")).cast("decimal(38,2)")
    amazon = F.col("channel") == FEE_CHANNEL
    refunded = F.coalesce(F.col("is_refunded"), F.lit(False))
    t = truth.select(
        money_or_zero("gross_revenue").alias("gross"),
        F.when(amazon, money_or_zero("gross_revenue")).otherwise(zero).alias("amazon_gross"),
        F.when(refunded, money_or_zero("refund_amount")).otherwise(zero).alias("refunds"),
        F.when(refunded & amazon, money_or_zero("refund_amount")).otherwise(zero)
        .alias("amazon_refunds"),
        zero.alias("bank"))
    b = deposits.select(zero.alias("gross"), zero.alias("amazon_gross"), zero.alias("refunds"),
                        zero.alias("amazon_refunds"), money_or_zero("net_deposit").alias("bank"))
    s = t.unionByName(b).agg(*[F.sum(c).alias(c) for c in
                               ("gross", "amazon_gross", "refunds", "amazon_refunds", "bank")])
    fee = F.lit(AMAZON_FEE_RATE)
    expected = (F.col("gross") - F.col("amazon_gross") * fee
                - (F.col("refunds") - F.col("amazon_refunds") * fee))
    return s.select(
        expected.cast("decimal(38,4)").alias("expected_net"),
        F.col("bank").cast("decimal(38,2)").alias("bank_net"),
        (F.col("bank") - expected).cast("decimal(38,4)").alias("difference"),
        (F.abs(F.col("bank") - expected) < F.lit(tolerance)).alias("within_tolerance"))


def money_or_zero(c: str) -> F.Column:
    return F.coalesce(F.col(c).cast("decimal(38,2)"), F.lit(Decimal("0.00")).cast("decimal(38,2)"))


def truth_from_fixture(fx_lines: DataFrame) -> DataFrame:
    """Ground-truth order lines in the answer-key shape, from the fixture lines."""
    return fx_lines.select(
        F.col("okey").alias("order_id"), "channel",
        F.col("store").alias("store_id"),
        F.col("odate").alias("order_date"), "sku",
        F.col("qty").alias("quantity"), F.col("price").alias("unit_price"),
        F.col("gross").alias("gross_revenue"),
        F.col("refunded").alias("is_refunded"),
        F.date_add(F.col("odate"), F.col("lag_days")).alias("refund_date"),
        F.when(F.col("refunded"), F.col("gross"))
        .otherwise(F.lit(Decimal("0.00")).cast("decimal(12,2)")).alias("refund_amount"))


def write_bank_seed(bank: DataFrame, path: str) -> None:
    """K-9: write the per-channel control as one small CSV (one row per channel,
    so a single output file is bounded by the channel count)."""
    (bank.select("channel", F.col("bank_net_revenue").cast("decimal(38,2)"))
     .orderBy("channel").coalesce(1)
     .write.mode("overwrite").option("header", True).csv(path))


def make_bank_seed(spark, deposits_parquet: str, seed_path: str) -> None:
    """S10 + A-8 + K-9: read the channel-day bank answer key (Parquet), total it
    per channel and write the control CSV the reconciliation reads."""
    deposits = spark.read.parquet(deposits_parquet)
    write_bank_seed(bank_by_channel(deposits), seed_path)
