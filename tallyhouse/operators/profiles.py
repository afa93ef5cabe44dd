"""Source-defect profiles (F-2, F-4, F-6..F-9): what the raw feeds contain that
the cleaning rulings exist for.  All are grouped aggregations over the raw or
staging layer; the file-level profiles (F-1, F-3, F-5) live with the file scans
in :mod:`tallyhouse.sources.files`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def duplicate_orders(stg_orders: DataFrame) -> DataFrame:
    """F-2 / A-10 / A-11: order ids whose lines were landed more than once.

    ``copies`` is the largest number of identical (sku, quantity, price) rows of
    the order -- how many times the order object was delivered; ``rows`` and
    ``files`` are its raw row and distinct source-file counts.  Two partial
    aggregations merged by a union (no join, no collected lists).
    """
    orders = stg_orders.where(F.col("record_type") == "order")
    per_line = orders.groupBy("order_id", "sku", "quantity", "unit_price").agg(
        F.count(F.lit(1)).alias("n")).select(
        "order_id", F.col("n").alias("copies"), F.col("n").alias("rows"),
        F.lit(0).cast("bigint").alias("files"))
    per_file = orders.select("order_id", "source_file").distinct().select(
        "order_id", F.lit(0).cast("bigint").alias("copies"),
        F.lit(0).cast("bigint").alias("rows"), F.lit(1).cast("bigint").alias("files"))
    per_order = per_line.unionByName(per_file).groupBy("order_id").agg(
        F.max("copies").alias("copies"), F.sum("rows").alias("rows"),
        F.sum("files").alias("files"))
    return per_order.where("copies > 1").select(
        "order_id", F.col("copies").cast("bigint").alias("copies"),
        F.col("rows").cast("bigint").alias("rows"), F.col("files").cast("bigint").alias("files"))


def currency_profile(raw_settlements: DataFrame) -> DataFrame:
    """F-4: settlement rows per landed currency value and the code it normalizes to."""
    return raw_settlements.groupBy("currency").agg(
        F.count(F.lit(1)).alias("rows")).select(
        F.col("currency").alias("raw_currency"),
        F.upper(F.coalesce(F.col("currency"), F.lit("USD"))).alias("currency"),
        F.col("rows").cast("bigint").alias("rows"))


def training_profile(stg_pos: DataFrame) -> DataFrame:
    """F-6: per store, training rows (and how many look like returns) vs real returns."""
    neg = F.col("quantity") < 0
    training = F.col("txn_type") == "training"
    sale = F.col("txn_type") == "sale"
    return stg_pos.groupBy("store_id").agg(
        F.count_if(training).cast("bigint").alias("training_rows"),
        F.count_if(training & neg).cast("bigint").alias("negative_training_rows"),
        F.count_if(sale & neg).cast("bigint").alias("return_rows"),
        F.count_if(sale).cast("bigint").alias("sale_rows"))


NIGHT_PATTERN = r"(\d{4}-\d{2}-\d{2})"


def store_nights(stg_pos: DataFrame) -> DataFrame:
    """(store_id, night) of every POS file, the night read from the file name."""
    night = F.regexp_extract(F.col("source_file"), NIGHT_PATTERN, 1)
    return stg_pos.select("store_id", F.to_date(F.nullif(night, F.lit(""))).alias("night")) \
        .where(F.col("night").isNotNull()).distinct()


def missing_nights(stg_pos: DataFrame) -> DataFrame:
    """F-7: per store, nights with a file, its first and last night, and the
    nights missing inside that span (no store x date spine is materialized)."""
    n = store_nights(stg_pos)
    s = n.groupBy("store_id").agg(
        F.count(F.lit(1)).alias("nights_present"), F.min("night").alias("first_night"),
        F.max("night").alias("last_night"))
    span = F.datediff(F.col("last_night"), F.col("first_night")) + 1
    return s.select("store_id", F.col("nights_present").cast("bigint").alias("nights_present"),
                    "first_night", "last_night",
                    (span - F.col("nights_present")).cast("bigint").alias("missing_nights"))


def absent_nights(stg_pos: DataFrame) -> DataFrame:
    """F-7: every night without a file, between a store's first and last night.

    Each night looks at the store's next one; only gaps are spread out, so the work
    grows with the nights present and those missing, not with stores times dates."""
    following = F.lead("night").over(Window.partitionBy("store_id").orderBy("night"))
    gaps = store_nights(stg_pos).withColumn("next", following).where(F.datediff("next", "night") > 1)
    return gaps.select("store_id", F.explode(F.sequence(F.date_add("night", 1), F.date_sub("next", 1))).alias("night"))


def conflicting_costs(raw_products: DataFrame) -> DataFrame:
    """F-8 / A-14: SKUs (as landed) listed more than once, with their distinct costs."""
    g = raw_products.groupBy("sku").agg(
        F.count(F.lit(1)).alias("entries"),
        F.count_distinct(F.col("unit_cost").cast("decimal(12,2)")).alias("distinct_costs"),
        F.min(F.col("unit_cost").cast("decimal(12,2)")).alias("min_cost"),
        F.max(F.col("unit_cost").cast("decimal(12,2)")).alias("max_cost"))
    return g.where("entries > 1").select(
        "sku", F.col("entries").cast("bigint").alias("entries"),
        F.col("distinct_costs").cast("bigint").alias("distinct_costs"), "min_cost", "max_cost")


def late_refunds(stg_orders: DataFrame) -> DataFrame:
    """F-9: refunds by days after their order (lag <= 0 would be a defect).

    Both sides are reduced before the join -- orders to one first-order date
    per id, refunds to one row per (order, refund date) with a count -- so a hot
    order id cannot skew the join.
    """
    first = (stg_orders.where(F.col("record_type") == "order").groupBy("order_id")
             .agg(F.min("order_date").alias("first_order_date")))
    refunds = (stg_orders.where(F.col("record_type") == "refund")
               .groupBy("order_id", F.col("order_date").alias("refund_date"))
               .agg(F.count(F.lit(1)).alias("n")))
    j = refunds.join(first, "order_id", "left")
    lag = F.datediff(F.col("refund_date"), F.col("first_order_date"))
    return j.groupBy(lag.alias("lag_days")).agg(F.sum("n").cast("bigint").alias("refunds"))
