"""Marts (M-5..M-9): the star schema -- date, product and store dimensions and
the two facts (order-date lines, settlement-date Amazon cash)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions import date_spine, money, pg_day_name, pg_day_of_week, round_money
from tallyhouse.operators.keys import content_sql, dense_key


def date_bounds(orders: DataFrame, pos: DataFrame, settlements: DataFrame) -> DataFrame:
    """A-6 / J-7: one row (start_date, end_date).

    start = least(min(order_date of orders), min(txn_date of POS));
    end = greatest(max(settlement_date), max(txn_date of POS)).  ``least`` and
    ``greatest`` skip NULLs, which is exactly min/max over the union, so the
    four scalar subqueries become one aggregate (no join).
    """
    d = F.lit(None).cast("date")
    cand = (orders.select(F.col("order_date").alias("lo"), d.alias("hi"))
            .unionByName(pos.select(F.col("txn_date").alias("lo"), F.col("txn_date").alias("hi")))
            .unionByName(settlements.select(d.alias("lo"), F.col("settlement_date").alias("hi"))))
    return cand.agg(F.min("lo").alias("start_date"), F.max("hi").alias("end_date"))


def dim_date(orders: DataFrame, pos: DataFrame, settlements: DataFrame) -> DataFrame:
    """M-5: one row per day of the history with calendar attributes."""
    b = date_bounds(orders, pos, settlements)
    spine = b.select(F.explode(date_spine(F.col("start_date"), F.col("end_date")))
                     .alias("date_key"))
    dow = pg_day_of_week(F.col("date_key"))
    return spine.select(
        "date_key",
        F.year("date_key").cast("int").alias("year"),
        F.month("date_key").cast("int").alias("month"),
        F.dayofmonth("date_key").cast("int").alias("day"),
        F.quarter("date_key").cast("int").alias("quarter"),
        dow.alias("day_of_week"),
        pg_day_name(F.col("date_key")).alias("day_name"),
        dow.isin(0, 6).alias("is_weekend"))


def dim_product(products: DataFrame) -> DataFrame:
    """M-6: resolved catalogue with margin and margin percentage."""
    margin = F.col("unit_price") - F.col("unit_cost")
    return products.select(
        F.col("sku").alias("product_key"), "product_name", "category",
        "unit_cost", "unit_price",
        round_money(margin, 2, 13).alias("unit_margin"),
        F.round(margin / F.nullif(F.col("unit_price"), F.lit(0)), 3)
        .cast("decimal(10,3)").alias("margin_pct"))


def dim_store(pos: DataFrame) -> DataFrame:
    """M-7 / W-3: the stores seen in POS data, numbered by store id.

    The global window runs after ``distinct``, so it sees one row per store.
    """
    stores = pos.select("store_id").distinct()
    w = Window.orderBy(F.col("store_id").asc_nulls_last())
    return stores.select(
        F.col("store_id").alias("store_key"),
        F.concat(F.lit("Store "), F.substring("store_id", 7, 2)).alias("store_name"),
        F.row_number().over(w).cast("bigint").alias("store_number"))


ORDER_FACT_CONTENT = content_sql("channel", "store_id", "product_key", "quantity", "gross_revenue")
SETTLEMENT_FACT_CONTENT = content_sql("order_id", "channel", "product_key", "quantity", "gross_amount_usd",
                                      "fee_amount_usd", "net_amount_usd", "original_currency")


def order_lines(orders: DataFrame, pos: DataFrame) -> DataFrame:
    """U-1 with P-10, P-11: Shopify and POS lines in one shape (no key yet)."""
    shop = orders.select(
        F.col("order_date").alias("activity_date"), "channel",
        F.lit(None).cast("string").alias("store_id"),
        F.col("sku").alias("product_key"), "quantity",
        round_money(F.col("quantity") * F.col("unit_price")).alias("gross_revenue"))
    store = pos.select(
        F.col("txn_date").alias("activity_date"), "channel", "store_id",
        F.col("sku").alias("product_key"), "quantity",
        money("amount").alias("gross_revenue"))
    return shop.unionByName(store)


def fact_order_lines(orders: DataFrame, pos: DataFrame) -> DataFrame:
    """M-8 / W-4: order-date fact, keyed 1..N in activity-date order."""
    lines = order_lines(orders, pos)
    keyed = dense_key(lines, "order_line_key", "activity_date", F.expr(ORDER_FACT_CONTENT))
    return keyed.select("order_line_key", "activity_date", "channel", "store_id",
                        "product_key", "quantity", "gross_revenue")


def settlement_lines(settlements: DataFrame) -> DataFrame:
    return settlements.select(
        "order_id", F.col("settlement_date").alias("activity_date"), "channel",
        F.col("sku").alias("product_key"), "quantity",
        "gross_amount_usd", "fee_amount_usd", "net_amount_usd", "original_currency")


def fact_settlements(settlements: DataFrame) -> DataFrame:
    """M-9 / W-5: Amazon settlement fact, keyed in settlement-date order."""
    lines = settlement_lines(settlements)
    keyed = dense_key(lines, "settlement_key", "activity_date", F.expr(SETTLEMENT_FACT_CONTENT))
    return keyed.select("settlement_key", "order_id", "activity_date", "channel",
                        "product_key", "quantity", "gross_amount_usd", "fee_amount_usd",
                        "net_amount_usd", "original_currency")
