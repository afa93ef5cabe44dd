"""One test per SQL-semantics trap T1..T16."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.functions import date_spine, normalize_sku, pg_day_name, pg_day_of_week, round_money
from tallyhouse.operators import bank, clean, marts, recon, staging


def one(spark, expr, schema="x int", row=(1,)):
    return spark.createDataFrame([row], schema).select(expr.alias("v")).first().v


def test_t1_null_cost_sorts_last(spark):
    df = spark.createDataFrame([("BB-A-1", "BB-A-1", "p", "c", None, Decimal("5")),
                                ("BB-A-1", "BB-A-1", "p", "c", Decimal("9"), Decimal("5"))],
                               "sku_normalized string, sku_raw string, product_name string, "
                               "category string, unit_cost decimal(12,2), unit_price decimal(12,2)")
    assert clean.products_resolved(df).first().unit_cost == Decimal("9")


def test_t2_t3_day_of_week_and_padded_name(spark):
    sunday = dt.date(2024, 7, 7)
    s = "d date"
    assert one(spark, pg_day_of_week(F.col("d")), s, (sunday,)) == 0
    assert one(spark, pg_day_of_week(F.col("d")), s, (dt.date(2024, 7, 13),)) == 6
    assert one(spark, pg_day_name(F.col("d")), s, (sunday,)) == "Sunday   "
    assert one(spark, pg_day_name(F.col("d")), s, (dt.date(2024, 7, 10),)) == "Wednesday"


def test_t4_reversed_or_null_range_is_empty(spark):
    s = "a date, b date"
    rows = spark.createDataFrame([(dt.date(2024, 7, 9), dt.date(2024, 7, 1)), (None, None)], s)
    assert rows.select(F.explode(date_spine(F.col("a"), F.col("b")))).count() == 0


def test_t5_t6_decimal_literals_and_half_away_rounding(spark):
    df = spark.createDataFrame([(1, "s", 1, Decimal("8.50"), Decimal("1.50"), Decimal("7.00"),
                                 "CAD", dt.date(2024, 7, 8))],
                               "order_id bigint, sku string, quantity int, gross_amount decimal(12,2), "
                               "fee_amount decimal(12,2), net_amount decimal(12,2), currency string, "
                               "settlement_date date")
    out = clean.settlements_usd(df)
    assert dict(out.dtypes)["gross_amount_usd"] == "decimal(14,2)"
    r = out.first()
    assert r.gross_amount_usd == Decimal("6.21")          # 6.205 -> 6.21
    assert one(spark, round_money(F.lit(Decimal("1.005")), 2)) == Decimal("1.01")
    assert one(spark, round_money(F.lit(Decimal("-2.5")), 0, 10)) == Decimal("-3")


def test_t7_row_numbers_are_bigint(spark):
    pos = spark.createDataFrame([("store_02",), ("store_01",)], "store_id string")
    d = marts.dim_store(pos)
    assert dict(d.dtypes)["store_number"] == "bigint"
    assert [(r.store_key, r.store_number, r.store_name) for r in d.orderBy("store_number").collect()] \
        == [("store_01", 1, "Store 01"), ("store_02", 2, "Store 02")]


def test_t8_strict_cast_raises(spark):
    raw = spark.createDataFrame([("SHOP-12x", None, None, None, None, "order", None, "f")],
                                "order_id string, created_at timestamp, sku string, quantity int, "
                                "price decimal(12,2), record_type string, refund_amount decimal(12,2), "
                                "source_file string")
    with pytest.raises(Exception):
        staging.stg_orders(raw).collect()


def test_t9_division_by_zero_is_null(spark):
    p = spark.createDataFrame([("BB-A-1", "n", "c", Decimal("0"), Decimal("0"))],
                              "sku string, product_name string, category string, "
                              "unit_cost decimal(12,2), unit_price decimal(12,2)")
    assert marts.dim_product(p).first().margin_pct is None


def test_t10_bounds_skip_nulls(spark):
    o = spark.createDataFrame([(None,)], "order_date date")
    p = spark.createDataFrame([(dt.date(2024, 7, 2),)], "txn_date date")
    s = spark.createDataFrame([(dt.date(2024, 7, 4),)], "settlement_date date")
    b = marts.date_bounds(o, p, s).first()
    assert (b.start_date, b.end_date) == (dt.date(2024, 7, 2), dt.date(2024, 7, 4))
    assert marts.dim_date(o, p, s).count() == 3


def test_t11_split_part_out_of_range(spark):
    assert one(spark, normalize_sku(F.col("x")), "x string", ("BLBDEC",)) == "BB-DEC-"
    assert one(spark, normalize_sku(F.col("x")), "x string", ("BLBDEC-0001",)) == "BB-DEC-0001"
    assert one(spark, normalize_sku(F.col("x")), "x string", ("BB-DEC-0001",)) == "BB-DEC-0001"


def test_t12_empty_channel_still_yields_a_row(spark):
    e_orders = spark.createDataFrame([], "quantity int, unit_price decimal(12,2)")
    e_ref = spark.createDataFrame([], "refund_amount decimal(12,2)")
    e_pos = spark.createDataFrame([], "amount decimal(12,2)")
    e_amz = spark.createDataFrame([], "net_amount_usd decimal(14,2)")
    nets = {r.channel: r.warehouse_net_revenue
            for r in recon.channel_nets(e_orders, e_ref, e_pos, e_amz).collect()}
    assert nets == {"shopify": None, "pos": None, "amazon": None}
    b = spark.createDataFrame([("shopify", Decimal("10.00"))], "channel string, bank_net_revenue decimal(14,2)")
    r = recon.reconcile(recon.channel_nets(e_orders, e_ref, e_pos, e_amz), b).first()
    assert r.status == "RESIDUAL" and r.gap_pct is None      # NULL -> RESIDUAL; channels not in the control drop


def test_t13_timestamps_cast_to_date_in_utc(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    raw = spark.createDataFrame([("store_07", "2024-07-02 00:40:00", "s", 1, Decimal("1"), "sale", "f")],
                                "store_id string, txn_timestamp string, sku string, quantity int, "
                                "amount decimal(12,2), txn_type string, source_file string")
    assert staging.stg_pos(raw).first().txn_date == dt.date(2024, 7, 2)


def test_t15_missing_currency_defaults_to_usd(spark):
    raw = spark.createDataFrame([("AMZ-1", None), ("AMZ-2", "usd")], "amazon_order_id string, currency string")
    raw = raw.select("amazon_order_id", *[F.lit(None).cast(t).alias(c) for c, t in
                                          [("sku", "string"), ("quantity", "int"),
                                           ("gross_amount", "decimal(12,2)"), ("fee_amount", "decimal(12,2)"),
                                           ("net_amount", "decimal(12,2)")]],
                     "currency", F.lit(None).cast("date").alias("settlement_date"),
                     F.lit("f").alias("source_file"))
    assert {r.currency for r in staging.stg_settlements(raw).collect()} == {"USD"}


def test_k9_bank_seed_sink(spark, tmp_path):
    from tallyhouse.sources.files import read_bank_seed
    b = spark.createDataFrame([("pos", Decimal("2.50")), ("amazon", Decimal("1.00"))],
                              "channel string, bank_net_revenue decimal(14,2)")
    bank.write_bank_seed(b, str(tmp_path / "seed"))
    back = read_bank_seed(spark, str(tmp_path / "seed"))
    assert [(r.channel, r.bank_net_revenue) for r in back.collect()] == \
        [("amazon", Decimal("1.00")), ("pos", Decimal("2.50"))]


def test_s10_bank_seed_from_answer_key(spark, tmp_path):
    from tallyhouse.sources.files import read_bank_seed
    dep = spark.createDataFrame([(dt.date(2024, 7, 1), "pos", Decimal("2.25")),
                                 (dt.date(2024, 7, 2), "pos", Decimal("-0.75")),
                                 (dt.date(2024, 7, 1), "amazon", Decimal("8.50"))],
                                "deposit_date date, channel string, net_deposit decimal(14,2)")
    dep.write.parquet(str(tmp_path / "_bank_deposits.parquet"))
    bank.make_bank_seed(spark, str(tmp_path / "_bank_deposits.parquet"), str(tmp_path / "seed"))
    got = {r.channel: r.bank_net_revenue for r in read_bank_seed(spark, str(tmp_path / "seed")).collect()}
    assert got == {"amazon": Decimal("8.50"), "pos": Decimal("1.50")}
