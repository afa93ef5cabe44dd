"""W-4 / W-5 distributed dense keys against a brute-force global row_number,
with tiny buckets and chunks so the hot-date split and the copy expansion run."""

import datetime as dt
import random
from decimal import Decimal

import duckdb

from tallyhouse.operators.keys import content_sql, dense_key, key_order_sql


def test_dense_key_matches_global_row_number(spark):
    rnd = random.Random(7)
    hot = dt.date(2024, 7, 1)
    rows = []
    for i in range(400):
        d = hot if i < 250 else (None if i % 50 == 0 else dt.date(2024, 7, 2 + i % 5))
        rows.append((d, "pos" if i % 3 else "shopify", f"store_{i % 4:02d}" if i % 3 else None,
                     f"BB-X-{rnd.randint(1, 9):04d}", rnd.randint(-2, 3),
                     Decimal(rnd.randint(-500, 5000)) / 100))
    rows += [rows[3]] * 7 + [rows[260]] * 3          # groups of identical copies
    schema = ("activity_date date, channel string, store_id string, product_key string, "
              "quantity int, gross_revenue decimal(14,2)")
    df = spark.createDataFrame(rows, schema)
    content = content_sql("gross_revenue", "quantity")
    from pyspark.sql import functions as F
    got = dense_key(df, "k", "activity_date", F.expr(content), rows_per_bucket=16, chunk=2)
    got_rows = sorted((r.k, r.activity_date, r.channel, r.store_id, r.product_key, r.quantity,
                       r.gross_revenue) for r in got.collect())
    assert [r[0] for r in got_rows] == list(range(1, len(rows) + 1))

    con = duckdb.connect()
    con.execute("create table t (activity_date date, channel varchar, store_id varchar, "
                "product_key varchar, quantity int, gross_revenue decimal(14,2))")
    con.executemany("insert into t values (?, ?, ?, ?, ?, ?)", rows)
    order = key_order_sql("activity_date", content,
                          ["channel", "store_id", "product_key", "quantity", "gross_revenue"],
                          rows_per_bucket=16)
    want = sorted(con.execute(
        f"select row_number() over (order by {order}) as k, activity_date, channel, store_id, "
        f"product_key, quantity, gross_revenue from "
        f"(select *, count(*) over (partition by activity_date) as _dn from t) l").fetchall())
    assert got_rows == want


def test_order_is_the_same_for_every_bucket_size(spark):
    from pyspark.sql import functions as F
    content = content_sql("product_key", "quantity", "order_id")
    df = spark.range(3000).select(
        F.lit(dt.date(2024, 7, 1)).alias("activity_date"), F.lit("BB-X-0001").alias("product_key"),
        F.lit(1).alias("quantity"), F.col("id").alias("order_id"))
    one = {r.order_id: r.k for r in dense_key(df, "k", "activity_date", F.expr(content)).collect()}
    many = {r.order_id: r.k for r in dense_key(df, "k", "activity_date", F.expr(content),
                                               rows_per_bucket=10).collect()}
    assert one == many and sorted(one.values()) == list(range(1, 3001))


def test_one_sku_and_price_still_spread_over_buckets(spark):
    from pyspark.sql import functions as F
    content = content_sql("product_key", "quantity", "order_id")
    df = spark.range(20_000).select(F.lit("BB-X-0001").alias("product_key"), F.lit(1).alias("quantity"),
                                    F.col("id").alias("order_id"))
    sizes = [r["count"] for r in df.groupBy(F.expr(content).substr(1, 1)).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 1.2 * 20_000 / 16


def test_no_hash_is_shuffled(spark):
    """rows are shuffled without the hash that orders them."""
    from pyspark.sql import functions as F
    df = spark.range(100).select(F.date_add(F.lit(dt.date(2024, 7, 1)), (F.col("id") % 9).cast("int")).alias("activity_date"),
                                 F.col("id").alias("order_id"))
    keyed = dense_key(df, "k", "activity_date", F.expr(content_sql("order_id")))
    plan = keyed._jdf.queryExecution().executedPlan().toString().split("\n")
    moved = [below for above, below in zip(plan, plan[1:]) if "Exchange hashpartitioning" in above]
    assert len(moved) > 2 and not any(" AS _h#" in row or "_h#" in row for row in moved)
