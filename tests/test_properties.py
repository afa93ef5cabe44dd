"""Property tests: the aggregation forms of the keep-one rulings (W-1, W-2)
equal the SQL row_number() = 1 forms on random rows with NULLs, ties and copies."""

import datetime as dt
from collections import Counter
from decimal import Decimal

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallyhouse.operators import clean

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

ts = st.one_of(st.none(), st.integers(0, 3).map(
    lambda d: dt.datetime(2024, 7, 1, 10) + dt.timedelta(days=d)))
money = st.one_of(st.none(), st.integers(0, 4).map(lambda c: Decimal(c * 125) / 100))
order_rows = st.lists(st.tuples(
    st.one_of(st.none(), st.integers(1, 3)),                  # order_id
    ts,                                                       # order_ts
    st.sampled_from(["A", "B", None]),                        # sku
    st.one_of(st.none(), st.integers(1, 2)),                  # quantity
    money,                                                    # unit_price
    st.sampled_from(["p0.json", "p1.json", "p2.json"]),       # source_file
), min_size=0, max_size=25)


@SETTINGS
@given(rows=order_rows)
def test_dedup_equals_row_number(spark, rows):
    stg = [(o, t, t.date() if t else None, s, q, p, "order", None, f) for o, t, s, q, p, f in rows]
    schema = ("order_id bigint, order_ts timestamp, order_date date, sku string, quantity int, "
              "unit_price decimal(12,2), record_type string, refund_amount decimal(12,2), "
              "source_file string")
    got = Counter(tuple(r) for r in clean.orders_deduplicated(
        spark.createDataFrame(stg, schema)).collect())
    con = duckdb.connect()
    con.execute(f"create table s ({schema})")
    if stg:
        con.executemany("insert into s values (?, ?, ?, ?, ?, ?, ?, ?, ?)", stg)
    want = Counter(con.execute("""
        select order_id, order_ts, order_date, sku, quantity, unit_price, 'shopify' from (
          select *, row_number() over (partition by order_id, sku, quantity, unit_price
                                       order by source_file, order_ts nulls first) rn
          from s where record_type = 'order') where rn = 1""").fetchall())
    assert got == want


product_rows = st.lists(st.tuples(
    st.sampled_from(["BB-X-1", "BLBX-1", "BB-Y-2", None]),    # raw sku
    st.sampled_from(["lamp", "vase", None]),                  # product_name
    money,                                                    # unit_cost
    money,                                                    # unit_price
), min_size=0, max_size=20)


@SETTINGS
@given(rows=product_rows)
def test_lowest_cost_wins_equals_row_number(spark, rows):
    from tallyhouse.operators import staging
    raw = [(s, n, "c", c, p, "f.xlsx") for s, n, c, p in rows]
    schema = ("sku string, product_name string, category string, unit_cost decimal(12,2), "
              "unit_price decimal(12,2), source_file string")
    got = Counter(tuple(r) for r in clean.products_resolved(
        staging.stg_products(spark.createDataFrame(raw, schema))).collect())
    con = duckdb.connect()
    con.execute(f"create table r ({schema})")
    if raw:
        con.executemany("insert into r values (?, ?, ?, ?, ?, ?)", raw)
    want = Counter(con.execute("""
        with s as (select case when sku like 'BLB%' then 'BB-' || substring(sku, 4, 3) || '-'
                                 || split_part(sku, '-', 2) else sku end as k, * from r)
        select k, product_name, category, unit_cost, unit_price from (
          select *, row_number() over (partition by k order by unit_cost asc nulls last,
             sku nulls first, product_name nulls first, category nulls first,
             unit_price nulls first) rn from s) where rn = 1""").fetchall())
    assert got == want
