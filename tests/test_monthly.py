"""Facts in monthly parts (K-8, D-3): late files rewrite their months alone."""

import json

from feeds import POS_01, make_landing, put
from tallyhouse.plans import monthly
from tallyhouse.plans.models import Models
from tallyhouse.sources import manifest as mf

FACTS = ("fact_order_lines", "fact_settlements")


def same_as_full_build(spark, wh):
    full = Models(mf.raw_tables(spark, wh))
    bank = spark.sql("select 'pos' as channel, cast(1 as decimal(38,2)) as bank_net_revenue")
    for t in FACTS:
        got = monthly.fact(spark, wh, t)
        want = full.model(t)
        assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in want.schema]
        assert sorted(got.collect(), key=lambda r: r[0]) == sorted(want.collect(), key=lambda r: r[0]), t
    parts = monthly.models(spark, wh, bank)
    for t in ("orders_deduplicated", "dim_date", "dim_store", "revenue_reconciliation"):
        want = Models(mf.raw_tables(spark, wh), bank=bank).model(t)
        assert sorted(map(str, parts.model(t).select(*want.columns).collect())) == sorted(map(str, want.collect())), t


def page(root, name, *orders):
    put(root / f"shopify/{name}.json", json.dumps({"orders": [
        {"order_id": f"SHOP-{i}", "created_at": at, "discount": 0.0,
         "line_items": [{"sku": sku, "quantity": 1, "price": 10.0}]} for i, at, sku in orders]}))


def versions(spark, wh, table):
    return {m: p.version for (t, m), p in monthly.current_parts(spark, wh).items() if t == table}


def test_late_files_write_their_months_alone(spark, tmp_path):
    root, wh = tmp_path / "landing", mf.Warehouse(str(tmp_path / "wh"))
    make_landing(root)
    page(root, "orders_page_050", (50, "2024-03-05T10:00:00", "A"), (51, "2024-09-05T10:00:00", "B"))
    mf.ingest(spark, wh, str(root))
    assert monthly.refresh(spark, wh)["fact_order_lines"] == ["2024-03", "2024-07", "2024-09"]
    same_as_full_build(spark, wh)
    assert not any(monthly.refresh(spark, wh).values())                     # nothing new
    before = versions(spark, wh, "fact_order_lines")

    # a store's late night: one month of one fact; the keys of later months shift
    put(root / "pos/store_02_2024-03-01.csv", POS_01.replace("2024-07", "2024-03"))
    mf.ingest(spark, wh, str(root))
    assert {t: ms for t, ms in monthly.refresh(spark, wh).items() if ms} == {
        "pos_classified": ["2024-03"], "fact_order_lines": ["2024-03"]}
    after = versions(spark, wh, "fact_order_lines")
    assert [m for m in after if after[m] != before[m]] == ["2024-03"]
    same_as_full_build(spark, wh)


def test_late_copies_of_an_order_line(spark, tmp_path):
    root, wh = tmp_path / "landing", mf.Warehouse(str(tmp_path / "wh"))
    page(root, "orders_page_050", (1, "2024-03-05T10:00:00", "A"), (2, "2024-04-05T10:00:00", "B"), (3, "2024-05-05T10:00:00", "C"))
    mf.ingest(spark, wh, str(root), "shopify")
    monthly.refresh(spark, wh)
    # a copy that loses changes nothing; one that wins with the same time changes no fact
    page(root, "orders_page_060", (1, "2024-06-05T10:00:00", "A"))
    page(root, "orders_page_040", (2, "2024-04-05T10:00:00", "B"))
    mf.ingest(spark, wh, str(root), "shopify")
    got = monthly.refresh(spark, wh)
    assert (got["orders_deduplicated"], got["fact_order_lines"]) == (["2024-04"], [])
    same_as_full_build(spark, wh)
    # a winning copy of another month empties the old month
    page(root, "orders_page_030", (1, "2024-06-07T10:00:00", "A"))
    mf.ingest(spark, wh, str(root), "shopify")
    assert monthly.refresh(spark, wh)["fact_order_lines"] == ["2024-03", "2024-06"]
    assert monthly.current_parts(spark, wh)["fact_order_lines", "2024-03"].rows == 0
    same_as_full_build(spark, wh)
    # 045 would win over 050, but 040 has won since
    page(root, "orders_page_045", (2, "2024-08-05T10:00:00", "B"))
    mf.ingest(spark, wh, str(root), "shopify")
    assert monthly.refresh(spark, wh)["orders_deduplicated"] == []
    same_as_full_build(spark, wh)


def test_overlapping_loads_count_once(spark, tmp_path):
    root, wh = tmp_path / "landing", mf.Warehouse(str(tmp_path / "wh"))
    make_landing(root)
    mf.load_source(spark, wh, str(root), "pos", before_commit=lambda: (
        mf.load_source(spark, wh, str(root), "pos"), monthly.refresh(spark, wh)))
    monthly.refresh(spark, wh)
    same_as_full_build(spark, wh)


def test_empty_warehouse(spark, tmp_path):
    wh = mf.Warehouse(str(tmp_path / "wh"))
    assert not any(monthly.refresh(spark, wh).values())
    for t in FACTS:
        assert monthly.fact(spark, wh, t).count() == 0
