"""File scans S1..S5 on tiny hand-made feeds with the known defects."""

import json
from decimal import Decimal

import pytest

from tallyhouse.operators import clean, staging
from tallyhouse.sources import files as fs
from tallyhouse.sources import workbook


def write(path, data: bytes | str):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data if isinstance(data, bytes) else data.encode("utf-8"))


ORDER_A = {"order_id": "SHOP-1", "created_at": "2024-07-01T10:00:00", "discount": 0.0,
           "line_items": [{"sku": "BB-DEC-0001", "quantity": 2, "price": 10.5},
                          {"sku": "BB-KIT-0002", "quantity": 1, "price": 3.25}]}
ORDER_B = {"order_id": "SHOP-2", "created_at": "2024-08-02T11:00:00",
           "discount_allocations": [{"amount": 0.0, "type": "line_item"}],
           "line_items": [{"sku": "BB-BAT-0003", "quantity": 1, "price": 7.0},
                          {"sku": "BB-BAT-0003", "quantity": 1, "price": 7.0}]}
REFUND_A = {"order_id": "SHOP-1", "created_at": "2024-07-20T09:00:00", "type": "refund",
            "refund_amount": 21.0}
EMPTY_OBJ = {"order_id": "SHOP-3", "created_at": "2024-07-03T00:00:00"}


@pytest.fixture
def shop_dir(tmp_path):
    d = tmp_path / "raw"
    write(d / "shopify/orders_page_000.json",
          json.dumps({"orders": [ORDER_A, ORDER_B, REFUND_A, EMPTY_OBJ, ORDER_B]}))
    write(d / "shopify/orders_page_001.json", json.dumps({"orders": [ORDER_A]}))
    write(d / "shopify/orders_page_002.json", json.dumps({"orders": []}))
    write(d / "shopify/orders_page_003.json", json.dumps({"next": None}))
    return str(d)


def test_order_pages(spark, shop_dir):
    raw = fs.scan(spark, shop_dir, "shopify")
    rows = raw.collect()
    assert len(rows) == 2 + 2 + 2 + 2 + 1   # A, B, B-retry, A-retry, refund
    refunds = [r for r in rows if r.record_type == "refund"]
    assert len(refunds) == 1 and refunds[0].sku is None and refunds[0].quantity is None
    assert refunds[0].refund_amount == Decimal("21.00")
    assert {r.source_file for r in rows} == {"orders_page_000.json", "orders_page_001.json"}
    assert all(r.price is not None for r in rows if r.record_type == "order")

    dedup = clean.orders_deduplicated(staging.stg_orders(raw)).collect()
    # A keeps its 2 lines once; B's identical double line collapses to 1 (quirk Q-1)
    assert sorted((r.order_id, r.sku) for r in dedup) == [
        (1, "BB-DEC-0001"), (1, "BB-KIT-0002"), (2, "BB-BAT-0003")]
    shapes = {r.shape: r.orders for r in fs.discount_shapes(fs.read_files(spark, shop_dir, "shopify")).collect()}
    assert shapes == {"discount": 2, "discount_allocations": 2, "none": 1}


def test_settlement_two_layouts(spark, tmp_path):
    d = tmp_path / "raw"
    write(d / "amazon/settlement_2024-07-08.csv",
          "amazon_order_id,sku,quantity,gross_amount,fee_amount,net_amount,currency,settlement_date\n"
          "AMZ-10,BB-DEC-0001,2,20.00,3.00,17.00,USD,2024-07-08\n"
          "AMZ-11,BB-DEC-0002,1,10.00,1.50,8.50,CAD,2024-07-08\n")
    write(d / "amazon/settlement_2024-08-05.csv",
          "order_id,item_sku,units,revenue,commission,net_proceeds,currency,settle_date\n"
          "AMZ-12,BB-KIT-0003,3,30.00,4.50,25.50,usd,2024-08-05\n"
          "AMZ-13,BB-KIT-0004,1,5.00,0.75,4.25,,2024-08-05\n")
    write(d / "amazon/settlement_2024-08-12.csv",   # new layout, other column order
          "settle_date,net_proceeds,commission,revenue,units,item_sku,order_id,currency\r\n"
          "2024-08-12,8.50,1.50,10.00,1,BB-BAT-0005,AMZ-14,CAD\r\n\r\n")
    write(d / "amazon/settlement_2024-08-19.csv",   # no currency column
          "order_id,item_sku,units,revenue,commission,net_proceeds,settle_date\n"
          "AMZ-15,BB-BAT-0006,2,4.00,0.60,3.40,2024-08-19\n")
    feed = fs.Feed(str(d), "amazon")
    raw = fs.parse_settlements(spark, feed)
    rows = {r.amazon_order_id: r for r in raw.collect()}
    assert set(rows) == {f"AMZ-{i}" for i in range(10, 16)}
    assert rows["AMZ-14"].sku == "BB-BAT-0005" and rows["AMZ-14"].quantity == 1
    assert rows["AMZ-14"].net_amount == Decimal("8.50")
    assert rows["AMZ-15"].currency is None
    usd = {r.order_id: r for r in clean.settlements_usd(staging.stg_settlements(raw)).collect()}
    assert usd[11].net_amount_usd == Decimal("6.21")      # 8.50 * 0.73 = 6.205 -> 6.21
    assert usd[12].original_currency == "USD" and usd[13].original_currency == "USD"
    assert usd[15].original_currency == "USD"
    layouts = {r.layout: r.files for r in fs.settlement_layouts(spark, feed).collect()}
    assert layouts == {"landed": 1, "renamed": 3}


def test_pos_mixed_encoding(spark, tmp_path):
    d = tmp_path / "raw"
    write(d / "pos/store_01_2024-07-01.csv",
          "store_id,timestamp,sku,quantity,amount,txn_type\n"
          "store_01,2024-07-01 12:00:00,BB-DEC-0001,2,20.00,sale\n"
          "store_01,2024-07-01 13:00:00,BB-DEC-0001,-1,-10.00,sale\n"
          "store_01,2024-07-01 14:00:00,BB-DEC-0002,0,0.00,sale\n")
    write(d / "pos/store_11_2024-07-01.csv",
          "store_id,timestamp,sku,quantity,amount,txn_type,note\n"
          "store_11,2024-07-01 09:00:00,BB-KIT-0003,1,5.00,sale,Chef\x92s pick\n"
          "store_11,2024-07-01 09:05:00,BB-KIT-0003,-1,-5.00,training,practice\n"
          .encode("latin-1"))
    write(d / "pos/store_07_2024-07-02.csv",
          "store_id,timestamp,sku,quantity,amount,txn_type\n"
          "store_07,2024-07-02 00:40:00,BB-KIT-0004,1,4.00,sale\n")
    feed = fs.Feed(str(d), "pos")
    assert [r.file_name for r in fs.non_utf8_files(spark, feed).collect()] == ["store_11_2024-07-01.csv"]
    raw = fs.parse_pos(spark, feed)
    rows = raw.collect()
    assert len(rows) == 6
    assert sum(1 for r in rows if r.txn_type == "training") == 1
    pos = clean.pos_classified(staging.stg_pos(raw)).collect()
    assert len(pos) == 5                                   # training dropped
    assert sorted(r.line_type for r in pos).count("return") == 1   # qty 0 is a sale
    skew = [r for r in pos if r.store_id == "store_07"][0]
    assert str(skew.txn_date) == "2024-07-02"              # 00:40 keeps its date (Q-3)


def test_pos_missing_required_column_fails(spark, tmp_path):
    d = tmp_path / "raw"
    write(d / "pos/store_02_2024-07-01.csv", "store_id,timestamp,quantity,amount,txn_type\n"
          "store_02,2024-07-01 12:00:00,1,2.00,sale\n")
    with pytest.raises(Exception, match="without column 'sku'"):
        fs.parse_pos(spark, fs.Feed(str(d), "pos")).collect()


def test_product_workbook(spark, tmp_path):
    d = tmp_path / "raw"
    header = ["SKU", "Product Name", "Category", "Unit Cost", "Unit Price"]
    rows = [["BB-DEC-0001", "Lamp", "Decor", 4.0, 10.0],
            ["BLBDEC-0002", "Vase", "Decor", 6.0, 15.0],          # newer SKU form
            ["BB-DEC-0002", "Vase", "Decor", 7.2, 15.0],          # same product, old form, 1.2x
            ["BB-KIT-0003", "Pan", "Kitchen", None, 20.0],        # NULL cost (trap T1)
            ["BB-KIT-0003", "Pan", "Kitchen", 9.0, 20.0]]
    data = workbook.build_workbook("Product master - do not edit", header, rows,
                                   hidden=("Discontinued_DO_NOT_USE", ["SKU", "Note"],
                                           [["BB-OLD-0009", "gone"]]))
    write(d / "product_master.xlsx", data)
    assert workbook.sheet_states(data) == {"Products": "visible",
                                           "Discontinued_DO_NOT_USE": "hidden"}
    raw = fs.scan(spark, str(d), "product")
    got = raw.collect()
    assert len(got) == 5 and all(r.source_file == "product_master.xlsx" for r in got)
    assert "BB-OLD-0009" not in {r.sku for r in got}
    res = {r.sku: r for r in clean.products_resolved(staging.stg_products(raw)).collect()}
    assert set(res) == {"BB-DEC-0001", "BB-DEC-0002", "BB-KIT-0003"}
    assert res["BB-DEC-0002"].unit_cost == Decimal("6.00")   # lowest cost wins
    assert res["BB-KIT-0003"].unit_cost == Decimal("9.00")   # NULL cost never wins


def test_bank_seed(spark, tmp_path):
    p = tmp_path / "bank_deposits_by_channel.csv"
    write(p, "channel,bank_net_revenue\namazon,8989862.73\npos,6049528.53\nshopify,13582122.73\n")
    got = {r.channel: r.bank_net_revenue for r in fs.read_bank_seed(spark, str(p)).collect()}
    assert got["pos"] == Decimal("6049528.53")


def test_csv_any_width_quotes_and_short_rows(spark, tmp_path):
    d = tmp_path / "raw"
    extra = [f"extra_{i}" for i in range(40)]
    cells = ",".join(str(i) for i in range(40))
    write(d / "amazon/settlement_2024-07-08.csv",
          ",".join([*extra, "amazon_order_id", "sku", "quantity", "gross_amount", "fee_amount", "net_amount",
                    "currency", "settlement_date", "note"]) + "\n"
          + cells + ',AMZ-1,BB-DEC-0001,2,20.00,3.00,17.00,USD,2024-07-08,"two\nlines, and a ""quote"""\n'
          + cells + ",AMZ-2,BB-DEC-0002,1,10.00,1.50,8.50\r\n"
          + cells + ',AMZ-3,"BB,COMMA",,,,,,2024-07-09,\n')
    rows = {r.amazon_order_id: r for r in fs.scan(spark, str(d), "amazon").collect()}
    assert set(rows) == {"AMZ-1", "AMZ-2", "AMZ-3"}
    assert rows["AMZ-1"].net_amount == Decimal("17.00") and str(rows["AMZ-1"].settlement_date) == "2024-07-08"
    assert rows["AMZ-2"].currency is None and rows["AMZ-2"].settlement_date is None
    assert rows["AMZ-3"].sku == "BB,COMMA" and rows["AMZ-3"].quantity is None


def test_pos_quoted_line_feed_is_one_row(spark, tmp_path):
    d = tmp_path / "raw"
    write(d / "pos/store_01_2024-07-01.csv", "note,store_id,timestamp,sku,quantity,amount,txn_type\n"
          '"two\nlines",store_01,2024-07-01 12:00:00,BB-DEC-0001,2,20.00,sale\n')
    (row,) = fs.scan(spark, str(d), "pos").collect()
    assert (row.store_id, row.quantity, row.txn_type) == ("store_01", 2, "sale")


@pytest.mark.parametrize("line, message", [
    ("store_01,2024-07-01 12:00:00,BB-DEC-0001,2,20.00,sale,more", "more fields"),
    ('store_01,2024-07-01 12:00:00,"BB-DEC-0001,2,20.00,sale', "open quote")])
def test_malformed_csv_fails(spark, tmp_path, line, message):
    d = tmp_path / "raw"
    write(d / "pos/store_01_2024-07-01.csv", "store_id,timestamp,sku,quantity,amount,txn_type\n" + line + "\n")
    with pytest.raises(Exception, match=message):
        fs.scan(spark, str(d), "pos").collect()


@pytest.mark.parametrize("key", ["sku", "quantity", "price", "order_id"])
def test_order_entry_without_a_required_key_fails(spark, tmp_path, key):
    order = json.loads(json.dumps(ORDER_A))
    (order if key == "order_id" else order["line_items"][1]).pop(key)
    write(tmp_path / "raw/shopify/orders_page_000.json", json.dumps({"orders": [ORDER_B, order]}))
    with pytest.raises(Exception, match=f"without '{key}'"):
        fs.scan(spark, str(tmp_path / "raw"), "shopify").collect()


def test_only_files_directly_in_a_source_folder_count(spark, tmp_path):
    d = tmp_path / "raw"
    head = "store_id,timestamp,sku,quantity,amount,txn_type\n"
    write(d / "pos/now.csv", head)
    write(d / "pos/archive/old.csv", head)
    write(d / "product_master_old.xlsx", b"no workbook")
    assert [r.file_name for r in fs.read_files(spark, str(d), "pos").collect()] == ["now.csv"]
    assert fs.read_files(spark, str(d), "pos", nested=True).count() == 2
    assert fs.read_files(spark, str(d), "product").count() == 0


def test_workbook_shared_and_rich_strings(spark, tmp_path):
    import io
    import zipfile
    ns = workbook.NS["m"]
    plain = zipfile.ZipFile(io.BytesIO(workbook.build_workbook("T", ["SKU"], [])))
    strings = ["Title", "SKU", "Unit Price", "BB-DEC-0001", "Product Name"]
    items = "".join(f"<si><t>{s}</t></si>" for s in strings) + \
        '<si><r><t>Big </t></r><r><rPr><b/></rPr><t xml:space="preserve">lamp &amp; co </t></r></si>'
    sheet = (f'<worksheet xmlns="{ns}"><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c></row>'
             '<row r="2"><c r="B2" t="s"><v>1</v></c><c r="C2" t="s"><v>4</v></c><c r="AA2" t="s"><v>2</v></c></row>'
             '<row r="3"><c r="B3" t="s"><v>3</v></c><c r="C3" t="s"><v>5</v></c><c r="AA3"><v>12.5</v></c></row>'
             '<row r="4"><c r="B4"><v>77</v></c></row><row r="5"><c r="B5"/></row></sheetData></worksheet>')
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name in plain.namelist():
            z.writestr(name, sheet if name == "xl/worksheets/sheet1.xml" else plain.read(name))
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{ns}">{items}</sst>')
    write(tmp_path / "raw/product_master.xlsx", out.getvalue())
    rows = {r.sku: r for r in fs.scan(spark, str(tmp_path / "raw"), "product").collect()}
    assert set(rows) == {"BB-DEC-0001", "77"}
    assert rows["BB-DEC-0001"].product_name.split() == ["Big", "lamp", "&", "co"]
    assert rows["BB-DEC-0001"].unit_price == Decimal("12.50") and rows["77"].category is None


SETTLED = ("order_id,item_sku,units,revenue,commission,net_proceeds,currency,settle_date\n"
           "AMZ-{},BB-DEC-0001,2,20.00,3.00,17.00,USD,2024-07-08\n")


@pytest.mark.parametrize("spans", [False, True])
def test_byte_order_mark_keeps_ids(spark, tmp_path, spans):
    d = tmp_path / "raw"
    head, row = SETTLED.format(5).splitlines()
    more = ',"two\nlines"' if spans else ","
    write(d / "amazon/with mark+.csv", ("\ufeff" + head + ",note\n" + row + more + "\n").encode())
    write(d / "pos/marked.csv", "\ufeffstore_id,timestamp,sku,quantity,amount,txn_type\n"
          "store_01,2024-07-01 12:00:00,BB-DEC-0001,2,20.00,sale\n")
    (r,) = fs.scan(spark, str(d), "amazon").collect()
    assert (r.amazon_order_id, r.currency, r.source_file) == ("AMZ-5", "USD", "with mark+.csv")
    assert [(x.layout, x.files) for x in fs.settlement_layouts(spark, fs.Feed(str(d), "amazon")).collect()] == [
        ("renamed", 1)]
    assert fs.scan(spark, str(d), "pos").first().store_id == "store_01"


def test_quoted_line_feeds_in_both_encodings(spark, tmp_path):
    d = tmp_path / "raw"
    head = "note,store_id,timestamp,sku,quantity,amount,txn_type\n"
    body = '"Chef\x92s\r\n\npick, ""rare""",store_1{0},2024-07-01 12:00:00,BB-DEC-0001,{0},20.00,sale\n'
    write(d / "pos/odd.csv", (head + body.format(1) + body.format(2)).encode("latin-1"))
    write(d / "pos/even.csv", head + body.format(3).replace("\x92", "’"))
    write(d / "pos/plain.csv", (head + "Chef\x92s,store_14,2024-07-01 12:00:00,BB-DEC-0001,4,20.00,sale\n")
          .encode("latin-1"))
    rows = fs.scan(spark, str(d), "pos").collect()
    assert sorted((r.store_id, r.quantity, r.source_file) for r in rows) == [
        ("store_11", 1, "odd.csv"), ("store_12", 2, "odd.csv"), ("store_13", 3, "even.csv"), ("store_14", 4, "plain.csv")]


def test_large_csv_files_are_split_and_not_read_as_binary(spark, tmp_path):
    d = tmp_path / "raw"
    head, row = SETTLED.format("{}").splitlines()
    write(d / "amazon/large.csv", head + "\n" + "".join(row.format(k) + "\n" for k in range(4000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32768")
    try:
        rows = fs.scan(spark, str(d), "amazon")
        assert "binaryFile" not in rows._jdf.queryExecution().executedPlan().toString()
        assert fs.Feed(str(d), "amazon").lines(spark).rdd.getNumPartitions() > 4
        assert sorted(int(r.amazon_order_id[4:]) for r in rows.collect()) == list(range(4000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_settlements_without_order_ids_fail(spark, tmp_path):
    write(tmp_path / "raw/amazon/odd.csv", "id,sku\n1,BB-DEC-0001\n")
    with pytest.raises(Exception, match="without column 'amazon_order_id'"):
        fs.scan(spark, str(tmp_path / "raw"), "amazon").collect()


def test_files_without_lines(spark, tmp_path):
    write(tmp_path / "raw/amazon/empty.csv", "")             # Spark does not list files of zero bytes
    write(tmp_path / "raw/amazon/blank.csv", "\n\n")
    assert fs.scan(spark, str(tmp_path / "raw"), "amazon").count() == 0
    layouts = fs.settlement_layouts(spark, fs.Feed(str(tmp_path / "raw"), "amazon"))
    assert [(r.layout, r.files) for r in layouts.collect()] == [("unknown", 1)]
    assert fs.scan(spark, str(tmp_path / "nothing"), "pos").count() == 0


def test_pages_are_written_by_few_tasks_and_lines_joined_once(spark, tmp_path):
    """F1..F5, F7, F9, F11: the landing's raw rows, with and without stored lines."""
    from tallyhouse.sources import tables, writers
    orders = [(k, k % 3, f"1995-01-0{1 + k % 9}") for k in range(1, 41)] + [(None, 1, "1995-01-01")]
    lines = [(k, 1 + k % 5, k, n, 2.0 + n, "R" if k % 4 == 0 else "N") for k in range(1, 41) for n in (1, 2)]
    spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint, o_orderdate string").write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame(lines + lines[:1], "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber bigint, l_quantity double, "
                          "l_returnflag string").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(k, f"p{k}", "SMALL BOX", 10.0 + k) for k in range(1, 6)],
                          "p_partkey bigint, p_name string, p_type string, p_retailprice double").write.parquet(str(tmp_path / "part.parquet"))
    lazy, stored = (tables.adapter_raw(spark, str(tmp_path), stored=s) for s in (False, True))
    for name in tables.RawTables.__dataclass_fields__:
        a, b = getattr(lazy, name), getattr(stored, name)
        assert a.schema.simpleString() == b.schema.simpleString()
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert "lineitem" not in stored.shopify_orders._jdf.queryExecution().toString()
    assert "Join" not in stored.shopify_orders._jdf.queryExecution().toString()
    n = writers.write_order_pages(stored.shopify_orders, str(tmp_path / "land/shopify"), "1995-01-05", page_size=1)
    files = [p.name for p in (tmp_path / "land/shopify").iterdir() if p.suffix == ".json"]
    assert n > 8 and len(files) > len({f.split("-")[1] for f in files})      # a task writes several pages
    got = fs.scan(spark, str(tmp_path / "land"), "shopify").drop("source_file")
    assert sorted(map(str, got.collect())) == sorted(map(str, lazy.shopify_orders.drop("source_file").collect()))
