"""Writing the raw tables back out in their messy landing formats.

Used for round trips (raw table -> files -> scans -> raw rows) and for drip
folders.  All writes are Spark writes except workbooks, which Spark has no
writer for: each workbook is built inside one task (bounded rows per book) and
written through ``pyarrow.fs`` (local, HDFS or object-store URIs), under a
deterministic name so a retried task rewrites the same file.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.session import drop_scratch, scratch_path
from tallyhouse.sources.files import SETTLEMENT_RENAME

# The default page size of order exports and the row cap of a
# workbook written here.
PAGE_SIZE = 500
BOOK_ROWS = 50_000

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"


def _buckets(df: DataFrame, per_bucket: int) -> int:
    return max(1, math.ceil(df.count() / per_bucket))


def write_order_pages(raw_orders: DataFrame, out: str, drift_date: str,
                      page_size: int = PAGE_SIZE) -> int:
    """Order rows -> ``{"orders": [...]}`` page documents, one page per file.

    Lines regroup into order objects by (order_id, created_at, source_file);
    objects before ``drift_date`` carry the flat ``discount`` shape, later ones
    ``discount_allocations``.  Pages are hash buckets of objects sized to
    ``page_size`` on average.  Returns the number of pages.
    """
    ts = F.date_format("created_at", ISO_SECONDS)
    orders = raw_orders.where(F.col("record_type") == "order")
    objs = (orders.groupBy("order_id", "created_at", "source_file")
            .agg(F.collect_list(F.struct("sku", "quantity", "price")).alias("line_items")))
    old = F.col("created_at") < F.lit(drift_date).cast("timestamp")
    order_objs = objs.select(
        "order_id", "source_file", F.struct(
            F.col("order_id"), ts.alias("created_at"), F.lit(None).cast("string").alias("type"),
            F.lit(None).cast("decimal(12,2)").alias("refund_amount"), F.col("line_items"),
            F.when(old, F.lit(0.0)).alias("discount"),
            F.when(~old, F.array(F.struct(F.lit(0.0).alias("amount"),
                                          F.lit("line_item").alias("type"))))
            .alias("discount_allocations")).alias("obj"))
    refund_objs = raw_orders.where(F.col("record_type") == "refund").select(
        "order_id", "source_file", F.struct(
            F.col("order_id"), ts.alias("created_at"), F.lit("refund").alias("type"),
            F.col("refund_amount"),
            F.lit(None).cast(order_objs.schema["obj"].dataType["line_items"].dataType)
            .alias("line_items"),
            F.lit(None).cast("double").alias("discount"),
            F.lit(None).cast(order_objs.schema["obj"].dataType["discount_allocations"].dataType)
            .alias("discount_allocations")).alias("obj"))
    # Written once, as their number is needed before they are dealt to pages.
    spark, both = raw_orders.sparkSession, order_objs.unionByName(refund_objs)
    path = scratch_path(spark, "order-objects")
    both.write.parquet(path)
    all_objs = spark.read.schema(both.schema).parquet(path)
    n_pages = _buckets(all_objs, page_size)
    page = F.pmod(F.xxhash64("order_id", "source_file", F.col("obj.type")), F.lit(n_pages))
    # A task writes the pages of its partition one after the other, a file each.
    pages = all_objs.withColumn("page", page).repartition("page").groupBy("page") \
        .agg(F.collect_list("obj").alias("orders"))
    pages.select("orders").write.option("maxRecordsPerFile", 1).mode("overwrite").json(out)
    drop_scratch(spark, path)
    return n_pages


SETTLEMENT_OUT = ("amazon_order_id", "sku", "quantity", "gross_amount", "fee_amount",
                  "net_amount", "currency", "settlement_date")
# Newer layout: renamed columns in a different order (binding must be by name).
NEW_LAYOUT_ORDER = ("settle_date", "order_id", "item_sku", "units", "revenue", "commission",
                    "net_proceeds", "currency")


def write_settlements(raw: DataFrame, out: str, change_date: str) -> None:
    """Settlement rows -> one CSV per settlement date, landed header before
    ``change_date``, renamed header (other column order) from it on."""
    base = raw.select(*SETTLEMENT_OUT).withColumn("batch", F.col("settlement_date").cast("string"))
    before = F.col("settlement_date") < F.lit(change_date).cast("date")
    (base.where(before).repartition("batch")
     .write.partitionBy("batch").option("header", True).mode("overwrite").csv(f"{out}/landed"))
    to_new = {landed: new for new, landed in SETTLEMENT_RENAME.items()}
    renamed = base.where(~before).select(
        *[F.col(c).alias(to_new.get(c, c)) for c in SETTLEMENT_OUT], "batch")
    (renamed.select(*NEW_LAYOUT_ORDER, "batch").repartition("batch")
     .write.partitionBy("batch").option("header", True).mode("overwrite").csv(f"{out}/renamed"))


def write_pos(spark, raw: DataFrame, out: str, cp1252_store: str = "store_11") -> None:
    """POS rows -> one CSV per store and month of transaction; ``cp1252_store``
    files are written in windows-1252 with an extra ``note`` column holding a
    curly apostrophe.  (The live feed is one file per store night; the scan does
    not depend on the file granularity.)"""
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    month = F.concat_ws("_", "store_id", F.date_format("txn_timestamp", "yyyy-MM"))
    base = raw.select("store_id", F.col("txn_timestamp").alias("timestamp"), "sku", "quantity",
                      "amount", "txn_type", month.alias("night_file"))
    opts = {"header": True, "timestampFormat": "yyyy-MM-dd HH:mm:ss"}
    odd = F.col("store_id") == cp1252_store
    (base.where(~odd).repartition("night_file")
     .write.partitionBy("night_file").options(**opts).mode("overwrite").csv(f"{out}/utf8"))
    (base.where(odd).withColumn("note", F.lit("Chef’s pick")).repartition("night_file")
     .write.partitionBy("night_file").options(**opts).option("encoding", "windows-1252")
     .mode("overwrite").csv(f"{out}/cp1252"))


def write_workbooks(raw: DataFrame, out: str, rows_per_book: int = BOOK_ROWS) -> int:
    """Product rows -> ``product_master_NNN.xlsx`` workbooks (title row, header
    on row 2, a hidden second sheet), each built by one task."""
    from tallyhouse.session import ship_package
    ship_package(raw.sparkSession)
    n_books = _buckets(raw, rows_per_book)
    book = F.pmod(F.xxhash64("sku", "unit_cost"), F.lit(n_books)).alias("book")
    # A path without a scheme belongs to the default file system, as for Spark.
    jvm = raw.sparkSession.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(out.rstrip("/"))
    out = str(path.getFileSystem(raw.sparkSession.sparkContext._jsc.hadoopConfiguration())
              .makeQualified(path).toString())

    def build(pdf):
        import pandas as pd
        from pyarrow import fs as pafs

        from tallyhouse.sources import workbook
        b = int(pdf["book"].iloc[0])
        rows = [[r.sku, r.product_name, r.category,
                 None if pd.isna(r.unit_cost) else float(r.unit_cost),
                 None if pd.isna(r.unit_price) else float(r.unit_price)]
                for r in pdf.sort_values(["sku", "unit_cost"]).itertuples()]
        data = workbook.build_workbook(
            "Product master", ["SKU", "Product Name", "Category", "Unit Cost", "Unit Price"],
            rows, hidden=("Discontinued_DO_NOT_USE", ["SKU", "Note"], []))
        uri = out if "://" in out else "file:///" + out.split(":", 1)[-1].lstrip("/")
        fsys, path = pafs.FileSystem.from_uri(uri)
        fsys.create_dir(path, recursive=True)
        with fsys.open_output_stream(f"{path}/product_master_{b:03d}.xlsx") as f:
            f.write(data)
        return pd.DataFrame({"book": [b], "rows": [len(rows)]})

    written = (raw.select(book, "sku", "product_name", "category",
                          F.col("unit_cost").cast("double").alias("unit_cost"),
                          F.col("unit_price").cast("double").alias("unit_price"))
               .groupBy("book").applyInPandas(build, "book long, rows long"))
    written.count()
    return n_books
