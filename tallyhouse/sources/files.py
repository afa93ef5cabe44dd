"""File-feed scans (S1..S7) and the file-level source profiles (F-1, F-3, F-5).

A :class:`Feed` says where a source's files are; with ``chosen``, which of them are
wanted (a table of files with their hashes, joined, so no list of paths is held on
the driver) and, with ``since``, from which modification time on (pruned when
files are listed).

* order pages (S1): ``binaryFile`` and ``from_json`` with a superset schema (both
  discount shapes, refund fields), ``explode`` of objects and line items;
* settlement CSV (S2) and POS CSV (S3): Spark's ``text`` source, which splits files
  of any size, in two passes.  The first keeps one row a file: its header, whether
  it is valid UTF-8, whether a quoted field spans lines.  The second cuts each line
  with ``from_csv`` and looks the wanted columns' places up in the file's header
  **by name** -- so files with either header, any width and column order, extra or
  missing columns land in one shape, and a malformed record fails the job.  Only
  files with fields that span lines go through the multi-line ``csv`` source.  A
  byte order mark is no part of a header;
* POS encoding (S3): a file that is not valid UTF-8 is decoded as windows-1252;
* workbooks (S4): unzipped one at a time in ``mapInPandas``, the sheet parsed by
  ``from_xml``, header on row 2 of the first sheet.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.session import scratch_path
from tallyhouse.sources import workbook

# --- listing and hashing (S6, S7) -------------------------------------------

# Where each source lives under a raw/landing folder.
SOURCE_GLOBS = {
    "shopify": ("shopify", "*.json"),
    "amazon": ("amazon", "*.csv"),
    "pos": ("pos", "*.csv"),
    "product": ("", "product_master.xlsx"),
}
# A landing written by Spark has partition folders below each source, and as many
# product workbooks as its rows need (``nested`` below).
NESTED_PRODUCT = "product_master*.xlsx"
SOURCE_ORDER = ("shopify", "amazon", "pos", "product")


@dataclass(frozen=True)
class Feed:
    """S6: the files of one source under ``root``.

    Only files directly in the source's folder count, unless ``nested``.  ``everywhere``
    takes the source's file pattern in any folder (for a stream's landing root, with
    ``chosen``).  With ``paths`` just these files are looked at and no folder is
    listed.  An absent folder has no files (a missing source is sensed and reported by
    the job, not raised by the scan).
    """

    root: str
    source: str
    nested: bool = False
    everywhere: bool = False
    since: str | None = None            # a UTC time, exclusive
    chosen: DataFrame | None = None     # key, file_hash
    paths: tuple[str, ...] | None = None
    offered: DataFrame | None = None    # whole files with their content, not looked for again

    def _load(self, spark: SparkSession, form: str, schema: str, options: dict | None = None) -> DataFrame:
        sub, pattern = SOURCE_GLOBS[self.source]
        pattern = NESTED_PRODUCT if self.nested and not sub else pattern
        base = self.root.rstrip("/") + (f"/{sub}" if sub else "")
        reader = spark.read.format(form).options(**(options or {}))
        if form not in ("binaryFile", "text"):
            reader = reader.schema(schema)
        if self.since is not None:
            reader = reader.option("modifiedAfter", self.since).option("timeZone", "UTC")
        if self.paths is not None:
            reader = reader.option("recursiveFileLookup", "true")
            target = list(self.paths)
        elif self.everywhere or (self.nested and sub):
            reader = reader.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
            target = self.root if self.everywhere else base
        else:
            target = f"{base}/{pattern}"
        found = [F.col("_metadata.file_path").alias("key")]
        try:
            df = reader.load(target)
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
                raise
            df = spark.createDataFrame([], f"{schema}, _metadata struct<file_path: string, file_name: string, "
                                           "file_size: bigint, file_block_start: bigint>")
        # A chosen file is read only as long as it is the one that was hashed.
        rows = df.select("*", *found, F.col("_metadata.file_size").alias("_size"),
                         decoded_name(F.col("_metadata.file_name")).alias("file_name"),
                         F.col("_metadata.file_block_start").alias("_block"),
                         F.monotonically_increasing_id().alias("_at"))     # the order within a file's block
        return rows if self.chosen is None else rows.join(self.chosen.select("key", "file_hash"), "key")

    def files(self, spark: SparkSession) -> DataFrame:
        """path, file_name, length, modificationTime, content, key (and file_hash)."""
        if self.offered is not None:
            return self.offered if self.chosen is None else \
                self.offered.join(self.chosen.select("key", "file_hash"), "key")
        df = self._load(spark, "binaryFile", BINARY_SCHEMA)
        return df.withColumn("file_name", basename(F.col("path"))).drop("_size", "_block", "_at")

    def lines(self, spark: SparkSession) -> DataFrame:
        """The lines as they are (bytes): value, key, file_name, _size, _block, _at (and file_hash)."""
        return self._load(spark, "text", "value string")

    def records(self, spark: SparkSession, schema: str, encoding: str) -> DataFrame:
        """Records by the multi-line CSV source: the schema's columns, key, file_name, ..."""
        return self._load(spark, "csv", schema, {"multiLine": "true", "encoding": encoding, **CSV_OPTIONS})

    def only(self, chosen: DataFrame | None, since: str | None, paths: tuple[str, ...] | None = None) -> Feed:
        return replace(self, chosen=chosen, since=since, paths=paths)


BINARY_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
CSV_OPTIONS = {"mode": "PERMISSIVE", "quote": '"', "escape": '"'}


def decoded_name(name: Column) -> Column:
    """A file name as it is (``_metadata`` has it encoded as a URL)."""
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def read_files(spark: SparkSession, root: str, source: str, nested: bool = False) -> DataFrame:
    """S6: the files of one source as (path, file_name, length, content, ...)."""
    return Feed(root, source, nested).files(spark)


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def _carry(df: DataFrame) -> list[str]:
    """Provenance columns passed through a parse (the loader adds file_hash)."""
    return [c for c in ("file_hash",) if c in df.columns]


def with_hash(files: DataFrame) -> DataFrame:
    """S7: sha256 of each file's bytes, computed where the bytes are."""
    return files.withColumn("file_hash", F.sha2(F.col("content"), 256))


# --- S1: order pages ---------------------------------------------------------

LINE_ITEM = T.StructType([
    T.StructField("sku", T.StringType()),
    T.StructField("quantity", T.LongType()),
    T.StructField("price", T.DecimalType(12, 2)),
])
ORDER_OBJECT = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("refund_amount", T.DecimalType(12, 2)),
    T.StructField("line_items", T.ArrayType(LINE_ITEM)),
    # both discount shapes are tolerated (and profiled) but not landed
    T.StructField("discount", T.DoubleType()),
    T.StructField("discount_allocations", T.ArrayType(T.StructType([
        T.StructField("amount", T.DoubleType()), T.StructField("type", T.StringType())]))),
])
ORDER_PAGE = T.StructType([T.StructField("orders", T.ArrayType(ORDER_OBJECT))])


def order_objects(files: DataFrame) -> DataFrame:
    """Order-page objects as rows (source_file, o), one per object."""
    doc = F.from_json(F.decode(F.col("content"), "UTF-8"), ORDER_PAGE, {"mode": "FAILFAST"})
    return files.select(F.col("file_name").alias("source_file"), *_carry(files),
                        F.explode(doc.getField("orders")).alias("o"))


def parse_orders(files: DataFrame) -> DataFrame:
    """S1: raw order rows from (file_name, content) of order pages.

    A ``type = 'refund'`` object gives one row with NULL sku/quantity/price;
    any other object one row per line item (none -> no rows).  A page without
    ``orders`` gives no rows.  ``<=>`` keeps objects whose type is NULL as orders.
    An object without its order id, or a line item without sku, quantity or price,
    fails the job: a dropped amount would vanish from every later sum.
    """
    is_refund = F.col("o.type").eqNullSafe("refund")
    none = F.lit(None).cast(LINE_ITEM)
    rows = order_objects(files).select(
        "o", "source_file", *_carry(files), is_refund.alias("_refund"),
        F.explode(F.when(is_refund, F.array(none)).otherwise(F.col("o.line_items"))).alias("li"))

    def needed(name: str, missing: Column) -> Column:
        value = F.col(f"li.{name}") if name != "order_id" else F.col("o.order_id")
        return F.when(missing, F.raise_error(F.concat(
            F.lit(f"order page with an entry without '{name}': "), F.col("source_file")))).otherwise(value)

    def of_item(name: str) -> Column:
        return needed(name, ~F.col("_refund") & F.col(f"li.{name}").isNull())

    return rows.select(
        needed("order_id", F.col("o.order_id").isNull()).alias("order_id"),
        F.col("o.created_at").cast("timestamp").alias("created_at"),
        of_item("sku").alias("sku"), of_item("quantity").cast("int").alias("quantity"),
        of_item("price").alias("price"),
        F.when(F.col("_refund"), "refund").otherwise("order").alias("record_type"),
        F.when(F.col("_refund"), F.col("o.refund_amount")).alias("refund_amount"),
        "source_file", *_carry(files))


def discount_shapes(files: DataFrame) -> DataFrame:
    """F-1: order objects (not refunds) per discount shape."""
    objs = order_objects(files).where(~F.col("o.type").eqNullSafe("refund"))
    shape = (F.when(F.col("o.discount_allocations").isNotNull(), F.lit("discount_allocations"))
             .when(F.col("o.discount").isNotNull(), F.lit("discount"))
             .otherwise(F.lit("none")))
    return objs.groupBy(shape.alias("shape")).agg(F.count(F.lit(1)).cast("bigint").alias("orders"))


# --- CSV by header name (S2, S3) ---------------------------------------------

def csv_verdicts(spark: SparkSession, feed: Feed) -> DataFrame:
    """One row a file, written as a table: ``key, file_name, size, raw_header, header,
    utf8, spans, width``.

    ``header`` is the first line that is not blank, decoded; ``spans`` tells whether a
    quoted field has line feeds; ``width`` is the header's number of fields.  A file
    with an open quote fails the job.  Files without any line have no row.
    """
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")    # for windows-1252
    raw = F.col("value")
    quotes = F.octet_length(raw) - F.octet_length(F.replace(raw, F.lit('"'), F.lit("")))
    first = (F.col("_block") == 0) & (F.trim(raw) != "")
    per_file = feed.lines(spark).groupBy("key").agg(
        F.first("file_name").alias("file_name"), F.first("_size").alias("size"),
        F.min_by(raw, F.when(first, F.col("_at"))).alias("raw_header"),
        F.bool_and(F.is_valid_utf8(raw)).alias("utf8"), F.sum(quotes).alias("quotes"),
        F.bool_or(quotes % 2 == 1).alias("spans"))
    header = F.coalesce(decoded(F.col("raw_header"), F.col("utf8")), F.lit(""))
    width = F.regexp_count(F.regexp_replace("header", '"[^"]*"', ""), F.lit(",")) + 1
    checked = F.when(F.col("quotes") % 2 == 1, F.raise_error(F.concat(
        F.lit("CSV file with an open quote: "), F.col("file_name")))).otherwise(header)
    return _scratch(per_file.withColumn("header", checked).withColumn("width", width).drop("quotes"), "csv-headers")


def _scratch(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def decoded(raw: Column, utf8: Column) -> Column:
    """A string's bytes as UTF-8 where the file is valid UTF-8, else as windows-1252."""
    return F.when(utf8, raw).otherwise(F.decode(raw.cast("binary"), "windows-1252"))


def _cells(text: Column, width: int) -> Column:
    """The fields of one record, as an array of ``width``; empty ones are NULL."""
    record = F.from_csv(text, F.lit(_cell_schema(width)), {**CSV_OPTIONS, "maxColumns": str(width + 20_480)})
    return F.array(*[F.nullif(record[f"c{k}"], F.lit("")) for k in range(width)])


def _cell_schema(width: int) -> str:
    return ", ".join(f"c{k} string" for k in range(width))


def csv_records(spark: SparkSession, feed: Feed, names: dict[str, tuple[str, ...]]) -> DataFrame:
    """One row per record of every file: ``source_file`` and a string column for
    each of ``names`` (column -> header names, the first that the file has).

    The first line of each file is its header, whatever its width; blank lines
    are skipped (and a line of the first block that is the header again).  Short
    records end in NULLs.  A record with more fields than the header, or a file with
    an open quote, fails the job.  ``_has_<column>`` says whether the file has the
    column.  The headers are read when this is called.
    """
    verdicts = csv_verdicts(spark, feed)
    most, spanning = verdicts.agg(F.max("width"), F.collect_set(F.when(F.col("spans"), F.col("utf8")))).first()
    width = (most or 0) + 1                     # one more, to see records that are too long
    header = F.transform(_cells(F.col("header"), width), lambda f: F.trim(f))
    at = {c: F.greatest(F.lit(0).cast("bigint"), F.coalesce(*[
        F.nullif(F.array_position("_header", F.lit(h)), F.lit(0)) for h in heads], F.lit(0).cast("bigint")))
        for c, heads in names.items()}
    placed = verdicts.withColumn("_header", header).select(
        "key", "raw_header", "_header", "utf8", "spans", "width", *[p.cast("int").alias(f"_at_{c}") for c, p in at.items()])
    extra = ["file_hash"] if feed.chosen is not None else []
    keep = ["file_name", *extra, "width", *[f"_at_{c}" for c in names]]
    lines = feed.lines(spark).join(placed.where("not spans"), "key").where(
        (F.trim("value") != "") & ~((F.col("_block") == 0) & (F.col("value") == F.col("raw_header"))))
    rows = lines.select(*keep, _cells(decoded(F.col("value"), F.col("utf8")), width).alias("_fields"))
    for utf8 in spanning:
        whole = feed.records(spark, _cell_schema(width), "UTF-8" if utf8 else "windows-1252")
        cells = F.array(*[F.nullif(F.col(f"c{k}"), F.lit("")) for k in range(width)])
        rows = rows.unionByName(
            whole.join(placed.where(F.col("spans") & (F.col("utf8") == F.lit(utf8))), "key")
            .withColumn("_fields", cells).where(F.transform("_fields", lambda f: F.trim(f)) != F.col("_header"))
            .select(*keep, "_fields"))
    too_long = F.exists(F.slice("_fields", F.col("width") + 1, F.lit(width)), lambda f: f.isNotNull())
    fields = F.when(too_long, F.raise_error(F.concat(
        F.lit("CSV record with more fields than its header: "), F.col("file_name")))).otherwise(F.col("_fields"))
    return rows.withColumn("_fields", fields).select(
        F.col("file_name").alias("source_file"), *extra, *[(F.col(f"_at_{c}") > 0).alias(f"_has_{c}") for c in names],
        *[F.when(F.col(f"_at_{c}") > 0, F.get("_fields", F.col(f"_at_{c}") - 1)).alias(c) for c in names])


def required(name: str, source: str) -> Column:
    """A column of :func:`csv_records`; a file lacking it fails the job."""
    return F.when(F.col(f"_has_{name}"), F.col(name)).otherwise(F.raise_error(
        F.concat(F.lit(f"{source} file without column '{name}': "), F.col("source_file"))))


# The settlement file header rename (newer layout -> landed names).
SETTLEMENT_RENAME = {
    "order_id": "amazon_order_id",
    "item_sku": "sku",
    "units": "quantity",
    "revenue": "gross_amount",
    "commission": "fee_amount",
    "net_proceeds": "net_amount",
    "settle_date": "settlement_date",
}
SETTLEMENT_COLUMNS = ("amazon_order_id", "sku", "quantity", "gross_amount", "fee_amount",
                      "net_amount", "currency", "settlement_date")


def parse_settlements(spark: SparkSession, feed: Feed) -> DataFrame:
    """S2: settlement rows from CSV files in either header layout, bound by name.

    Every landed column is read under its own name or, in the newer layout, under
    the one in :data:`SETTLEMENT_RENAME`.  Columns a file lacks land as NULL (a
    missing currency becomes USD in staging), but a file without order ids fails.
    """
    newer = {v: k for k, v in SETTLEMENT_RENAME.items()}
    names = {c: (c, *([newer[c]] if c in newer else [])) for c in SETTLEMENT_COLUMNS}
    typed = csv_records(spark, feed, names)
    return typed.select(
        required("amazon_order_id", "settlement").alias("amazon_order_id"), "sku",
        F.col("quantity").cast("int").alias("quantity"),
        *[F.col(c).cast("decimal(12,2)").alias(c)
          for c in ("gross_amount", "fee_amount", "net_amount")],
        "currency", F.col("settlement_date").cast("date").alias("settlement_date"),
        "source_file", *_carry(typed))


def settlement_layouts(spark: SparkSession, feed: Feed) -> DataFrame:
    """F-3: settlement files per header layout (landed / renamed / unknown)."""
    names = F.transform(F.split(F.coalesce("header", F.lit("")), ","), lambda f: F.trim(F.replace(f, F.lit('"'), F.lit(""))))
    layout = F.when(F.array_contains(names, "amazon_order_id"), F.lit("landed")) \
        .when(F.array_contains(names, "order_id") & F.array_contains(names, "item_sku"),
              F.lit("renamed")).otherwise(F.lit("unknown"))
    files = feed.files(spark).select("key").join(csv_verdicts(spark, feed).select("key", "header"), "key", "left")
    return files.groupBy(layout.alias("layout")).agg(F.count(F.lit(1)).cast("bigint").alias("files"))


def non_utf8_files(spark: SparkSession, feed: Feed) -> DataFrame:
    """F-5: files whose bytes are not valid UTF-8."""
    return csv_verdicts(spark, feed).where("not utf8").select("file_name", F.col("size").alias("length"))


POS_COLUMNS = ("store_id", "txn_timestamp", "sku", "quantity", "amount", "txn_type")


def parse_pos(spark: SparkSession, feed: Feed) -> DataFrame:
    """S3: POS rows; ``timestamp`` lands as ``txn_timestamp``; extra columns
    (such as ``note``) are ignored; negatives and txn_type are kept."""
    names = {c: ("timestamp" if c == "txn_timestamp" else c,) for c in POS_COLUMNS}
    rec = csv_records(spark, feed, names)
    col = {c: required(c, "POS") for c in POS_COLUMNS}
    return rec.select(
        col["store_id"].alias("store_id"), col["txn_timestamp"].cast("timestamp").alias("txn_timestamp"),
        col["sku"].alias("sku"), col["quantity"].cast("int").alias("quantity"),
        col["amount"].cast("decimal(12,2)").alias("amount"), col["txn_type"].alias("txn_type"),
        "source_file", *_carry(rec))


# --- S4: product workbooks ---------------------------------------------------

# Workbook header -> landed column.
PRODUCT_HEADERS = {"SKU": "sku", "Product Name": "product_name", "Category": "category",
                   "Unit Cost": "unit_cost", "Unit Price": "unit_price"}
_RICH_TEXT = "t: string, r: array<struct<t: string>>"
_SHEET = ("sheetData struct<row: array<struct<_r: int, c: array<struct<"
          f"_r: string, _t: string, v: string, `is`: struct<{_RICH_TEXT}>>>>>>")
_STRINGS = f"si array<struct<{_RICH_TEXT}>>"


def _rich(s: Column) -> Column:
    """The text of a string item: plain, or of its runs."""
    return F.coalesce(s["t"], F.array_join(F.transform(s["r"], lambda r: F.coalesce(r["t"], F.lit(""))), ""))


def parse_products(files: DataFrame, header_row: int = 2, sheet: int = 0) -> DataFrame:
    """S4: product master rows from workbooks.

    Python unzips one workbook at a time; the sheet's and the shared strings' XML are
    parsed by Spark.  Header on ``header_row`` (the first row holds a merged title),
    first sheet in workbook order (hidden sheets after it are not read).  Rows
    without any value are skipped; columns are bound by header name.
    """
    from tallyhouse.session import ship_package
    ship_package(files.sparkSession)
    extra = _carry(files)
    keep = ["file_name", *extra]

    def unzip(batches):
        import pandas as pd
        for pdf in batches:
            for i in range(len(pdf)):
                xml, strings = workbook.sheet_parts(bytes(pdf["content"].iloc[i]), sheet)
                yield pd.DataFrame([[*(pdf[c].iloc[i] for c in keep), xml, strings]],
                                   columns=[*keep, "xml", "strings"])

    schema = "".join(f"{c} string, " for c in keep) + "xml string, strings string"
    options = {"mode": "FAILFAST", "ignoreSurroundingSpaces": "false"}
    books = files.select("content", *keep).mapInPandas(unzip, schema).select(
        F.col("file_name").alias("source_file"), *extra,
        F.from_xml("xml", _SHEET, options)["sheetData"]["row"].alias("rows"),
        F.from_xml("strings", _STRINGS, options)["si"].alias("strings"))

    def value(c: Column) -> Column:
        text = F.when(c["_t"] == "s", _rich(F.get(F.col("strings"), c["v"].cast("int")))) \
            .when(c["_t"] == "inlineStr", _rich(c["is"])).otherwise(c["v"])
        return F.nullif(text, F.lit(""))

    def letters(c: Column) -> Column:
        return F.regexp_extract(c["_r"], "^[A-Z]+", 0)

    def cell(row: Column, letter: Column) -> Column:
        return value(F.get(F.filter(row["c"], lambda c: letters(c) == letter), F.lit(0)))

    head = F.get(F.filter("rows", lambda r: r["_r"] == header_row), F.lit(0))["c"]
    placed = books.withColumn("head", head).select(
        "source_file", *extra, "strings",
        *[letters(F.get(F.filter("head", _named(value, header)), F.lit(0))).alias(f"at_{name}")
          for header, name in PRODUCT_HEADERS.items()],
        F.explode(F.filter("rows", lambda r: (r["_r"] > header_row)
                           & F.exists(r["c"], lambda c: value(c).isNotNull()))).alias("row"))
    cells = placed.select("source_file", *extra, *[cell(F.col("row"), F.col(f"at_{n}")).alias(n)
                                                   for n in PRODUCT_HEADERS.values()])
    whole = F.regexp_replace("sku", r"^(-?[0-9]+)\.0+$", "$1")     # a number in a text column
    return cells.select(whole.alias("sku"), "product_name", "category",
                        *[F.col(c).cast("double").cast("decimal(12,2)").alias(c) for c in ("unit_cost", "unit_price")],
                        "source_file", *extra)


def _named(value, header: str):
    return lambda c: F.trim(value(c)) == header


# --- S5: bank control seed ---------------------------------------------------

def read_bank_seed(spark: SparkSession, path: str) -> DataFrame:
    """S5: the per-channel bank control CSV (channel, bank_net_revenue)."""
    return (spark.read.schema("channel string, bank_net_revenue decimal(38,2)")
            .option("header", True).option("mode", "FAILFAST").csv(path))


PARSERS = {
    "shopify": lambda spark, feed: parse_orders(feed.files(spark)),
    "amazon": parse_settlements,
    "pos": parse_pos,
    "product": lambda spark, feed: parse_products(feed.files(spark)),
}


def scan(spark: SparkSession, root: str, source: str, nested: bool = False) -> DataFrame:
    """Read and parse every file of one source under ``root`` (no manifest)."""
    return PARSERS[source](spark, Feed(root, source, nested))
