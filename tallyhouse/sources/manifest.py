"""Exactly-once landing of file feeds (S8, K-1..K-4, K-9).

Storage layout under a warehouse folder (any Hadoop-compatible path)::

    raw/<table>/batch_id=<id>/part-*.parquet     landed rows + file_hash
    raw/file_manifest/batch_id=<id>/part-*.parquet
    raw/file_stats/part-*.parquet                path, length, time -> hash

Commit protocol (no transactional table format needed):

1. list the source's files; those whose path, length and modification time have a
   known hash are not opened (unless ``verify``), the others are hashed;
2. keep the first file per hash (sorted path) and drop hashes the manifest
   already records as ``loaded`` (a ``left_anti`` join) -- this is S8;
3. open those files, parse them and append their rows under a fresh ``batch_id``.
   Which files these are stays a table that the scans join; the driver names them to
   the reader only where they are few (``NAMED_FILES``), instead of listing folders;
4. append one manifest row per loaded file, zero-row files included.  **This
   append is the commit point.**

Readers see only the partitions of batches that the manifest has, so rows
written by a batch that died before step 4 are invisible and the file is simply
loaded again by the next run.

Loaders may overlap.  If two commit the same content, the manifest has two rows of
one hash; readers take the earlier one (by load time, then batch) and leave out the
rows of the other, so every content counts once, whichever loader ends first.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.session import scratch_path
from tallyhouse.sources import files as fs
from tallyhouse.sources.tables import RawTables

# Landed table per source.
RAW_TABLES = {
    "shopify": "shopify_orders",
    "amazon": "amazon_settlements",
    "pos": "pos_transactions",
    "product": "product_master",
}
MANIFEST_SCHEMA = ("file_hash string, source_system string, file_path string, rows_loaded bigint, "
                   "loaded_at timestamp, status string, batch_id string")
RAW_SCHEMAS = {
    "shopify_orders": "order_id string, created_at timestamp, sku string, quantity int, "
                      "price decimal(12,2), record_type string, refund_amount decimal(12,2), "
                      "source_file string",
    "amazon_settlements": "amazon_order_id string, sku string, quantity int, "
                          "gross_amount decimal(12,2), fee_amount decimal(12,2), "
                          "net_amount decimal(12,2), currency string, settlement_date date, "
                          "source_file string",
    "pos_transactions": "store_id string, txn_timestamp timestamp, sku string, quantity int, "
                        "amount decimal(12,2), txn_type string, source_file string",
    "product_master": "sku string, product_name string, category string, "
                      "unit_cost decimal(12,2), unit_price decimal(12,2), source_file string",
}
PROVENANCE = "file_hash string, loaded_at timestamp, batch_id string"
STATS_SCHEMA = "key string, length bigint, modified timestamp, file_hash string, hashed_at timestamp"


class CrashForTest(RuntimeError):
    """Raised by ``load_source(..., crash_before_commit=True)``."""


@dataclass(frozen=True)
class Warehouse:
    root: str

    def raw(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/raw/{table}"

    @property
    def manifest(self) -> str:
        return self.raw("file_manifest")

    def mart(self, name: str, build_id: str) -> str:
        return f"{self.root.rstrip('/')}/marts/build_id={build_id}/{name}"

    @property
    def file_stats(self) -> str:
        return self.raw("file_stats")

    @property
    def build_log(self) -> str:
        return f"{self.root.rstrip('/')}/marts/_builds"

    def parts(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/parts/{table}"

    @property
    def part_log(self) -> str:
        return self.parts("_refreshes")

    @property
    def publish_log(self) -> str:
        return f"{self.root.rstrip('/')}/ops/publish_log"


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs_ = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs_.exists(p)


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_dead_batches(spark: SparkSession, wh: Warehouse) -> int:
    """Delete raw folders of batches that never committed; returns their number.
    Only for a warehouse that no load is writing to."""
    live, gone = set(committed_batches(spark, wh)), 0
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for table in RAW_SCHEMAS:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(wh.raw(table))
        store = path.getFileSystem(conf)
        for status in store.listStatus(path):
            name = status.getPath().getName()
            if name.startswith("batch_id=") and name.removeprefix("batch_id=") not in live:
                store.delete(status.getPath(), True)
                gone += 1
    return gone


def _empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def init_schema(spark: SparkSession, wh: Warehouse) -> None:
    """K-4: create every raw table and the manifest if absent (idempotent)."""
    for table, schema in RAW_SCHEMAS.items():
        if not _exists(spark, wh.raw(table)):
            _empty(spark, f"{schema}, {PROVENANCE}").write.mode("append") \
                .partitionBy("batch_id").parquet(wh.raw(table))
    if not _exists(spark, wh.manifest):
        _empty(spark, MANIFEST_SCHEMA).write.mode("append").partitionBy("batch_id") \
            .parquet(wh.manifest)
    if not _exists(spark, wh.file_stats):
        _empty(spark, STATS_SCHEMA).write.mode("append").parquet(wh.file_stats)


def reset_schema(spark: SparkSession, wh: Warehouse) -> None:
    """K-4: replace every raw table and the manifest with empty ones."""
    for table, schema in RAW_SCHEMAS.items():
        _empty(spark, f"{schema}, {PROVENANCE}").write.mode("overwrite") \
            .option("partitionOverwriteMode", "static") \
            .partitionBy("batch_id").parquet(wh.raw(table))
    _empty(spark, MANIFEST_SCHEMA).write.mode("overwrite") \
        .option("partitionOverwriteMode", "static").partitionBy("batch_id") \
        .parquet(wh.manifest)


def read_manifest(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """The manifest as it was written, overlapping loads included."""
    return spark.read.schema(MANIFEST_SCHEMA).parquet(wh.manifest)


def _ranked(spark: SparkSession, wh: Warehouse) -> DataFrame:
    first = Window.partitionBy("file_hash").orderBy("loaded_at", "batch_id")
    return read_manifest(spark, wh).where(F.col("status") == "loaded").withColumn("_rank", F.row_number().over(first))


def loaded_files(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """K-1: one manifest row for each loaded content: of the batches that loaded it,
    the earliest."""
    return _ranked(spark, wh).where("_rank = 1").drop("_rank")


def overlaps(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """``file_hash, batch_id`` of contents that an earlier batch has loaded, too."""
    return _ranked(spark, wh).where("_rank > 1").select("file_hash", "batch_id")


def committed_batches(spark: SparkSession, wh: Warehouse) -> list[str]:
    """The batches that a manifest row commits: one a load, so a short list."""
    return sorted(r.batch_id for r in read_manifest(spark, wh).where(F.col("status") == "loaded")
                  .select("batch_id").distinct().collect())


def read_raw(spark: SparkSession, wh: Warehouse, table: str,
             supersede_by_path: bool = False) -> DataFrame:
    """Committed rows of one raw table (rows of uncommitted batches are invisible).

    The batch is the commit unit and the partition column, so committed rows are
    found by pruning partitions, without a join; only where loads have overlapped
    are the later batch's rows of the shared files joined away.  By default every
    committed version of a file counts (a corrected file re-sent under the same name
    is appended, quirk Q-2).  With ``supersede_by_path`` only the newest committed
    version of each path is read, so a corrected file replaces the rows of the one
    it corrects.
    """
    rows = spark.read.schema(f"{RAW_SCHEMAS[table]}, {PROVENANCE}").parquet(wh.raw(table)) \
        .where(F.col("batch_id").isin(committed_batches(spark, wh)))
    if not supersede_by_path:
        twice = overlaps(spark, wh)
        return rows if twice.isEmpty() else rows.join(twice, ["file_hash", "batch_id"], "left_anti")
    # one manifest row per file version: the window is over the manifest,
    # never over data rows
    newest = Window.partitionBy("file_path").orderBy(F.col("loaded_at").desc(), F.col("batch_id").desc())
    latest = loaded_files(spark, wh).withColumn("_v", F.row_number().over(newest)).where("_v = 1")
    return rows.join(latest.select("file_hash", "batch_id"), ["file_hash", "batch_id"], "left_semi")


def raw_tables(spark: SparkSession, wh: Warehouse, bank_deposits: DataFrame | None = None,
               truth_lines: DataFrame | None = None,
               supersede_by_path: bool = False) -> RawTables:
    cols = {t: [c.split()[0] for c in RAW_SCHEMAS[t].split(", ")] for t in RAW_SCHEMAS}
    r = {t: read_raw(spark, wh, t, supersede_by_path).select(*cols[t]) for t in RAW_SCHEMAS}
    return RawTables(shopify_orders=r["shopify_orders"],
                     amazon_settlements=r["amazon_settlements"],
                     pos_transactions=r["pos_transactions"],
                     product_master=r["product_master"],
                     bank_deposits=bank_deposits, truth_lines=truth_lines)


def load_source(spark: SparkSession, wh: Warehouse, raw_dir: str, source: str,
                crash_before_commit: bool = False, nested: bool = False, **options) -> dict:
    """K-2: land every not-yet-loaded file of one source; returns the counts."""
    return load_files(spark, wh, fs.Feed(raw_dir, source, nested), crash_before_commit=crash_before_commit, **options)


STAT = ["key", "length", "modified"]


# As many files are named to the reader; more are found by listing.
NAMED_FILES = 1000


def _few(files: DataFrame) -> tuple[str, ...] | None:
    """The paths of some files if they are few, so that no folder need be listed for
    them; None for many, or where one would be read as a pattern."""
    paths = tuple(r.path for r in files.select("path").limit(NAMED_FILES + 1).collect())
    return paths if len(paths) <= NAMED_FILES and not any(set(p) & set("{}[]*?\\") for p in paths) else None


def _before(modified: Column) -> Column:
    """Just before a modification time, for ``Feed.since``."""
    return F.date_format(modified - F.expr("interval 1 second"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def _earliest(files: DataFrame) -> str | None:
    """Just before the earliest modification time of some files."""
    return files.agg(_before(F.min("modified"))).first()[0]


def _hashes(spark: SparkSession, wh: Warehouse, feed: fs.Feed, offered: DataFrame | None, verify: bool) -> DataFrame:
    """S6, S7: ``key, path, length, modified, file_hash`` of every file.

    Only files without a known hash for their path, length and time are opened.
    """
    def known() -> DataFrame:
        return spark.read.schema(STATS_SCHEMA).parquet(wh.file_stats).groupBy(*STAT).agg(
            F.max_by("file_hash", "hashed_at").alias("file_hash"))

    listed = feed.files(spark) if offered is None else offered
    stat = [F.col("key"), F.col("path"), F.col("length"), F.col("modificationTime").alias("modified")]
    seen = _written(listed.select(*stat), "listed-files")
    fresh = seen if verify else seen.join(known(), STAT, "left_anti")
    since = _earliest(fresh)
    if since is not None:
        opened = feed.only(None, since).files(spark) if offered is None else offered
        fs.with_hash(opened.select(*stat, "content")).drop("content").join(fresh.select(*STAT), STAT, "left_semi") \
            .select(*STAT, "file_hash", F.current_timestamp().alias("hashed_at")) \
            .write.mode("append").parquet(wh.file_stats)
    return seen.join(known(), STAT)


def load_files(spark: SparkSession, wh: Warehouse, feed: fs.Feed, offered: DataFrame | None = None,
               crash_before_commit: bool = False, verify: bool = False,
               before_commit: Callable[[], object] | None = None) -> dict:
    """Land the not-yet-loaded files of a feed, or of those ``offered`` (path, content,
    key, ..., such as a stream's batch of them).

    ``verify`` hashes all files again, also those whose path, length and time are
    known.  File contents are neither cached nor shuffled with few new files; the
    driver sees counts alone.  ``before_commit`` is called when the rows are written.
    """
    init_schema(spark, wh)
    source = feed.source
    table = RAW_TABLES[source]
    batch = uuid.uuid4().hex
    hashed = _hashes(spark, wh, feed, offered, verify)
    loaded = read_manifest(spark, wh).where(F.col("status") == "loaded").select("file_hash", F.lit(True).alias("had"))
    found = _written(hashed.groupBy("file_hash").agg(F.min(F.struct("path", *STAT)).alias("f"), F.count(F.lit(1)).alias("n"))
                     .join(loaded.distinct(), "file_hash", "left").select("file_hash", "f.*", "n", "had"), "new-files")
    new = F.col("had").isNull()
    seen, since = found.agg(F.coalesce(F.sum("n"), F.lit(0)), _before(F.min(F.when(new, F.col("modified"))))).first()
    firsts = found.where(new).drop("n", "had")
    if since is None:                          # nothing new: a rerun stops here
        return {"source": source, "files_seen": int(seen), "loaded_files": 0,
                "skipped_files": int(seen), "loaded_rows": 0}
    named = _few(firsts)
    chosen = replace(feed.only(firsts.select("key", "file_hash"), since, named), offered=offered)
    rows = fs.PARSERS[source](spark, chosen)
    (rows.withColumn("loaded_at", F.current_timestamp())
     .withColumn("batch_id", F.lit(batch))
     .write.mode("append").option("compression", "zstd").partitionBy("batch_id").parquet(wh.raw(table)))
    if crash_before_commit:
        raise CrashForTest(f"simulated crash after writing batch {batch}")
    still = feed.only(None, since, named).files(spark).select("key", "length", F.col("modificationTime").alias("modified"))
    if not firsts.join(still, STAT, "left_anti").isEmpty():
        raise RuntimeError(f"a file changed while batch {batch} was being loaded; load again")
    if before_commit:
        before_commit()
    folder = f"{wh.raw(table)}/batch_id={batch}"               # no other batch is listed
    written = spark.read.schema(f"{RAW_SCHEMAS[table]}, file_hash string").parquet(folder) \
        if _exists(spark, folder) else _empty(spark, "file_hash string")
    counts = written.groupBy("file_hash").agg(F.count(F.lit(1)).alias("n"))
    manifest_rows = (firsts.join(counts, "file_hash", "left")
                     .select("file_hash", F.lit(source).alias("source_system"),
                             F.col("path").alias("file_path"),
                             F.coalesce("n", F.lit(0)).cast("bigint").alias("rows_loaded"),
                             F.current_timestamp().alias("loaded_at"),
                             F.lit("loaded").alias("status"),
                             F.lit(batch).alias("batch_id")))
    # commit point
    manifest_rows.write.mode("append").partitionBy("batch_id").parquet(wh.manifest)
    committed = loaded_files(spark, wh).where(F.col("batch_id") == batch)
    loaded_files_, loaded_rows = committed.agg(
        F.count(F.lit(1)), F.coalesce(F.sum("rows_loaded"), F.lit(0))).first()
    return {"source": source, "files_seen": int(seen), "loaded_files": int(loaded_files_),
            "skipped_files": int(seen - loaded_files_), "loaded_rows": int(loaded_rows)}


def ingest(spark: SparkSession, wh: Warehouse, raw_dir: str, source: str = "all",
           reset: bool = False, nested: bool = False, verify: bool = False) -> dict:
    """K-3: load all sources (or one), optionally after a reset; ``verify`` as in
    :func:`load_files`."""
    init_schema(spark, wh)
    if reset:
        reset_schema(spark, wh)
    sources = list(RAW_TABLES) if source == "all" else [source]
    return {s: load_source(spark, wh, raw_dir, s, nested=nested, verify=verify) for s in sources}


def manifest_coverage(spark: SparkSession, wh: Warehouse, raw_dir: str, source: str,
                      nested: bool = False) -> DataFrame:
    """C-16: files on disk whose content hash is not in the manifest (none after a load)."""
    files = fs.with_hash(fs.read_files(spark, raw_dir, source, nested)).select("path", "file_hash")
    return files.join(read_manifest(spark, wh).select("file_hash"), "file_hash", "left_anti")
