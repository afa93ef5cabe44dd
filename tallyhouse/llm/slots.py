"""Sharding by fixed virtual slots.

Records are hashed into a fixed number of slots (thousands) by their doc_id; the
bytes of each slot are summed, and a versioned map says which shard holds each
slot.  A new version is the old map with few slots edited, so rebalancing and
growing move no other record.  Where many rows share an id, or have none, their
slot is crowded; its rows are dealt to all slots, each by a hash of the whole
record.  Everything runs as DataFrame and SQL functions; what is handled in one
row is the slot table alone, whose size is fixed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import written
from tallyhouse.session import scratch_path

SLOTS = 4096
SHARDS = 24
# A slot is crowded with more rows than this many times the mean, and this many more:
# far beyond what distinct ids give.
CROWD_TIMES, CROWD_MORE = 8, 64


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The virtual slot of a key; null keys share one slot."""
    return F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")


def records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``doc_id, size, text_crc32, virtual_slot, copy`` of every row: size is the text's
    UTF-8 bytes (null: none) plus 8 for the id; ``copy`` tells equal rows apart once
    the records are written."""
    doc_id, text = F.col("doc_id").cast("long"), F.coalesce("text", F.lit(""))
    return docs.select(doc_id.alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"),
                       F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
                       slot_of(doc_id, slots).alias("virtual_slot"), F.monotonically_increasing_id().alias("copy"))


def spread(rows: DataFrame, slots_used: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``rows`` (written records), those of crowded slots dealt to all slots."""
    mean = F.sum("n").over(Window.partitionBy()) / slots
    crowded = slots_used.withColumn("limit", CROWD_TIMES * mean + CROWD_MORE).where("n > limit") \
        .select("virtual_slot", F.lit(True).alias("crowded"))
    dealt = F.pmod(F.xxhash64("doc_id", "text_crc32", "size", "copy"), F.lit(slots)).cast("int")
    return rows.join(F.broadcast(crowded), "virtual_slot", "left").select(
        "doc_id", "size", "text_crc32", F.when(F.col("crowded"), dealt).otherwise(F.col("virtual_slot")).alias("virtual_slot"))


def slot_table(rows: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``virtual_slot, bytes, n`` for each slot that has records."""
    return rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))


def _fold(ordered: Column, loads: Column) -> Column:
    """Give each (bytes, slot) in turn to the shard with the least load so far."""
    start = F.struct(loads.alias("loads"), F.array().cast("array<struct<slot:int,shard:int>>").alias("given"))

    def give(acc: Column, x: Column) -> Column:
        at = F.array_position(acc["loads"], F.array_min(acc["loads"])).cast("int")
        return F.transform(F.array(at), lambda a: F.struct(
            F.transform(acc["loads"], lambda y, i: y + F.when(i + 1 == a, x["bytes"]).otherwise(F.lit(0).cast("long")))
            .alias("loads"),
            F.concat(acc["given"], F.array(F.struct(x["slot"].cast("int").alias("slot"), (a - 1).alias("shard"))))
            .alias("given")))[0]

    return F.aggregate(ordered, start, give, lambda acc: acc["given"])


def first_map(slots_used: DataFrame, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """Version 1: slots by falling bytes, each to the lightest shard so far; empty
    slots follow, dealt in turn.  ``version, virtual_slot, shard``."""
    spark = slots_used.sparkSession
    one = slots_used.agg(F.sort_array(F.collect_list(F.struct(
        F.col("bytes"), (-F.col("virtual_slot")).alias("slot"))), asc=False).alias("s"))
    used = F.transform("s", lambda x: F.struct(x["bytes"].alias("bytes"), (-x["slot"]).alias("slot")))
    given = one.select(F.explode(_fold(used, F.array_repeat(F.lit(0).cast("long"), shards))).alias("g")) \
        .select(F.col("g.slot").alias("virtual_slot"), F.col("g.shard").alias("shard"))
    every = spark.range(slots).select(F.col("id").cast("int").alias("virtual_slot"))
    return every.join(F.broadcast(given), "virtual_slot", "left").select(
        F.lit(1).alias("version"), "virtual_slot",
        F.coalesce("shard", F.col("virtual_slot") % shards).cast("int").alias("shard"))


def grow(current: DataFrame, slots_used: DataFrame) -> DataFrame:
    """The next version with one more shard: every old shard gives slots, lightest
    first, while what it gave stays within its excess over the new mean.  No slot
    moves between old shards."""
    last = current.withColumn("latest", F.max("version").over(Window.partitionBy())).where("version = latest")
    sized = last.select("version", "virtual_slot", "shard").join(F.broadcast(slots_used), "virtual_slot", "left") \
        .fillna(0, ["bytes", "n"])
    whole = Window.partitionBy()
    sized = sized.withColumn("fresh", F.max("shard").over(whole) + 1) \
        .withColumn("mean", F.sum("bytes").over(whole) / (F.col("fresh") + 1)) \
        .withColumn("excess", F.sum("bytes").over(Window.partitionBy("shard")) - F.col("mean")) \
        .withColumn("given", F.sum("bytes").over(Window.partitionBy("shard").orderBy("bytes", "virtual_slot")
                                                .rowsBetween(Window.unboundedPreceding, 0)))
    moves = (F.col("bytes") > 0) & (F.col("given") <= F.col("excess"))
    return sized.select((F.col("version") + 1).alias("version"), "virtual_slot",
                        F.when(moves, F.col("fresh")).otherwise(F.col("shard")).cast("int").alias("shard"))


class MapStore:
    """The versions of a slot map as Parquet folders, one a version."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def save(self, slot_map: DataFrame, version: int) -> DataFrame:
        slot_map.repartition(1).write.parquet(f"{self.folder}/version={version}")
        return self.load(version)

    def load(self, version: int) -> DataFrame:
        schema = "version int, virtual_slot int, shard int"
        return self.spark.read.schema(schema).parquet(f"{self.folder}/version={version}")


def place(rows: DataFrame, slots_used: DataFrame, slot_map: DataFrame) -> DataFrame:
    """``rows`` with their shard and ``slot``, the record's place in its shard.

    Places count from 0 without gaps: the records of the shard's earlier virtual
    slots, then the record's number within its own, by doc_id, checksum and size.
    So no task numbers a whole shard.
    """
    starts = slots_used.join(F.broadcast(slot_map.select("virtual_slot", "shard")), "virtual_slot").select(
        "virtual_slot", "shard", F.coalesce(F.sum("n").over(
            Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0)).cast("long").alias("before"))
    inner = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    return rows.withColumn("rank", F.row_number().over(inner)).join(F.broadcast(starts), "virtual_slot") \
        .withColumn("slot", (F.col("before") + F.col("rank") - 1).cast("long")) \
        .select("doc_id", "size", "text_crc32", "virtual_slot", "shard", "slot")


def assign_shards(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """Every row of ``docs`` with its shard and place, and ``next_shard``, its shard in
    the map's second version, which has one shard more; byte sums are near equal.

    Rows of one doc_id share a slot unless it is crowded (as that of rows without an id
    often is): then each row, equal ones too, has a slot of its own draw.  Null texts
    count as empty; very long texts as one record, so a text longer than a shard's
    share makes its shard larger; other columns are ignored; an empty table gives none.
    """
    spark = docs.sparkSession
    rows = written(records(docs, slots), "shard-records")
    rows = spread(rows, written(slot_table(rows, slots).repartition(1), "slot-rows"), slots)
    used = written(slot_table(rows, slots).repartition(1), "slot-bytes")
    store = MapStore(spark, scratch_path(spark, "slot-map"))
    first = store.save(first_map(used, shards, slots), 1)
    second = store.save(grow(first, used), 2).select("virtual_slot", F.col("shard").alias("next_shard"))
    return place(rows, used, first).join(F.broadcast(second), "virtual_slot")


def digests(placed: DataFrame) -> DataFrame:
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "next_shard")
