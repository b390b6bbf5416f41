"""Sharding over fixed virtual slots (operator 3); DataFrame and SQL functions only.

Records are hashed into thousands of virtual slots, bytes are added up per
slot, and a versioned map says which shard holds which slot.  Version 0 deals
the slots out evenly by number; a rebalancing edits the latest version and moves
only the bytes beyond the target: a shard keeps its largest slots up to the
target size, and the others go, largest first, to the shard with the least
bytes.  A slot is never split, so sizes are equal to within a slot.  The map has a row per slot, so the part that one task or the driver
sees is bounded by the number of slots whatever the input.

Defined results: the size of a null text is 1, its CRC that of the empty text;
a row without doc_id is hashed by its text; repeated rows are all placed, next
to each other; other input columns are ignored; an empty table gives an empty
result and an evenly dealt map.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sifter.session import scratch_path

SLOTS = 4096
SHARDS = 8
_MAP_SCHEMA = "version int, virtual_slot int, shard int, bytes long"


def with_slot(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32 and the virtual slot of every row."""
    hashed = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.col("text"), F.lit("")).cast("binary"))
    return docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        (F.conv(F.substring(hashed, 1, 8), 16, 10).cast("long") % slots).cast("int").alias("virtual_slot"),
    )


def slot_bytes(rows: DataFrame) -> DataFrame:
    """Rows and bytes of each slot in use."""
    return rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))


def initial_map(spark: SparkSession, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """Version 0: slots dealt out by number."""
    return spark.range(slots).select(
        F.lit(0).alias("version"), F.col("id").cast("int").alias("virtual_slot"),
        (F.col("id") % shards).cast("int").alias("shard"), F.lit(0).cast("long").alias("bytes"))


def rebalance(current: DataFrame, used: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The next version of a map: as many slots stay as fit, the rest go to the emptiest shards."""
    sized = (current.select("version", "virtual_slot", "shard")
             .join(used.select("virtual_slot", "bytes"), "virtual_slot", "left")
             .withColumn("bytes", F.coalesce("bytes", F.lit(0)).cast("long")))
    target = sized.agg((F.sum("bytes") / shards).alias("target"))
    in_shard = Window.partitionBy("shard").orderBy(F.desc("bytes"), "virtual_slot").rowsBetween(Window.unboundedPreceding, 0)
    marked = (sized.crossJoin(F.broadcast(target))  # one row
              .withColumn("stays", (F.sum("bytes").over(in_shard) <= F.col("target")) & (F.col("shard") < shards)))
    # one array of at most a row per slot: largest first, each to the shard with the least bytes so far
    gathered = marked.agg(
        F.max("version").alias("version"),
        F.sort_array(F.collect_list(F.when(F.col("stays"), F.struct("virtual_slot", "shard", "bytes")))).alias("kept"),
        F.array_sort(F.collect_list(F.when(~F.col("stays"), F.struct((-F.col("bytes")).alias("less"), "virtual_slot")))).alias("moved"))
    load = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda s: F.aggregate(F.filter("kept", lambda k: k.shard == s), F.lit(0).cast("long"), lambda a, k: a + k.bytes))
    start = F.struct(load.alias("load"), F.array().cast("array<int>").alias("to"))

    def place(state, slot):
        emptiest = (F.array_position(state.load, F.array_min(state.load)) - 1).cast("int")
        return F.struct(
            F.transform(state.load, lambda v, i: F.when(i == emptiest, v - slot.less).otherwise(v)).alias("load"),
            F.concat(state.to, F.array(emptiest)).alias("to"))

    placed = gathered.select("version", "kept", F.transform(
        F.arrays_zip("moved", F.aggregate("moved", start, place).to.alias("to")),
        lambda z: F.struct(z.moved.virtual_slot.alias("virtual_slot"), z.to.alias("shard"), (-z.moved.less).alias("bytes"))).alias("dealt"))
    return (placed.select((F.col("version") + 1).alias("version"), F.explode(F.concat("kept", "dealt")).alias("s"))
            .select("version", "s.virtual_slot", "s.shard", "s.bytes"))


def publish_map(next_map: DataFrame, root: str) -> None:
    """Append a version to the stored map; earlier versions stay readable."""
    next_map.select("version", "virtual_slot", "shard", "bytes").coalesce(1).write.mode("append").parquet(root)


def read_map(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """A version of the stored map, the latest unless named."""
    stored = spark.read.schema(_MAP_SCHEMA).parquet(root)
    if version is None:
        return stored.join(F.broadcast(stored.agg(F.max("version").alias("version"))), "version")
    return stored.filter(F.col("version") == version)


def place_rows(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Shard of every row and its place there, gapless from 0 in each shard.

    Rows are numbered inside their slot; a slot begins behind the rows of the
    slots before it in its shard, so no window holds more than a slot.
    """
    used = slot_bytes(rows).join(F.broadcast(slot_map.select("virtual_slot", "shard")), "virtual_slot")
    in_shard = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = used.select("virtual_slot", "shard", F.coalesce(F.sum("rows").over(in_shard), F.lit(0)).alias("first"))
    in_slot = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    numbered = rows.withColumn("place", F.row_number().over(in_slot) - 1)
    # a row per slot: bounded by the number of slots
    return numbered.join(F.broadcast(starts), "virtual_slot").withColumn("slot", F.col("first") + F.col("place"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, root: str | None = None) -> DataFrame:
    """Place all documents by the law of near-equal bytes; the map is stored below ``root``."""
    spark = docs.sparkSession
    root = root or scratch_path(spark, "slot-map")
    rows = with_slot(docs, slots)
    publish_map(initial_map(spark, shards, slots), root)
    publish_map(rebalance(read_map(spark, root), slot_bytes(rows), shards), root)
    return place_rows(rows, read_map(spark, root)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")
