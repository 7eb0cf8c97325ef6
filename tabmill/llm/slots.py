"""Sharding by fixed virtual slots and a versioned slot-to-shard map.

A record is hashed into one of ``n_slots`` slots for ever. Bytes are summed by slot, and a small map says which shard
holds which slot. Adding a shard (``grown_map``) or evening out the load (``rebalanced_map``) writes an edited map as the next
version; records are never hashed again, and are placed by the latest version. The map
has ``n_slots`` rows at most, whatever the table holds, so it may be folded in one row and broadcast.

Defined results: a null text has size 16 and the checksum of no bytes; a null id is a value like any other; equal
rows share a slot and get different positions; an empty table gives no rows and an empty map. Only the named columns
of the input are read, so further columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabmill.session import discard, materialize
from tabmill.sources.readers import path_exists

N_SLOTS = 4096
#: Parts in which the rows of one slot are numbered, so that a slot with very many rows is no single task.
PARTS = 64
#: Bytes every record takes beside its text.
RECORD_BYTES = 16
#: Slots that one rebalancing moves at most; each move evens out the fullest and the emptiest shard.
MOST_MOVES = 256
MAP_SCHEMA = "virtual_slot int, shard int, bytes long, version int"


def virtual_slot(n_slots: int, *columns: Column | str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(n_slots)).cast("int")


def records(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_slots: int = N_SLOTS) -> DataFrame:
    """Id, size, checksum and slot of every row; ``part`` only splits the numbering of rows within a slot."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    return docs.select(
        F.col(id_col), (F.octet_length(text) + RECORD_BYTES).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    ).select(
        "*",
        virtual_slot(n_slots, F.col(id_col), "text_crc32", "size").alias("virtual_slot"),
        F.pmod(F.spark_partition_id(), F.lit(PARTS)).alias("part"),
    )


def slot_loads(rows: DataFrame) -> DataFrame:
    return rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("n_rows"))


def first_map(loads: DataFrame, n_shards: int, version: int = 1) -> DataFrame:
    """Largest slots first, each to the shard that holds the fewest bytes so far: (version, virtual_slot, shard, bytes)."""
    ordered = loads.agg(
        F.array_sort(F.collect_list(F.struct((-F.col("bytes")).alias("order"), "virtual_slot", "bytes"))).alias("slots")
    )
    nothing = F.struct(
        F.array_repeat(F.lit(0).cast("long"), n_shards).alias("load"), F.array().cast("array<int>").alias("shards")
    )

    def place(held, slot):
        least = F.array_position(held["load"], F.array_min(held["load"]))
        return F.struct(
            F.transform(held["load"], lambda x, i: F.when(i + 1 == least, x + slot["bytes"]).otherwise(x)).alias("load"),
            F.concat(held["shards"], F.array((least - 1).cast("int"))).alias("shards"),
        )

    placed = ordered.select("slots", F.aggregate("slots", nothing, place)["shards"].alias("shards"))
    return placed.select(F.explode(F.arrays_zip("slots", "shards")).alias("x")).select(
        F.lit(version).alias("version"),
        F.col("x.slots.virtual_slot").alias("virtual_slot"),
        F.col("x.shards").alias("shard"),
        F.col("x.slots.bytes").alias("bytes"),
    )


def grown_map(slot_map: DataFrame, n_shards: int) -> DataFrame:
    """The next version with one shard more: each shard gives up slots beyond the new mean; nothing else moves."""
    within = W.partitionBy("shard").orderBy("bytes", "virtual_slot").rowsBetween(W.unboundedPreceding, 0)
    total = slot_map.agg((F.sum("bytes") / (n_shards + 1)).alias("mean"), F.max("version").alias("latest"))
    spare = F.sum("bytes").over(W.partitionBy("shard")) - F.col("mean")
    return (
        slot_map.join(F.broadcast(total))
        .withColumn("gives", F.sum("bytes").over(within) <= spare)
        .select(
            (F.col("latest") + 1).alias("version"),
            "virtual_slot",
            F.when(F.col("gives"), F.lit(n_shards)).otherwise(F.col("shard")).alias("shard"),
            "bytes",
        )
    )


def rebalanced_map(slot_map: DataFrame, loads: DataFrame, n_shards: int, most_moves: int = MOST_MOVES) -> DataFrame:
    """The next version for the loads as they are now, by moving single slots; the others stay where they are.

    Again and again the fullest shard gives the emptiest one the slot that evens out the two best, until no slot does or
    ``most_moves`` have moved. Slots that the map does not have yet go to the shard their number names first.
    """
    latest = slot_map.agg(F.coalesce(F.max("version"), F.lit(0)).alias("latest"))
    held = slot_map.select("virtual_slot", "shard").join(loads.select("virtual_slot", "bytes"), "virtual_slot", "full")
    known = held.select(
        "virtual_slot", F.coalesce("shard", F.pmod("virtual_slot", F.lit(n_shards))).alias("shard"), F.coalesce("bytes", F.lit(0)).alias("bytes")
    )
    folded = known.agg(F.array_sort(F.collect_list(F.struct("virtual_slot", "shard", "bytes"))).alias("slots"))  # n_slots at most
    by_shard = F.transform(
        F.sequence(F.lit(0), F.lit(n_shards - 1)),
        lambda n: F.aggregate("slots", F.lit(0).cast("long"), lambda sum_, s: sum_ + F.when(s["shard"] == n, s["bytes"]).otherwise(0)),
    )
    start = folded.select("slots", F.struct(F.col("slots.shard").alias("shards"), by_shard.alias("load")).alias("start"))

    def move(state, _):
        load, shards = state["load"], state["shards"]
        full = (F.array_position(load, F.array_max(load)) - 1).cast("int")
        empty = (F.array_position(load, F.array_min(load)) - 1).cast("int")
        gap = F.array_max(load) - F.array_min(load)
        gains = F.transform(F.arrays_zip("slots", shards.alias("now")), lambda z, i: F.when(
            (z["now"] == full) & (z["slots"]["bytes"] > 0) & (z["slots"]["bytes"] < gap),
            F.struct(F.abs(2 * z["slots"]["bytes"] - gap).alias("off"), i.alias("at"), z["slots"]["bytes"].alias("bytes")),
        ))
        best = F.array_min(gains)
        return F.when(best.isNull(), state).otherwise(F.struct(
            F.transform(shards, lambda x, i: F.when(i == best["at"], empty).otherwise(x)).alias("shards"),
            F.transform(load, lambda x, i: x + F.when(i == full, -best["bytes"]).when(i == empty, best["bytes"]).otherwise(0)).alias("load"),
        ))

    moved = start.select("slots", F.aggregate(F.sequence(F.lit(1), F.lit(most_moves)), F.col("start"), move)["shards"].alias("shards"))
    edited = moved.select(F.explode(F.arrays_zip("slots", "shards")).alias("x")).where("x.slots is not null")
    return edited.join(F.broadcast(latest)).select(
        (F.col("latest") + 1).cast("int").alias("version"), F.col("x.slots.virtual_slot").alias("virtual_slot"),
        F.col("x.shards").alias("shard"), F.col("x.slots.bytes").alias("bytes"),
    )


def store_map(slot_map: DataFrame, path: str) -> None:
    """Versions lie side by side; a reader takes the one it was told, or the latest."""
    slot_map.coalesce(1).write.mode("append").partitionBy("version").parquet(path)


def read_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version of the map, the latest if none is named. Versions are numbers: the tenth follows the ninth."""
    stored = spark.read.schema(MAP_SCHEMA).parquet(path)
    if version is None:
        return stored.join(F.broadcast(stored.agg(F.max("version").alias("version"))), "version")
    return stored.where(F.col("version") == version)


def place(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Every row with its shard and its position there, from 0 without gaps.

    Rows are numbered within (slot, part), where the parts of a slot follow each other in its shard, so that no task
    needs the rows of a whole shard. ``rows`` must be stored: the parts depend on how the table was read.
    """
    shards = F.broadcast(slot_map.select("version", "virtual_slot", "shard"))  # n_slots rows at most
    counts = rows.groupBy("virtual_slot", "part").agg(F.count("*").alias("n_rows")).join(shards, "virtual_slot")
    before = W.partitionBy("shard").orderBy("virtual_slot", "part").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(
        "virtual_slot", "part", "shard", "version", F.coalesce(F.sum("n_rows").over(before), F.lit(0)).alias("first")
    )
    keys = [c for c in rows.columns if c not in ("virtual_slot", "part")]
    numbered = rows.withColumn("_at", F.row_number().over(W.partitionBy("virtual_slot", "part").orderBy(*keys)))
    return numbered.join(starts, ["virtual_slot", "part"]).select(
        *keys, "virtual_slot", "shard", "version", (F.col("first") + F.col("_at") - 1).cast("long").alias("slot")
    )


def shard_documents(docs: DataFrame, n_shards: int, map_path: str, n_slots: int = N_SLOTS) -> DataFrame:
    """Documents in shards of nearly equal bytes, placed by the latest version of the map at ``map_path``.

    The first call stores a first map, and every call one that evens out the loads as they are now.
    """
    spark = docs.sparkSession
    rows = materialize(records(docs, n_slots=n_slots), "slot-records")
    loads = materialize(slot_loads(rows), "slot-loads")
    if not path_exists(spark, map_path):
        store_map(first_map(loads, n_shards), map_path)
    # an empty table has no slots and so no next version
    store_map(rebalanced_map(read_map(spark, map_path), loads, n_shards), map_path)
    placed = place(rows, read_map(spark, map_path))
    discard(loads)
    return placed
