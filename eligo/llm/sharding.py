"""Sharding through fixed virtual slots.

Each record is hashed into one of a fixed number of virtual slots (4,096 by default). Only the slots are
placed: a versioned map says which shard holds each slot. Version 0 deals the slots out evenly; the bytes
per slot then say which slots to move, and the edited map is stored as the next version, so that a
rebalancing moves whole slots and never re-hashes a record. All steps are DataFrame functions.

Defined cases: a null text has no bytes (size 1, checksum 0); a null ``doc_id`` hashes like any value;
equal records (same id, same text) share a slot; equal texts under different ids spread over the slots; an
empty table gives no rows, and the map then stays at its even deal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from eligo.llm.common import work_path

SLOTS = 4096
SHARDS = 8


def record_size(text: str = "text") -> Column:
    return (F.coalesce(F.octet_length(F.col(text).cast("string")), F.lit(0)) + 1).cast("long")


def record_crc(text: str = "text") -> Column:
    return F.crc32(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary"))


def virtual_slot(slots: int = SLOTS, key: str = "doc_id", text: str = "text") -> Column:
    return F.pmod(F.xxhash64(F.col(key), record_crc(text), record_size(text)), F.lit(slots)).cast("int")


def even_map(spark: SparkSession, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """Version 0: the slots dealt out in turn, whatever the data."""
    return spark.range(slots).select(F.lit(0).alias("version"), F.col("id").cast("int").alias("vslot"),
                                     (F.col("id") % shards).cast("int").alias("shard"))


def slot_bytes(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Bytes and records per virtual slot: at most ``slots`` rows, summed before the exchange."""
    return (docs.select(virtual_slot(slots).alias("vslot"), record_size().alias("size"))
            .groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("records")))


def rebalance(slot_map: DataFrame, weights: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The next version: slots, largest first, leave their shard where that lowers the larger of two loads.

    A slot moves to the shard with the least bytes if that shard then still holds less than the slot's old
    shard did. The whole map is one row of at most ``slots`` entries, folded by ``aggregate``.
    """
    full = (slot_map.join(F.broadcast(weights.select("vslot", "bytes")), "vslot", "left")  # at most `slots` rows
            .select("version", "vslot", "shard", F.coalesce("bytes", F.lit(0)).alias("bytes")))
    one = full.groupBy().agg(
        F.max("version").alias("version"),
        F.sort_array(F.collect_list(F.struct((-F.col("bytes")).alias("order"), "vslot", "shard", "bytes"))).alias("slots"),
        F.array(*[F.coalesce(F.sum(F.when(F.col("shard") == s, F.col("bytes"))), F.lit(0)) for s in range(shards)])
        .alias("loads"))
    start = F.struct(F.col("loads"), F.expr("cast(array() as array<struct<vslot:int,shard:int>>)").alias("placed"))

    def step(state, slot):
        loads = state["loads"]
        low = (F.array_position(loads, F.array_min(loads)) - 1).cast("int")
        move = F.get(loads, low) + slot["bytes"] < F.get(loads, slot["shard"])
        to = F.when(move, low).otherwise(slot["shard"])
        new = F.transform(loads, lambda x, i: x + F.when(i == to, slot["bytes"]).otherwise(F.lit(0))
                          - F.when(i == slot["shard"], slot["bytes"]).otherwise(F.lit(0)))
        return F.struct(new.alias("loads"),
                        F.array_append(state["placed"], F.struct(slot["vslot"].alias("vslot"), to.alias("shard"))).alias("placed"))

    return (one.select("version", F.inline(F.aggregate("slots", start, step)["placed"]))
            .select((F.col("version") + 1).alias("version"), "vslot", "shard"))


def grow(slot_map: DataFrame, weights: DataFrame, shards: int) -> DataFrame:
    """The next version with one more shard, number ``shards``: slots move only into it.

    Every shard gives slots (in hash order) for up to one part in ``shards + 1`` of its bytes.
    """
    w = Window.partitionBy("shard").orderBy(F.xxhash64("vslot"), "vslot")
    given = F.sum("bytes").over(w) * (shards + 1) <= F.sum("bytes").over(Window.partitionBy("shard"))
    return (slot_map.join(F.broadcast(weights.select("vslot", "bytes")), "vslot", "left").na.fill(0, ["bytes"])
            .select((F.col("version") + 1).alias("version"), "vslot",
                    F.when(given, F.lit(shards)).otherwise(F.col("shard")).alias("shard")))


def store_map(slot_map: DataFrame, path: str) -> None:
    """Add a version to the stored map; earlier versions stay readable."""
    slot_map.write.partitionBy("version").mode("append").parquet(path)


def read_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One stored version, the latest by default."""
    stored = spark.read.parquet(path)
    if version is None:
        version = stored.agg(F.max("version")).first()[0]
    return stored.filter(F.col("version") == version).select("version", "vslot", "shard")


def place(docs: DataFrame, slot_map: DataFrame, slots: int = SLOTS) -> DataFrame:
    """The documents with their ``vslot`` and ``shard``; the map has at most ``slots`` rows."""
    keep = [docs[c] for c in docs.columns if c not in ("vslot", "shard")]
    return docs.select(*keep, virtual_slot(slots).alias("vslot")).join(
        F.broadcast(slot_map.select("vslot", "shard")), "vslot")


def balanced_map(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, path: str | None = None) -> DataFrame:
    """Store version 0 and the version rebalanced for ``docs``; return the latter as stored."""
    spark = docs.sparkSession
    path = path or work_path(spark, "slot-map")
    first = even_map(spark, shards, slots)
    store_map(first, path)
    store_map(rebalance(read_map(spark, path, 0), slot_bytes(docs, slots), shards), path)
    return read_map(spark, path)


def number_rows(placed: DataFrame, *order: str) -> DataFrame:
    """Number the rows of each shard without a gap: slots in order, then rows in order within their slot.

    Rows are ranked per virtual slot, so no task sees a whole shard; the slots' offsets are at most
    as many rows as there are slots.
    """
    offsets = placed.groupBy("shard", "vslot").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("shard").orderBy("vslot")) - F.col("_n")
    offsets = offsets.select("vslot", before.alias("_before"))
    rank = F.row_number().over(Window.partitionBy("vslot").orderBy(*order))
    return (placed.withColumn("_rank", rank).join(F.broadcast(offsets), "vslot")
            .withColumn("slot", (F.col("_before") + F.col("_rank") - 1).cast("long")).drop("_before", "_rank"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """The documents with ``vslot`` and ``shard`` under a map balanced by bytes."""
    return place(docs, balanced_map(docs, shards, slots), slots)


def op10_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eligo.llm.common import documents
    docs = documents(spark, sf_dir).select("doc_id", "text")
    placed = place(docs, balanced_map(docs)).select(
        "doc_id", record_size().alias("size"), record_crc().alias("text_crc32"), "vslot", "shard")
    return number_rows(placed, "doc_id", "size", "text_crc32").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "vslot")
