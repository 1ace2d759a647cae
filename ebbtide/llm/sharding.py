"""Sharding through fixed virtual slots.

Records hash into ``n_slots`` slots that never change. The bytes of each slot
are aggregated, and a versioned table maps slots to shards: version 1 deals the
slots, largest first, to the shard with the fewest bytes; adding a shard edits
the map by moving slots into the new shard only and stores the next version.

Law of the shards: ``bytes`` (sizes near equal). Only DataFrame and SQL
functions are used; the map has one row a slot, so its folding (one row of
``n_slots`` entries) and its broadcast are bounded by that parameter.

Null ids and null texts hash like any value (null text: no bytes). Repeated
rows land in the same slot, in any order among themselves. An empty table has
an empty map and no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import stored

N_SLOTS = 4096
#: Bytes counted for a record besides its text.
RECORD_BYTES = 8


def size_of(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(RECORD_BYTES).cast("long")


def with_slots(docs: DataFrame, n_slots: int = N_SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a record: id, size, text_crc32 and virtual_slot."""
    crc = F.crc32(F.coalesce(F.col(text_col), F.lit("")))
    return docs.select(
        F.col(id_col).alias("doc_id"),
        size_of(F.col(text_col)).alias("size"),
        crc.alias("text_crc32"),
        F.pmod(F.xxhash64(F.col(id_col), crc), F.lit(n_slots)).cast("int").alias("virtual_slot"),
    )


def slot_bytes(slotted: DataFrame) -> DataFrame:
    return slotted.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))


def _largest_first(rows: DataFrame) -> DataFrame:
    """All slots in one array of structs (bytes, rows, virtual_slot), largest first; n_slots entries at most."""
    return rows.agg(F.sort_array(F.collect_list(F.struct("bytes", "rows", "virtual_slot")), asc=False).alias("slots"))


def first_map(slots: DataFrame, n_shards: int) -> DataFrame:
    """Version 1: each slot, largest first, goes to the shard with the fewest bytes so far."""
    fold = f"""aggregate(slots,
        named_struct('load', array_repeat(0L, {n_shards}), 'to', cast(array() as array<int>)),
        (s, x) -> named_struct(
            'load', transform(s.load, (b, i) -> if(i + 1 = array_position(s.load, array_min(s.load)), b + x.bytes, b)),
            'to', concat(s.to, array(cast(array_position(s.load, array_min(s.load)) - 1 as int)))),
        s -> s.to)"""
    dealt = _largest_first(slots).select("slots", F.expr(fold).alias("shard")).select(F.explode(F.arrays_zip("slots", "shard")).alias("x"))
    return dealt.select(
        F.lit(1).alias("version"),
        F.col("x.slots.virtual_slot").alias("virtual_slot"),
        F.col("x.shard").alias("shard"),
        F.col("x.slots.bytes").alias("bytes"),
        F.col("x.slots.rows").alias("rows"),
    )


def add_shard(slot_map: DataFrame, n_shards: int) -> DataFrame:
    """The next version of a map of ``n_shards`` shards: slots move into shard ``n_shards`` only.

    Slots are taken, largest first, from shards that stay above the new mean,
    while the new shard stays below it.
    """
    mean = f"(aggregate(slots, 0L, (s, x) -> s + x.bytes) / {n_shards + 1})"
    fold = f"""aggregate(slots,
        named_struct('load', transform(sequence(0, {n_shards}), k -> aggregate(filter(slots, x -> x.shard = k), 0L, (s, x) -> s + x.bytes)),
                     'to', cast(array() as array<int>)),
        (s, x) -> if(s.load[x.shard] - x.bytes >= {mean} * 0.999 and s.load[{n_shards}] + x.bytes <= {mean} * 1.001,
            named_struct(
                'load', transform(s.load, (b, i) -> if(i = x.shard, b - x.bytes, if(i = {n_shards}, b + x.bytes, b))),
                'to', concat(s.to, array({n_shards}))),
            named_struct('load', s.load, 'to', concat(s.to, array(x.shard)))),
        s -> s.to)"""
    rows = slot_map.agg(
        F.max("version").alias("version"),
        F.sort_array(F.collect_list(F.struct("bytes", "rows", "virtual_slot", "shard")), asc=False).alias("slots"),
    )
    moved = rows.select("version", "slots", F.expr(fold).alias("shard")).select("version", F.explode(F.arrays_zip("slots", "shard")).alias("x"))
    return moved.select(
        (F.col("version") + 1).alias("version"),
        F.col("x.slots.virtual_slot").alias("virtual_slot"),
        F.col("x.shard").alias("shard"),
        F.col("x.slots.bytes").alias("bytes"),
        F.col("x.slots.rows").alias("rows"),
    )


def save_map(slot_map: DataFrame, path: str) -> None:
    """Adds this version to the stored maps; writing a version again replaces it alone."""
    slot_map.write.partitionBy("version").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def load_map(spark, path: str, version: int | None = None) -> DataFrame:
    """A stored version, by default the latest."""
    maps = spark.read.parquet(path)
    if version is None:
        version = maps.agg(F.max("version")).first()[0]
    return maps.filter(F.col("version") == version).select("version", "virtual_slot", "shard", "bytes", "rows")


def assign(slotted: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Each record's shard, and its place in the shard counted from 0.

    A record's place is the number of records in the shard's earlier slots plus
    its place in its own slot: the window runs over one virtual slot, not over a
    shard. The map is broadcast: n_slots rows.
    """
    earlier = slot_map.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("virtual_slot", "rows"))).alias("own")).select(
        "shard",
        F.explode(F.expr("transform(own, (x, i) -> struct(x.virtual_slot as virtual_slot, aggregate(slice(own, 1, i), 0L, (s, y) -> s + y.rows) as before))")).alias("x"),
    ).select(F.col("x.virtual_slot").alias("virtual_slot"), "shard", F.col("x.before").alias("before"))
    placed = slotted.withColumn(
        "in_slot",
        F.expr("row_number() over (partition by virtual_slot order by doc_id, text_crc32, size)"),
    )
    return placed.join(F.broadcast(earlier), "virtual_slot").select(
        "doc_id", "size", "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("before") + F.col("in_slot") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
    )


def shard(docs: DataFrame, n_shards: int = 24, n_slots: int = N_SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All of ``docs`` in shards 0 to ``n_shards - 1``, sizes near equal (see the module)."""
    slotted = with_slots(docs, n_slots, id_col, text_col)
    slot_map = stored(first_map(slot_bytes(slotted), n_shards), "slot-map")
    return assign(slotted, slot_map)
