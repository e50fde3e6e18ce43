"""Sharding by fixed virtual slots: records hash into thousands of slots, and a versioned slot-to-shard map places slots.

Rows with equal texts hash into one slot, so that they share a shard.  Only a group of equal texts with more bytes than a
shard's fair share, which no shard can hold, is salted by its key over all slots.  Bytes are summed per slot.  The map is
a small table (one row per slot) with a version: the first one deals slots out in turn, and `rebalance` edits a version
into the next one by moving slots from the fullest shard to the emptiest until no move makes them more alike.

Rows are numbered within a shard by slot, then by part: a slot has one part for every PART_ROWS rows (dealt by key), so
that no task numbers a large slot alone.  Only the sums per slot (a fixed number of rows) reach the driver.

Edge cases: a null text has zero bytes and the CRC of an empty text; null and repeated keys are rows like any other;
an empty table gives an empty result; other columns are not carried, so that their names cannot clash.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded_broadcast, int_array, shared_dir, staged, text_or_empty

#: Virtual slots; fixed for the life of a corpus.
SLOTS = 4096
#: Rows of a slot that are numbered in one task.
PART_ROWS = 1 << 20


def rebalance(placed: list[int], slot_bytes: dict[int, int], shards: int) -> list[int]:
    """An edited map for `shards` shards: slots of removed shards, then slots of the fullest one, go to the emptiest one.

    A slot moves only if that leaves the two shards more alike.  Where shards are new, slots move into those only.
    """
    placed, old = list(placed), max(placed) + 1
    load, own = [0] * shards, [set() for _ in range(shards)]
    loose = []
    for slot, shard in enumerate(placed):
        if shard < shards:
            load[shard] += slot_bytes.get(slot, 0)
            own[shard].add(slot)
        else:
            loose.append(slot)

    def move(slot: int, target: int) -> None:
        placed[slot] = target
        load[target] += slot_bytes.get(slot, 0)
        own[target].add(slot)

    for slot in sorted(loose, key=lambda s: (-slot_bytes.get(s, 0), s)):
        move(slot, min(range(shards), key=lambda s: (load[s], len(own[s]), s)))
    takers = range(old, shards) if old < shards else range(shards)
    while True:
        full, empty = max(range(shards), key=load.__getitem__), min(takers, key=load.__getitem__)
        gap = load[full] - load[empty]
        fit = [s for s in own[full] if 0 < slot_bytes.get(s, 0) < gap]
        if not fit:
            return placed
        # nearest to half of the gap
        slot = min(fit, key=lambda s: (abs(gap - 2 * slot_bytes[s]), s))
        own[full].remove(slot)
        load[full] -= slot_bytes[slot]
        move(slot, empty)


def save_map(spark: SparkSession, path: str, placed: list[int], version: int) -> None:
    """Append one version of the map: (version, slot, shard)."""
    (
        spark.range(1)
        .select(F.lit(version).alias("version"), F.posexplode(int_array(placed)).alias("slot", "shard"))
        .coalesce(1)
        .write.mode("append")
        .parquet(path)
    )


def load_map(spark: SparkSession, path: str, version: int | None = None) -> tuple[int, list[int]]:
    """A version of the map, the newest one by default."""
    versions = spark.read.parquet(path)
    if version is None:
        version = versions.agg(F.max("version")).head()[0]
    rows = versions.where(F.col("version") == version).orderBy("slot").collect()  # a fixed number of slots
    return version, [int(r["shard"]) for r in rows]


def slot_of(content: Column, key: Column, hot: list[int], slots: int = SLOTS) -> Column:
    """The slot of a row: by its text's hash, and for hot texts by text and key."""
    if not hot:
        return F.pmod(content, F.lit(slots)).cast("int")
    salted = F.xxhash64(content, key)
    return F.pmod(F.when(content.isin(hot), salted).otherwise(content), F.lit(slots)).cast("int")


def shard(docs: DataFrame, shards: int = 8, key: str = "doc_id", text: str = "text", slots: int = SLOTS) -> DataFrame:
    """One row per document: key, size, text_crc32, law, shard, slot (place in its shard), grown_shard, virtual_slot."""
    spark = docs.sparkSession
    content = text_or_empty(text)
    rows = staged(
        docs.select(
            F.col(key).alias("doc_id"),
            (F.octet_length(content) + 1).cast("long").alias("size"),
            F.crc32(F.encode(content, "UTF-8")).alias("text_crc32"),
            F.xxhash64(content).alias("content"),
        ),
        "shard-rows",
    )
    total = rows.agg(F.sum("size")).head()[0] or 0
    # fewer than `shards` groups can have so many bytes
    groups = rows.groupBy("content").agg(F.sum("size").alias("bytes")).where(F.col("bytes") > total / shards)
    hot = [r["content"] for r in groups.collect()]
    rows = rows.withColumn("virtual_slot", slot_of(F.col("content"), F.col("doc_id"), hot, slots))
    sums = rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()
    path = f"{shared_dir(spark)}/slot-map-{uuid.uuid4().hex}"
    save_map(spark, path, [slot % shards for slot in range(slots)], 1)
    version, placed = load_map(spark, path)
    save_map(spark, path, rebalance(placed, {r["virtual_slot"]: int(r["bytes"]) for r in sums}, shards), version + 1)
    _, placed = load_map(spark, path)
    parts = [1] * slots
    for r in sums:
        parts[r["virtual_slot"]] = -(-r["n"] // PART_ROWS)
    of_slot = F.element_at(int_array(placed), F.col("virtual_slot") + 1).cast("int")
    n_parts = F.element_at(int_array(parts), F.col("virtual_slot") + 1)
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "text_crc32"), n_parts).cast("int"))
    counts = rows.groupBy("virtual_slot", "part").agg(F.count("*").alias("n")).withColumn("shard", of_slot)
    before = Window.partitionBy("shard").orderBy("virtual_slot", "part").rowsBetween(Window.unboundedPreceding, -1)
    # a row for each slot, and for every PART_ROWS rows
    bases = counts.select(
        "virtual_slot", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    )
    within = Window.partitionBy("virtual_slot", "part").orderBy("doc_id", "text_crc32")
    return (
        rows.withColumn("rank", F.row_number().over(within))
        .join(bounded_broadcast(staged(bases, "shard-bases")), ["virtual_slot", "part"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            of_slot.alias("shard"),
            (F.col("base") + F.col("rank") - 1).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            "virtual_slot",
        )
    )
