"""Shards over fixed virtual slots.

Records are hashed into a few thousand slots, bytes are summed per slot, and a small versioned table says which shard
each slot belongs to. Growing or rebalancing edits that table: whole slots move, records are never hashed anew.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from bodega.llm import common

SLOTS = 8192
MAP = "version int, virtual_slot int, shard int, bytes long"

SlotMap = dict[int, int]


def records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Settled rows (doc_id, size, text_crc32, virtual_slot, part), a row each, repeated ones too.

    Size is the text's UTF-8 bytes (null: none) plus 8. The slot is a hash of doc_id, text and the row's number among the rows
    equal in both, so that neither a repeated or missing doc_id nor a row repeated whole makes a slot heavy.
    """
    text = F.coalesce("text", F.lit(""))
    rows = common.settle(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64("doc_id", "text").alias("hash"),
        F.spark_partition_id().alias("part"),
    ), "hashed-records")
    copies = common.number_within(rows, ["hash"], ["doc_id"], "copy")
    slot = F.pmod(F.xxhash64("hash", "copy"), F.lit(slots)).cast("int").alias("virtual_slot")
    return common.settle(copies.select("doc_id", "size", "text_crc32", slot, "part"), "records")


def slot_bytes(rows: DataFrame) -> dict[int, int]:
    """Bytes per slot; at most as many numbers as there are slots."""
    return {int(r[0]): int(r[1]) for r in rows.groupBy("virtual_slot").agg(F.sum("size")).collect()}


def first_map(weights: dict[int, int], shards: int, slots: int = SLOTS) -> SlotMap:
    """Heaviest slot first, each to the lightest shard; empty slots are dealt in turn."""
    load = [(0, s) for s in range(shards)]
    out = {}
    for slot in sorted(range(slots), key=lambda v: (-weights.get(v, 0), v)):
        if weights.get(slot, 0) == 0:
            out[slot] = slot % shards
            continue
        bytes_, shard = heapq.heappop(load)
        out[slot] = shard
        heapq.heappush(load, (bytes_ + weights[slot], shard))
    return out


def rebalance(current: SlotMap, weights: dict[int, int], shards: int, tolerance: float = 0.01) -> SlotMap:
    """Move whole slots from the heaviest to the lightest shard until they differ by at most `tolerance` of the mean.

    Works for more shards than before (the new ones start empty). Each move takes the largest slot that lessens the
    difference, so the load of the two shards gets closer with every move and the loop ends.
    """
    out = dict(current)
    held: dict[int, list[tuple[int, int]]] = defaultdict(list)
    load = dict.fromkeys(range(shards), 0)
    for slot, shard in out.items():
        held[shard].append((weights.get(slot, 0), slot))
        load[shard] += weights.get(slot, 0)
    for slots in held.values():
        slots.sort()
    mean = sum(load.values()) / shards
    while True:
        high, low = max(load, key=lambda s: (load[s], -s)), min(load, key=lambda s: (load[s], s))
        gap = load[high] - load[low]
        fit = [x for x in held[high] if 0 < x[0] < gap]
        if gap <= tolerance * mean or not fit:
            return out
        weight, slot = pick = min(fit, key=lambda x: (abs(gap - 2 * x[0]), x))
        if abs(gap - 2 * weight) >= gap:
            return out
        held[high].remove(pick)
        held[low].append(pick)
        held[low].sort()
        load[high] -= weight
        load[low] += weight
        out[slot] = low


def save_map(spark: SparkSession, path: str, version: int, slot_map: SlotMap, weights: dict[int, int]) -> None:
    """Store one version; earlier versions stay and are never changed."""
    rows = [(version, v, s, weights.get(v, 0)) for v, s in sorted(slot_map.items())]
    spark.createDataFrame(rows, MAP).coalesce(1).write.parquet(f"{path}/version={version:06d}")


def load_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema(MAP).parquet(f"{path}/version={version:06d}")


def assign(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Give every settled record its shard and its place there (column slot, gapless from 0 in each shard)."""
    small = F.broadcast(slot_map.select("virtual_slot", "shard"))  # a row per slot, their number is fixed
    numbered = common.number_within(rows, ["virtual_slot"], ["doc_id", "text_crc32", "size"], "_inside")
    counts = rows.groupBy("virtual_slot").agg(F.count(F.lit(1)).alias("_n")).join(small, "virtual_slot")
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = F.broadcast(counts.select("virtual_slot", "shard", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first")))
    return (numbered.join(starts, "virtual_slot").withColumn("slot", F.col("_first") + F.col("_inside"))
            .drop("_first", "_inside", "part"))


def shard_documents(docs: DataFrame, shards: int = 24, map_path: str | None = None, slots: int = SLOTS) -> DataFrame:
    """Shard all rows with near equal bytes: every column of `records` but part, with shard and slot (place there, from 0).

    The slot map is stored at `map_path`: version 1 deals the slots in turn, version 2 moves slots until no move makes the heaviest
    shard lighter; rows are assigned by version 2. A null text has no bytes; null and repeated doc_ids and rows repeated whole are
    rows of their own; other columns are not read; an empty table gives an empty one. Rows of equal doc_id, text and size are interchangeable.
    """
    spark = docs.sparkSession
    rows, path = records(docs, slots), map_path or common.scratch(spark, "slot-map")
    weights = slot_bytes(rows)
    dealt = {v: v % shards for v in range(slots)}
    save_map(spark, path, 1, dealt, weights)
    save_map(spark, path, 2, rebalance(dealt, weights, shards, 0.0), weights)
    return assign(rows, load_map(spark, path, 2))
