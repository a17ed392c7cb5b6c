"""Sharding by fixed virtual slots and a versioned map from slots to shards.

A record's slot is a hash and never changes. Bytes are summed up per slot, and a map
that fits into the driver's hand (``SLOTS`` rows, whatever the records) says which shard
a slot lies in. To rebalance, the map is edited: only the slots that overfull shards give
up move. Every edit is a new version, and old ones stay, so a reader of version v finds its
records where they were.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import settle
from .order import AT, PART, numbered

SLOTS, SHARDS, ROW_BYTES = 8192, 40, 16
MAP = "version int, slot int, shard int"


def first_map(slots: int = SLOTS, shards: int = SHARDS) -> list[int]:
    """Version 0: slots dealt out in turn. The list gives the shard of each slot."""
    return [slot % shards for slot in range(slots)]


def rebalanced(shard_of: list[int], sizes: dict[int, int], shards: int = SHARDS) -> list[int]:
    """The map edited for the given bytes per slot and number of shards.

    A shard keeps its slots, largest first, up to the fair share; the others, and those
    of shards that are no more, go one by one, largest first, to the shard that
    holds least. Slots without bytes move only if their shard is no more.
    """
    fair, loads, loose, out = sum(sizes.values()) / shards, [0] * shards, [], list(shard_of)
    for slot in sorted(range(len(shard_of)), key=lambda x: (-sizes.get(x, 0), x)):
        size, shard = sizes.get(slot, 0), shard_of[slot]
        if shard < shards and loads[shard] + size <= fair:
            loads[shard] += size
        else:
            loose.append((slot, size))
    heap = [(load, shard) for shard, load in enumerate(loads)]
    heapq.heapify(heap)
    for slot, size in loose:
        load, shard = heapq.heappop(heap)
        out[slot] = shard
        heapq.heappush(heap, (load + size, shard))
    return out


def slot_of(slots: int, *keys: Column) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(slots)).cast("int")


def slot_sizes(records: DataFrame, slot: str = "virtual_slot", size: str = "size") -> dict[int, int]:
    """Bytes per slot; at most as many as there are slots come to the driver."""
    return {row[0]: row[1] for row in records.groupBy(slot).agg(F.sum(size)).collect()}


def map_table(spark, versions: list[list[int]]) -> DataFrame:
    """The slot map of all versions as a table in the shared folder."""
    rows = [(v, slot, shard) for v, shard_of in enumerate(versions) for slot, shard in enumerate(shard_of)]
    return settle(spark.createDataFrame(rows, MAP), "slot-map")


def with_repeats(rows: DataFrame, *keys: str, repeat: str = "repeat") -> DataFrame:
    """``rows``, as ``order.numbered`` gives them and written, with a number from 0 among the rows equal in ``keys``.

    Rows are counted per task and key, and the counts of a key summed up over the tasks, so that a
    third of all rows being equal is no more than a task's share in any one sort. Rows met once
    are not sorted. Keys whose hashes collide are numbered together, which spreads them as well.
    """
    hashed = rows.withColumn("_key", F.xxhash64(*keys))
    spans = hashed.groupBy("_key", PART).agg(F.count(F.lit(1)).alias("_rows"))
    often = settle(spans.groupBy("_key").agg(F.sum("_rows").alias("_all")).filter("_all > 1").select("_key"), "repeated")
    before = Window.partitionBy("_key").orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    bases = spans.join(often, "_key").select("_key", PART, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_base"))
    within = F.row_number().over(Window.partitionBy("_key", PART).orderBy(AT)) - 1
    again = hashed.join(bases, ["_key", PART]).withColumn(repeat, F.col("_base") + within).drop("_base")
    once = hashed.join(often, "_key", "left_anti").withColumn(repeat, F.lit(0).cast("long"))
    return once.unionByName(again).drop("_key")


def sharded(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot, map_version.

    ``size`` is the text's bytes in UTF-8 (null: none) plus 16 and ``slot`` the row's place in
    its shard, gapless from 0; the hashed slot is ``virtual_slot``. The law is ``bytes``: shards
    differ by about a small slot, unless a single row exceeds a fair share. A slot is
    hashed from doc_id and text, so rows without an id spread; rows that repeat both are
    numbered, and the number is hashed as well, so they spread too. Very long texts count by their size
    and are hashed where they are read. Other columns are ignored; an empty table gives no row.

    Places are counted in two steps, within a slot and over the slots of a shard, so the
    largest sort is a slot's. Texts are never shuffled.
    """
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), (F.octet_length(data) + ROW_BYTES).cast("long").alias("size"), F.crc32(data).alias("text_crc32"))
    rows = with_repeats(settle(numbered(rows), "sharded-rows"), "doc_id", "text_crc32", "size").drop(PART, AT)
    record = [F.col("doc_id"), F.col("text_crc32"), F.col("size")]
    slot = F.when(F.col("repeat") == 0, slot_of(slots, *record)).otherwise(slot_of(slots, *record, F.col("repeat")))
    rows = settle(rows.withColumn("virtual_slot", slot).drop("repeat"), "sharded")
    versions = [first_map(slots, shards)]
    versions.append(rebalanced(versions[0], slot_sizes(rows), shards))
    table = map_table(docs.sparkSession, versions).filter(F.col("version") == len(versions) - 1)
    counts = rows.groupBy("virtual_slot").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    placed = table.join(F.broadcast(counts), table.slot == counts.virtual_slot).select("virtual_slot", "shard", "version", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first"))
    within = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")) - 1
    # The map has a row per slot, at most ``slots``.
    return rows.withColumn("within", within).join(F.broadcast(placed), "virtual_slot").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("first") + F.col("within")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", F.col("version").alias("map_version")
    )
