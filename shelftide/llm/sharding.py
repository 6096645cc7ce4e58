"""Sharding over fixed virtual slots, in DataFrame functions only.

A record hashes by its key into one of ``SLOTS`` virtual slots, and a small versioned table says
which shard holds a slot. Growing by a shard or evening out bytes edits that table and moves whole
slots; records never change their slot. The table of a number of shards is a pure function of that
number (law ``key``), so adding a shard moves records only into the new one.

Places inside a shard come from counts by (slot, block): a window numbers the rows of a block, and
running sums of counts, of which there are at most SLOTS x BLOCKS, give its first place. No task
ever holds a shard.

Defined results: a null key hashes as Spark's null does, into one slot; rows with equal keys share a
slot and are spread over blocks by size and checksum of their text; equal rows get different places;
a null text has size 16 (the record's overhead) and the checksum of no bytes, 0; an empty table
gives no rows; slots with equal bytes move in the order of their numbers; a text of any length counts by its
bytes alone; columns of the input other than key and text are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelftide.session import materialise

SLOTS = 4096
BLOCKS = 64
OVERHEAD = 16


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")


def grown(shard_of: list[int]) -> list[int]:
    """The edit that adds one shard: it takes slots, one at a time, from the shard with most."""
    shards = max(shard_of) + 1
    held: list[list[int]] = [[] for _ in range(shards)]
    for slot, s in enumerate(shard_of):
        held[s].append(slot)
    out = list(shard_of)
    for _ in range(len(shard_of) // (shards + 1)):
        out[max(held, key=len).pop()] = shards
    return out


def slot_maps(spark: SparkSession, shards: int, slots: int = SLOTS) -> DataFrame:
    """(version, virtual_slot, shard) for ``shards`` and one more; the version is that number.

    Built by growing from one shard, so a version follows from its number alone. A fixed number of
    rows, made on the driver.
    """
    table, rows = [0] * slots, []
    for version in range(1, shards + 2):
        if version >= shards:
            rows += [(version, slot, s) for slot, s in enumerate(table)]
        table = grown(table)
    return spark.createDataFrame(rows, "version int, virtual_slot int, shard int")


def slot_sizes(records: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Rows and bytes of each slot; partial sums before the shuffle."""
    return records.groupBy("virtual_slot").agg(F.count("*").alias("rows"),
                                               F.sum("size").alias("bytes"))


def rebalanced_map(old: DataFrame, sizes: DataFrame, shards: int, slack: float = 0.01) -> DataFrame:
    """The next version, edited until no shard exceeds the mean by more than ``slack`` of it.

    Moves the fitting slot from the fullest to the emptiest shard, one at a time, while that lowers
    the fullest. Reads one row per slot (a fixed number) on the driver.
    """
    rows = (old.join(sizes, "virtual_slot", "left")
            .select("version", "virtual_slot", "shard", F.coalesce("bytes", F.lit(0)).alias("bytes"))
            .orderBy("virtual_slot").collect())
    held: dict[int, dict[int, int]] = {s: {} for s in range(shards)}
    for r in rows:
        held[r.shard][r.virtual_slot] = r.bytes
    total = {s: sum(x.values()) for s, x in held.items()}
    mean = sum(total.values()) / shards
    while True:
        full, low = max(total, key=lambda s: (total[s], -s)), min(total, key=lambda s: (total[s], s))
        gap = total[full] - total[low]
        fit = [(b, s) for s, b in held[full].items() if 0 < b < gap]
        if total[full] <= mean * (1 + slack) or not fit:
            break
        size, slot = min(fit, key=lambda x: (abs(gap / 2 - x[0]), x[1]))
        held[low][slot] = held[full].pop(slot)
        total[full] -= size
        total[low] += size
    version = rows[0].version + 1 if rows else 1
    return old.sparkSession.createDataFrame(
        sorted((version, slot, s) for s, x in held.items() for slot in x),
        "version int, virtual_slot int, shard int")


def records_of(docs: DataFrame, key: str = "doc_id", text: str = "text",
               slots: int = SLOTS) -> DataFrame:
    """Key, size, checksum and slot of each record; the text itself is not moved."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    return docs.select(
        F.col(f"`{key}`").alias("doc_id"),
        (F.octet_length(body) + OVERHEAD).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        slot_of(F.col(f"`{key}`"), slots).alias("virtual_slot"))


def placed(records: DataFrame, slot_map: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """Adds shard, from the table, and slot: the gapless place of the record in its shard."""
    block = F.pmod(F.xxhash64("doc_id", "size", "text_crc32", F.lit(1)), F.lit(blocks)).cast("int")
    rows = records.withColumn("block", block)
    counts = rows.groupBy("virtual_slot", "block").agg(F.count("*").alias("n"))
    before = (counts.join(F.broadcast(slot_map.select("virtual_slot", "shard")), "virtual_slot")
              .withColumn("first", F.sum("n").over(
                  Window.partitionBy("shard").orderBy("virtual_slot", "block")) - F.col("n"))
              .select("virtual_slot", "block", "shard", "first"))
    number = F.row_number().over(Window.partitionBy("virtual_slot", "block")
                                 .orderBy("doc_id", "size", "text_crc32"))
    return (rows.withColumn("number", number).join(before, ["virtual_slot", "block"])
            .withColumn("slot", F.col("first") + F.col("number") - 1)
            .drop("block", "number", "first"))


def sharded(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text",
            slots: int = SLOTS) -> DataFrame:
    """Every record with its shard, its place there, its shard after growing by one, and the shard that holds
    its slot once the table has been edited by the bytes of all slots.

    The versions of the slot table and the bytes of its slots are stored in the shared folder and read from
    there.
    """
    records = records_of(docs, key, text, slots)
    maps = materialise(slot_maps(docs.sparkSession, shards, slots), "slot-maps")
    old = maps.where(F.col("version") == shards)
    new = maps.where(F.col("version") == shards + 1).select(
        "virtual_slot", F.col("shard").alias("grown_shard"))
    sizes = materialise(slot_sizes(records, slots), "slot-sizes")
    even = materialise(rebalanced_map(old, sizes, shards), "balanced-map").select(
        "virtual_slot", F.col("shard").alias("balanced_shard"))
    return (placed(records, old).join(F.broadcast(new), "virtual_slot")
            .join(F.broadcast(even), "virtual_slot"))
