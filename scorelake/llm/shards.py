"""Sharding by Karmarkar-Karp differencing, with equal texts kept together.

The indivisible units are groups of equal texts. Spark adds up the bytes of every group;
the groups above 1/256 of a shard (fewer than 256 per shard, whatever the table holds) stay
units of their own, all others are dealt by the hash of their text into 256 crumbs per
shard, each a unit that keeps its groups whole. A group of up to a shard's share stays whole; a
larger one fits no shard and is cut into pieces of about 1/4 of a shard, few but small enough
that the shards can be balanced around them.
Differencing then runs over these units, whose number depends on the
shard count alone; rows are never gathered.
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorelake.llm.common import fresh_name, stored

CRUMBS_PER_SHARD = 256
PIECE = 1 / 4


def differencing(sizes: list[int], shards: int) -> list[int]:
    """The shard of every unit.

    Partial partitions wait in a heap by spread (largest total less smallest). The two with
    the largest spread are combined, the fullest part of one with the emptiest of the
    other, until one partition is left.
    """
    if not sizes:
        return []
    nodes: list[tuple] = []  # (unit,) or (left, right)

    def node(*members: int) -> int:
        nodes.append(members)
        return len(nodes) - 1

    heap = []
    for unit, size in enumerate(sizes):
        totals = [(0, -1)] * (shards - 1) + [(size, node(unit))]
        heap.append((-size, unit, totals))
    heapq.heapify(heap)
    order = len(sizes)
    while len(heap) > 1:
        (_, _, one), (_, _, other) = heapq.heappop(heap), heapq.heappop(heap)
        merged = []
        for (a, x), (b, y) in zip(one, reversed(other), strict=True):
            merged.append((a + b, x if y < 0 else y if x < 0 else node(x, y)))
        merged.sort()
        heapq.heappush(heap, (merged[0][0] - merged[-1][0], order, merged))
        order += 1
    places = [0] * len(sizes)
    for shard, (_, root) in enumerate(heap[0][2]):
        todo = [root] if root >= 0 else []
        while todo:
            members = nodes[todo.pop()]
            if len(members) == 1:
                places[members[0]] = shard
            else:
                todo.extend(members)
    return places


def _assigned(docs: DataFrame, shards: int, text: str, carried: Column) -> DataFrame:
    """One row per input row: carried (any column of it), size, text_crc32, shard and slot."""
    spark = docs.sparkSession
    content = F.coalesce(F.col(text), F.lit(""))
    base = stored(
        docs.select(
            carried.alias("carried"),
            (F.octet_length(content) + 1).cast("long").alias("size"),
            F.crc32(content.cast("binary")).alias("text_crc32"),
            F.coalesce(F.md5(F.col(text).cast("binary")), F.lit("null")).alias("gid"),
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().alias("uid"),
        ),
        "shard-rows",
    )
    total = base.agg(F.sum("size")).first()[0] or 0
    share = max(total / shards, 1)
    large = base.groupBy("gid").agg(F.sum("size").alias("bytes")).where(F.col("bytes") > share / CRUMBS_PER_SHARD).collect()  # < 256 a shard
    pieces = [(g, math.ceil(b / (share * PIECE)) if b > share else 1) for g, b in large]
    known = spark.createDataFrame(pieces, "gid string, pieces int")
    unit = F.when(F.col("pieces").isNull(), F.concat(F.lit("crumb:"), F.pmod(F.xxhash64("gid"), F.lit(shards * CRUMBS_PER_SHARD)))).otherwise(
        F.concat("gid", F.lit(":"), F.pmod(F.xxhash64("uid"), F.col("pieces")))
    )
    rows = base.join(F.broadcast(known), "gid", "left").withColumn("unit", unit)
    units = sorted((u, s) for u, s in rows.groupBy("unit").agg(F.sum("size")).collect())  # crumbs, large groups and pieces
    places = differencing([s for _, s in units], shards)
    where = spark.createDataFrame([(u, p) for (u, _), p in zip(units, places, strict=True)], "unit string, shard int")
    placed = rows.join(F.broadcast(where), "unit").select("carried", "size", "text_crc32", "part", "uid", "shard")
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("shard", "part").count().select("shard", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    local = F.row_number().over(Window.partitionBy("shard", "part").orderBy("uid")) - 1
    return placed.withColumn("local", local).join(offsets, ["shard", "part"]).select("carried", "size", "text_crc32", "shard", (F.col("offset") + F.col("local")).alias("slot"))


def assign_shards(docs: DataFrame, shards: int = 16, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per input row: key, size, text_crc32, shard and slot.

    size is the UTF-8 length of the text plus 1; a null text counts as empty for size and
    checksum but is a group apart from the empty text. Keys may be null or repeated: every
    row gets a slot. Slots run from 0 without gaps within each shard, in input order. An
    empty table gives no rows; other columns of the input are ignored.
    """
    return _assigned(docs, shards, text, F.col(key)).withColumnRenamed("carried", "doc_id")


def write_shards(docs: DataFrame, path: str, shards: int = 16, text: str = "text") -> None:
    """Write every row to one folder per shard, with its shard and slot.

    The rows themselves are carried through the assignment, so null and repeated keys lose
    and add none. The folders' column is ``shard``, or ``_shard`` where the table has one; so for ``slot``.
    """
    shard, slot = fresh_name(docs, "shard"), fresh_name(docs, "slot")
    placed = _assigned(docs, shards, text, F.struct("*")).select("carried.*", F.col("shard").alias(shard), F.col("slot").alias(slot))
    placed.repartition(shard, F.floor(F.col(slot) / 100_000)).write.partitionBy(shard).parquet(path)
