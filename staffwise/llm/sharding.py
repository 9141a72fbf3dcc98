"""Sharding by longest-processing-time scheduling: groups stay together, shards get near equal bytes.

Rows of equal text form a group. Groups are sorted by size and each goes to
the least-loaded shard, taken from a heap. Only a bounded number of items may
reach that heap, whatever the number of groups:

- a group of at least ``1 / (shards * FINE)`` of all bytes is an item of its
  own; there are at most ``shards * FINE`` of them;
- smaller groups are hashed into ``shards * BUNDLES`` bundles, each an item.

So at most ``shards * (FINE + BUNDLES)`` items with their sizes are scheduled
and broadcast back. A bundle keeps its groups together; its size is a small
part of a shard, so the heap evens the shards out.

Slots number the rows of a shard without gaps. A shard's rows are spread over
fine buckets by hash, buckets are counted, and a row's slot is its bucket's
offset plus its rank there: no task sorts a whole shard.

Defined results: null text has no bytes and is grouped with empty text; equal
sizes are scheduled in the order of their keys and the lowest shard of equal
load is taken, so reruns agree; a repeated row keeps its own slot. A group
larger than a shard's share stays whole (that is what the group is for).
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staffwise.llm.shared import stored

ROW_OVERHEAD = 16
FINE = 64
BUNDLES = 256
ROWS_PER_BUCKET = 20_000


def schedule(items: list[tuple[str, int]], shards: int) -> list[tuple[str, int]]:
    """Longest processing time first: (key, size) items to (key, shard)."""
    heap = [(0, shard) for shard in range(shards)]
    placed = []
    for key, size in sorted(items, key=lambda item: (-item[1], item[0])):
        load, shard = heapq.heappop(heap)
        placed.append((key, shard))
        heapq.heappush(heap, (load + size, shard))
    return placed


def sized_rows(docs: DataFrame, id_col: str, text_col: str, bundles: int) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    group = F.sha2(text, 256)
    return docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + F.lit(ROW_OVERHEAD)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        group.alias("group"),
    ).withColumn("bundle", F.format_string("b%d", F.pmod(F.xxhash64("group"), F.lit(bundles))))


def shard_lpt(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", fine: int = FINE, bundles: int = BUNDLES) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard, group."""
    spark = docs.sparkSession
    rows = stored(sized_rows(docs, id_col, text_col, shards * bundles), "shard-rows")
    total, n = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    groups = rows.groupBy("group", "bundle").agg(F.sum("size").alias("bytes"))
    own_item = F.col("bytes") * (shards * fine) >= F.lit(total)
    items = stored(
        groups.groupBy(F.when(own_item, F.col("group")).otherwise(F.col("bundle")).alias("item")).agg(F.sum("bytes").alias("bytes")),
        "shard-items",
    )
    placed = schedule([(r["item"], r["bytes"]) for r in items.collect()], shards)  # at most shards * (fine + bundles)
    plan = F.broadcast(spark.createDataFrame(placed, "item string, shard int"))

    own = plan.select(F.col("item").alias("group"), F.col("shard").alias("own_shard"))
    shared = plan.select(F.col("item").alias("bundle"), F.col("shard").alias("bundle_shard"))
    buckets = max(1, -(-n // (shards * ROWS_PER_BUCKET)))
    sharded = (
        rows.join(own, "group", "left")
        .join(shared, "bundle", "left")
        .withColumn("shard", F.coalesce("own_shard", "bundle_shard"))
        .withColumn("bucket", F.pmod(F.xxhash64("doc_id", F.lit("slot")), F.lit(buckets)))
    )
    counts = sharded.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    rank = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("doc_id", "group")) - 1
    return (
        sharded.withColumn("rank", rank)
        .join(offsets, ["shard", "bucket"])
        .select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
            (F.col("offset") + F.col("rank")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "group",
        )
    )
