"""Sharding by longest-processing-time scheduling, with equal texts kept together.

Groups of equal texts, sorted by size, go one after the other to the least-loaded shard, through
a heap. The heap sees a bounded number of items however many groups there are: a group of more
than 1/BIG_GROUPS of all bytes is an item of its own (so there are at most BIG_GROUPS of them);
the others are first gathered by hash into ranges, wide ones that bring most of the bytes and
narrow ones that come last and fill the gaps. Only item sizes reach the driver and only the
items' shards go back, as a broadcast of at most BIG_GROUPS + 2 * RANGES rows.

Defined results: null text counts as empty, and all empty texts are one group; null ids are
kept; repeated rows each get a slot; an empty table gives an empty result; extra columns are
ignored. A group larger than a shard's share makes its shard that much larger.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.store import from_rows, hash60, materialise, needs, running_sum

SHARDS = 40
#: Bytes of a row besides its text.
ROW_BYTES = 16
BIG_GROUPS = 4000
#: Wide ranges, and narrow ranges that share one NARROW-th of the groups.
RANGES = 4096
NARROW = 16


def least_loaded(items: list[tuple[str, int]], shards: int) -> list[tuple[str, int]]:
    """(item, shard): items by falling size, each to the shard with the least so far."""
    heap = [(0, s) for s in range(shards)]
    placed = []
    for item, size in sorted(items, key=lambda x: (-x[1], x[0])):
        load, shard = heap[0]
        heapq.heapreplace(heap, (load + size, shard))
        placed.append((item, shard))
    return placed


def _range_of(key: Column) -> Column:
    """The hash range of a small group: 0 .. RANGES - 1 are wide, the next RANGES narrow."""
    unit = F.shiftright(F.conv(F.substring(key, 17, 15), 16, 10).cast("long"), 7) / float(1 << 53)
    edge = 1 - 1 / NARROW
    return F.when(unit < edge, F.least(F.floor(unit / edge * RANGES), F.lit(RANGES - 1))) \
        .otherwise(RANGES + F.least(F.floor((unit - edge) * NARROW * RANGES),
                                    F.lit(RANGES - 1))).cast("string")


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, text_key (md5), shard, slot of every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    needs(docs, "doc_id", "text")
    rows = materialise(docs.select(
        "doc_id", (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.md5(text).alias("text_key")), "shard-rows")
    spark = docs.sparkSession
    total = rows.agg(F.sum("size")).first()[0] or 0
    groups = rows.groupBy("text_key").agg(F.sum("size").alias("size"))
    big = F.col("size") * BIG_GROUPS > total
    item = F.when(big, F.col("text_key")).otherwise(_range_of(F.col("text_key")))
    items = [(r["item"], r["size"]) for r in
             groups.groupBy(item.alias("item")).agg(F.sum("size").alias("size")).collect()]
    placed = from_rows(spark, least_loaded(items, shards), "item string, shard int")
    whole = placed.select(F.col("item").alias("_big"), F.col("shard").alias("_own"))
    part = placed.select(F.col("item").alias("_range"), F.col("shard").alias("_theirs"))
    # Both are bounded by BIG_GROUPS + 2 * RANGES rows; an md5 never equals a range's number.
    dealt = rows.join(F.broadcast(whole), rows["text_key"] == F.col("_big"), "left") \
        .join(F.broadcast(part), _range_of(F.col("text_key")) == F.col("_range"), "left") \
        .select(*rows.columns, F.coalesce("_own", "_theirs").alias("shard"),
                hash60(F.lit("slot"), F.col("doc_id").cast("string"), F.col("text_key"))
                .alias("_key"))
    counts = dealt.groupBy("shard").agg(F.count(F.lit(1)).alias("_rows")) \
        .withColumnRenamed("shard", "_shard")
    counted = dealt.join(F.broadcast(counts), F.col("shard") == F.col("_shard")) \
        .select(*dealt.columns, "_rows", F.lit(1).cast("long").alias("_one"))
    placed_rows = running_sum(counted, ["shard"], "_key", "_one", ["doc_id"], "_rows", "slot")
    return placed_rows.select("doc_id", "size", "text_crc32", "text_key", "shard", "slot")


def shard_table(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard under the law of near equal bytes."""
    return shard_documents(docs, shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
