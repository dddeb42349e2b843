"""Sharding by Karmarkar-Karp differencing.

Texts that are equal form one group. A group stays in one shard unless it is larger than a `1 / (shards * BUNDLES)` part
of all bytes *and* than one shard's even share; only such a group is dealt out in pieces by doc_id. Groups up to that part
are put into a fixed number of bundles by a hash of their text, so the driver differences at most
`2 * shards * BUNDLES` items plus the pieces, whatever the input's size; the executors only aggregate.

Defined results: a null text has size 16, no bytes and is equal to an empty text; a null doc_id is dealt like any other;
repeated rows are separate rows of one group; ties are settled by the item's number; a very long text counts with all its
bytes and is never cut, so one larger than a shard's even share makes its shard larger; no setting of the session changes
shards or slots; an empty table gives no rows; only `doc_id` and `text` are read, other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import saved

SHARDS = 40
#: Bundles of small groups for each shard.
BUNDLES = 256
#: Pieces for each even share of bytes that an oversized group has.
PIECES = 64
ROW_BYTES = 16


def karmarkar_karp(sizes: Sequence[int], shards: int) -> list[int]:
    """The shard of each item. Partial partitions with the largest spread are combined first, oppositely ordered."""
    if not len(sizes):
        return []
    heap = []
    for i, size in enumerate(sizes):
        sums = np.zeros(shards, dtype=np.int64)
        sums[0] = size
        heap.append((-int(size), i, sums, [i] + [None] * (shards - 1)))
    heapq.heapify(heap)
    made = len(heap)
    while len(heap) > 1:
        _, _, a, in_a = heapq.heappop(heap)
        _, _, b, in_b = heapq.heappop(heap)
        sums = a + b[::-1]
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        joined = [x if y is None else y if x is None else (x, y) for x, y in zip(in_a, reversed(in_b))]
        heapq.heappush(heap, (int(sums[-1] - sums[0]), made, sums, [joined[k] for k in order]))
        made += 1
    out = [0] * len(sizes)
    for shard, tree in enumerate(heap[0][3]):
        todo = [tree]
        while todo:
            x = todo.pop()
            if isinstance(x, tuple):
                todo.extend(x)
            elif x is not None:
                out[x] = shard
    return out


def shard_documents(docs: DataFrame, shards: int = SHARDS, bundles: int = BUNDLES) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot: near-equal bytes in each shard, slots gapless from 0 within a shard."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = saved(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.unhex(F.md5(text)).alias("text_key"),
        ),
        "shard-rows",
    )
    total = rows.agg(F.sum("size")).first()[0] or 0
    even, part = total / shards, total / (shards * bundles)
    groups = rows.groupBy("text_key").agg(F.sum("size").alias("bytes"))
    # at most shards * bundles groups can be larger than that part of the total
    large = sorted((bytes(r.text_key), r.bytes) for r in groups.where(F.col("bytes") > part).collect())
    first, dealt = shards * bundles, []
    for key, size in large:
        pieces = 1 if size <= even else int(np.ceil(size / even)) * PIECES
        dealt.append((key, first, pieces))
        first += pieces
    schema = T.StructType([T.StructField("text_key", T.BinaryType()), T.StructField("first", T.LongType()), T.StructField("pieces", T.LongType())])
    unit = F.when(F.col("first").isNull(), F.pmod(F.xxhash64("text_key"), F.lit(shards * bundles))).otherwise(
        F.col("first") + F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.col("pieces"))
    )
    rows = rows.join(F.broadcast(spark.createDataFrame(dealt, schema)), "text_key", "left").withColumn("unit", unit)
    units = sorted((r.unit, r.bytes) for r in rows.groupBy("unit").agg(F.sum("size").alias("bytes")).collect())
    found = karmarkar_karp([b for _, b in units], shards)
    table = spark.createDataFrame([(u, int(s)) for (u, _), s in zip(units, found)], "unit long, shard int")
    # slots: a number within (block, shard), moved up by what earlier blocks hold; their number follows from the rows alone
    blocks = max(8, -(-rows.count() // 500_000))
    placed = rows.join(F.broadcast(table), "unit").withColumn("block", F.pmod(F.xxhash64(F.lit(2), "doc_id", "text_crc32"), F.lit(blocks)).cast("int"))
    counts = placed.groupBy("shard", "block").agg(F.count("*").alias("n"))
    before = counts.select("shard", "block", (F.sum("n").over(Window.partitionBy("shard").orderBy("block")) - F.col("n")).alias("before"))
    own = Window.partitionBy("shard", "block").orderBy("doc_id", "size", "text_crc32")
    return placed.withColumn("own", F.row_number().over(own)).join(before, ["shard", "block"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("own") - 1).cast("long").alias("slot")
    )


def op8(spark, sf_dir) -> DataFrame:
    out = shard_documents(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
