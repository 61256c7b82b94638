"""Sharding into files of near equal bytes by Karmarkar-Karp differencing.

Documents with equal texts are one group, and a group lies in one shard.
Differencing starts with a partial partition per item (the item in one of the
shards, the others empty).  The two partial partitions of the largest spread
are combined again and again, the fullest shard of one with the emptiest of
the other, until one partition is left.

Items are bounded by the parameters, not by the corpus: a group as large as
the thousandth part of a shard is an item of its own (there can be at most
``shards * ITEMS_PER_SHARD``); the groups below that are dealt by their digest
into ``shards * ITEMS_PER_SHARD`` bundles, an item each.  So differencing works
on the same few ten thousand numbers at any size of the corpus, and a document
finds its shard by two broadcast lookups of that size: the texts, and the rows
of a hot group, are never shuffled together.

Defined cases: a null text is an empty one (16 bytes); an empty table gives an
empty result; repeated rows each take their place; other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.common import gapless, stored

ITEMS_PER_SHARD = 1000
#: Bytes that every document takes besides its text.
ROW_BYTES = 16


def difference(items: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each item, by Karmarkar-Karp differencing of their sizes."""
    n = len(items)
    if n == 0:
        return np.zeros(0, dtype=np.int32)
    # A node's sums are in falling order.  Node n + j combines left[j] and right[j]; its place p
    # holds place order[j][p] of the left one and the opposite place of the right one.
    left, right, order = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros((n, shards), np.int32)
    heap = [(-int(s), i) for i, s in enumerate(items)]
    heapq.heapify(heap)
    sums: dict[int, np.ndarray] = {}

    def of(node):
        if node < n:
            one = np.zeros(shards, np.int64)
            one[0] = items[node]
            return one
        return sums.pop(node)

    for j in range(n - 1):
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        both = of(a) + of(b)[::-1]
        by = np.argsort(-both, kind="stable")
        both = both[by]
        left[j], right[j], order[j], sums[n + j] = a, b, by, both
        heapq.heappush(heap, (int(both[-1] - both[0]), n + j))
    # From the last node down: which shard each place of a node has become.
    out = np.zeros(n, np.int32)
    became: dict[int, np.ndarray] = {heap[0][1]: np.arange(shards, dtype=np.int32)}
    for j in range(n - 2, -1, -1):
        here = became.pop(n + j)
        places = np.empty(shards, np.int32)
        places[order[j]] = here
        for child, at in ((left[j], places), (right[j], places[::-1])):
            if child < n:
                out[child] = at[0]
            else:
                became[int(child)] = at
    if n == 1:
        out[0] = 0
    return out


def shard_by_bytes(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, size, text_crc32, shard and slot (gapless from 0 within the shard) of every document."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = stored(docs.select(
        F.col(id_col).alias("id"), (F.length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("digest")), "sharding")
    bundles = shards * ITEMS_PER_SHARD
    bundle = F.pmod(F.xxhash64("digest"), F.lit(bundles))
    total, count = rows.agg(F.sum("size"), F.count(F.lit(1))).first()
    groups = rows.groupBy("digest").agg(F.sum("size").alias("bytes"))
    large = F.col("bytes") * bundles >= (total or 0)
    items = stored(groups.select(F.when(large, F.col("digest")).alias("digest"),
                                 F.when(~large, bundle).alias("bundle"), "bytes")
                   .groupBy("digest", "bundle").agg(F.sum("bytes").alias("bytes")), "shard-items")
    # At most `bundles` large groups and `bundles` bundles, whatever the corpus.
    listed = items.orderBy(F.desc("bytes"), "digest", "bundle").collect()
    dealt = difference(np.array([r["bytes"] for r in listed], dtype=np.int64), shards)
    spark = docs.sparkSession
    of_large = spark.createDataFrame([(bytes(r["digest"]), int(s)) for r, s in zip(listed, dealt, strict=True)
                                      if r["digest"] is not None], "digest binary, own int")
    of_bundle = spark.createDataFrame([(r["bundle"], int(s)) for r, s in zip(listed, dealt, strict=True)
                                       if r["bundle"] is not None], "bundle long, dealt int")
    placed = (rows.withColumn("bundle", bundle)
              .join(F.broadcast(of_large), "digest", "left").join(F.broadcast(of_bundle), "bundle", "left")
              .select("id", "size", "text_crc32", F.coalesce("own", "dealt").alias("shard")))
    return gapless(placed, "shard", ["id", "text_crc32", "size"], "slot", count).withColumnRenamed("id", id_col)


def op3_query(docs: DataFrame) -> DataFrame:
    return shard_by_bytes(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
