"""Sharding by Karmarkar-Karp differencing: groups of equal texts stay whole, shard bytes come out near equal.

Differencing needs all items in one heap, so the items are made few, by a bound that does not depend on the data: a group
over ``1 / (shards * FINENESS)`` of all bytes is an item of its own (there can be no more than ``shards * FINENESS``), and all
other groups are hashed into as many bundles. Differencing then repeatedly takes the two partial partitions with the
largest spread and joins them oppositely ordered, largest sum with smallest. Only sums of items leave the cluster.

Defined results: a null text has no bytes and counts one for its end, like an empty text, and belongs to the same group.
Rows with the same ``doc_id`` are sharded each. An empty table gives no rows. Other columns are not read. A group that is
larger than its fair share makes its shard larger than the others; it is not split.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.numbering import number_within
from tidemark.llm.registry import query
from tidemark.session import Tables, materialize

SHARDS = 8
FINENESS = 512  # items per shard, each of single groups and of bundles


def differencing(items: list[tuple[int, object]], shards: int) -> dict:
    """Shard of each ``(size, name)``, by Karmarkar-Karp differencing.

    A partial partition is its sums, in descending order, and for each the trees of names that make it up.
    """
    heap = []
    for n, (size, name) in enumerate(sorted(items, key=lambda x: (-x[0], str(x[1])))):
        sums = [size] + [0] * (shards - 1)
        heapq.heappush(heap, (-size, n, sums, [(name,)] + [()] * (shards - 1)))
    n = len(items)
    while len(heap) > 1:
        _, _, a, held_a = heapq.heappop(heap)
        _, _, b, held_b = heapq.heappop(heap)
        joined = sorted(((a[i] + b[-1 - i], i) for i in range(shards)), reverse=True)
        held = [(held_a[i], held_b[-1 - i]) for _, i in joined]
        low = joined[-1][0]
        heapq.heappush(heap, (low - joined[0][0], n, [s - low for s, _ in joined], held))
        n += 1
    out: dict = {}
    for shard, tree in enumerate(heap[0][3] if heap else []):
        todo = [tree]
        while todo:
            node = todo.pop()
            if len(node) == 1:
                out[node[0]] = shard
            else:
                todo.extend(node)
    return out


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", fineness: int = FINENESS) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32`` and ``shard`` of each row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("group"),
    )
    rows = materialize(rows, "shard-sizes")
    groups = rows.groupBy("group").agg(F.sum("size").alias("bytes"))
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    count, least = shards * fineness, total // (shards * fineness) + 1
    bundle = F.pmod("group", F.lit(count))
    single = F.col("bytes") >= least
    sums = groups.groupBy(single.alias("single"), F.when(single, F.col("group")).otherwise(bundle).alias("item")).agg(F.sum("bytes").alias("bytes"))
    items = [(r["bytes"], (r["single"], r["item"])) for r in sums.collect()]  # at most 2 * shards * fineness
    of = differencing(items, shards)
    spark = docs.sparkSession
    alone = spark.createDataFrame([(k, s) for (one, k), s in of.items() if one], "group long, alone int")
    bundled = spark.createDataFrame([(k, s) for (one, k), s in of.items() if not one], "bundle long, bundled int")
    return (
        rows.withColumn("bundle", bundle)
        .join(F.broadcast(alone), "group", "left")
        .join(F.broadcast(bundled), "bundle", "left")
        .select("doc_id", "size", "text_crc32", F.coalesce("alone", "bundled").alias("shard"))
    )


@query("op4_sharding")
def op4_sharding(t: Tables) -> DataFrame:
    """Shard and place of every document."""
    placed = number_within(shard_by_bytes(t.documents), "shard", ["doc_id", "text_crc32"], "slot")
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
