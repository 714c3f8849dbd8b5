"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.session import drop_materialized, materialize


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``component`` (least node reachable) of every node in a link; links are undirected.

    Each round ties larger neighbours to the least neighbour, then smaller ones; the table is then a star per component
    after a number of rounds that grows with the logarithm of the longest path. A node's neighbours are never gathered:
    only their minimum is, so a node with very many links is an ordinary aggregate and a join that splits its rows.
    """
    edges = materialize(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k")
        tied = large.join(least, F.col("u") == F.col("k"))
        small = tied.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select(F.col("k").alias("u"), F.col("m").alias("v")))
        last, edges = edges, materialize(small.distinct(), "small-star")
        drop_materialized(last, large)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
