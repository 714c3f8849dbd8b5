"""Gapless numbering inside each key, without bringing a key, however frequent, into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.registry import task_count
from tidemark.session import materialize


def number_within(df: DataFrame, key: str, order_by: list[str], name: str) -> DataFrame:
    """Numbers 0, 1, ... of the rows of each ``key`` as long column ``name``.

    Rows are dealt into buckets by a hash of ``order_by``; each bucket of a key is numbered alone and starts after the
    buckets before it. Rows equal in ``key`` and ``order_by`` follow each other in any order. The bucket counts have at
    most one row per key and bucket, whatever the number of rows.
    """
    n = task_count(df.sparkSession)
    cut = materialize(df.withColumn("__bucket", F.pmod(F.xxhash64(*order_by), F.lit(n))), "numbered")
    sizes = cut.groupBy(key, "__bucket").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(key).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col(key).alias("__key"), F.col("__bucket").alias("__b"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = F.row_number().over(Window.partitionBy(key, "__bucket").orderBy(*order_by))
    return (
        cut.withColumn("__rn", inside)
        .join(starts, F.col(key).eqNullSafe(F.col("__key")) & (F.col("__bucket") == F.col("__b")))
        .withColumn(name, (F.col("__start") + F.col("__rn") - 1).cast("long"))
        .drop("__bucket", "__rn", "__key", "__b", "__start")
    )
