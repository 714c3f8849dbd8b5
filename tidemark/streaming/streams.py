"""Streaming sources, sinks and windows. Jobs run with ``availableNow``: drain what is there, then stop."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidemark.functions.semantics import tumble as bucket_start


def read_stream(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet", options: dict[str, str] | None = None) -> DataFrame:
    """Files as an unbounded table."""
    return spark.readStream.format(fmt).schema(schema).options(**(options or {})).load(path)


def read_topic(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Message bodies of a Kafka topic; needs the public spark-sql-kafka package."""
    raw = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).load()
    return raw.select(F.col("value").cast("string").alias("data"))


def parse_json(df: DataFrame, schema: StructType | str, col: str = "data") -> DataFrame:
    """Message text to typed columns."""
    return df.select(F.from_json(col, schema).alias("m")).select("m.*")


def write_stream(df: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None, fmt: str = "parquet") -> None:
    """Append sink with exactly-once files; returns when all present input is written."""
    writer = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.trigger(availableNow=True).start(path).awaitTermination()


def for_each_batch(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Run ``fn(batch, batch_id)`` on each micro-batch until the input is drained."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(fn)
    writer.trigger(availableNow=True).start().awaitTermination()


def tumble(
    df: DataFrame, ts: str, seconds: int, keys: list[str], aggs: list[Column], watermark: str | None = None, zone: str = "UTC"
) -> DataFrame:
    """Aggregates per fixed time bucket. On a stream a watermark bounds the state; rows later than it are dropped."""
    if watermark is None and not df.isStreaming:
        return df.groupBy(bucket_start(F.col(ts), seconds, zone).alias("bucket"), *keys).agg(*aggs)
    # event time must be a TIMESTAMP; zone-less times are cast there and back in the session's zone
    src = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark or "0 seconds")
    out = src.groupBy(F.window(ts, f"{seconds} seconds").alias("__w"), *keys).agg(*aggs)
    start = F.col("__w.start").cast("timestamp_ntz")
    local = start if zone == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(zone), start)
    return out.withColumn("bucket", local).select("bucket", *[c for c in out.columns if c != "__w"])


def recency_windows(stream: DataFrame, ts: str, intervals: dict[str, int], slide: int, lateness: int, keys: list[str] = ()) -> DataFrame:
    """At every tick (each ``slide`` seconds) the number of events of the last so many seconds, for several spans: ``tick, span, n``.

    An event counts at the ticks from its own time up to, not including, its time plus the span. Ticks are final once events may
    no longer come ``lateness`` seconds late. Ticks without events have no row. The state holds the open ticks only.
    """
    at = F.unix_seconds(F.col(ts).cast("timestamp")) + F.when(F.date_trunc("second", ts) < F.col(ts), 1).otherwise(0)  # the next whole second
    first = F.ceil(at / slide) * slide

    def ticks(name: str, span: int) -> Column:
        last = F.floor((F.unix_micros(F.col(ts).cast("timestamp")) + span * 1_000_000 - 1) / 1_000_000)
        every = F.when(first <= last, F.sequence(first, last, F.lit(slide).cast("long")))
        return F.transform(F.coalesce(every, F.array().cast("array<long>")), lambda x: F.struct(F.lit(name).alias("span"), F.timestamp_seconds(x).alias("tick")))

    spread = stream.filter(F.col(ts).isNotNull()).select(*keys, F.explode(F.flatten(F.array(*[ticks(n, s) for n, s in intervals.items()]))).alias("__t")).select(*keys, "__t.*")
    delay = f"{max(intervals.values()) + lateness} seconds"  # ticks run ahead of their events by the longest span
    counted = spread.withWatermark("tick", delay).groupBy(*keys, "span", "tick").agg(F.count("*").alias("n"))
    return counted.withColumn("tick", F.col("tick").cast("timestamp_ntz"))


def write_flushed(
    stream: DataFrame, ts: str, shape: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, marks: str, beyond: int
) -> None:
    """Append what ``shape`` makes of a stream, its last windows included.

    An append sink gets a window only once the watermark has passed it, so those at the end of the input would never come. Here
    the input is drained, and then a mark is put into a second folder of the same stream: a row with nothing but a time, ``beyond``
    seconds after the watermark. The watermark moves past all windows, and the same query emits them; the mark's own window stays in the state.
    ``beyond`` has to exceed the watermark's delay plus the longest window. Events that come after a flush go on from there: those
    before the mark are late. The mark must not count: ``shape`` sees it like any row, in a window that later input closes, so
    it filters rows without values where that matters.
    """
    spark = stream.sparkSession
    spark.createDataFrame([], stream.schema).write.mode("append").parquet(marks)
    out = shape(stream.unionByName(read_stream(spark, marks, stream.schema)))

    def drain() -> str | None:
        query = out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
        query.awaitTermination()
        last = query.lastProgress
        return last["eventTime"].get("watermark") if last and last["eventTime"] else None

    reached = drain()
    if reached and not reached.startswith("1970-01-01T00:00:00"):
        at = F.expr(f"timestamp_seconds(unix_seconds(timestamp'{reached.replace('T', ' ')}') + {beyond})")
        types = {f.name: f.dataType for f in stream.schema}
        spark.range(1).select(*[(at if c == ts else F.lit(None)).cast(k).alias(c) for c, k in types.items()]).write.mode("append").parquet(marks)
        drain()


def recent_counts(df: DataFrame, ts: str, intervals: dict[str, str], as_of: Column | None = None) -> DataFrame:
    """Row counts of several recency windows, in one pass over a stream's sink."""
    ref = as_of if as_of is not None else df.agg(F.max(ts)).scalar()
    return df.agg(*[F.count_if(F.col(ts) > ref - F.expr(f"INTERVAL {span}")).alias(n) for n, span in intervals.items()])
