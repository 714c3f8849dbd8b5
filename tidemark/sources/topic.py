"""Topics as files: a message log with partitions and offsets, and a Spark data source that streams it.

A topic is a folder. ``publish`` appends segments (one parquet file each, rows in order) and then, in one file, their entries in the
log: which offsets of which partition a segment holds. The source reads the log on the driver, which sees names and counts, and the
segments in tasks, one per segment and batch. Offsets are kept in the checkpoint of the query, so a query that starts again goes on
where it stopped, and a batch that runs again reads the same messages.

The folder may be in any store that ``pyarrow.fs`` opens, local and shared folders included.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from tidemark.session import scratch_path
from tidemark.sources.tables import write_table

_LOG = "partition int, file string, first long, rows long, published timestamp"
MESSAGES = "partition int, offset long, published timestamp, value string"


class Segment(NamedTuple):
    """A segment, or, where ``lo`` and ``hi`` are narrower, a part of one."""

    partition: int
    file: str
    first: int
    lo: int
    hi: int
    published: int


def publish(messages: DataFrame, path: str, key: Column, value: Column, partitions: int = 8) -> None:
    """Append messages: those of one key go to one partition of the topic, and each partition numbers its messages from 0.

    Numbers follow from the rows of the segments, so a frequent key is cut into several of them instead of being sorted in one task.
    A missing key is a key; a missing value is a message without a body. One publisher at a time may write to a topic.
    """
    spark = messages.sparkSession
    batch = f"{path}/segments/{scratch_path(spark, 'batch').rsplit('/', 1)[1]}"
    part = F.pmod(F.xxhash64(key), F.lit(partitions)).cast("int")
    write_table(messages.select(value.cast("string").alias("value"), part.alias("partition")), batch, partition_by=["partition"])
    written = spark.read.schema("value string, partition int").parquet(batch)
    sizes = written.groupBy("partition", F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("rows"))
    try:
        ends = spark.read.schema(_LOG).parquet(f"{path}/log").groupBy("partition").agg(F.max(F.col("first") + F.col("rows")).alias("end"))
    except AnalysisException:  # the first batch of a topic
        ends = spark.createDataFrame([], "partition int, end long")
    before = F.sum("rows").over(Window.partitionBy("partition").orderBy("file").rowsBetween(Window.unboundedPreceding, -1))  # a row a file
    entries = sizes.join(ends, "partition", "left").select(
        "partition", "file", (F.coalesce("end", F.lit(0)) + F.coalesce(before, F.lit(0))).cast("long").alias("first"), "rows", F.current_timestamp().alias("published"))
    entries.coalesce(1).write.mode("append").parquet(f"{path}/log")


def _open(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(uri if ":" in uri.split("/", 1)[0] else f"file://{uri}")


def _segments(path: str) -> list[Segment]:
    """All entries of the log; an empty or missing topic has none."""
    store, folder = _open(f"{path}/log")
    found = store.get_file_info(pyarrow.fs.FileSelector(folder, allow_not_found=True))
    files = [f.path for f in found if f.base_name.startswith("part-") and f.base_name.endswith(".parquet")]
    out = []
    for file in files:
        table = pq.read_table(store.open_input_file(file))
        published = pc.cast(table.column("published"), pa.timestamp("us", "UTC")).cast(pa.int64()).to_pylist()
        rows = zip(*(table.column(c).to_pylist() for c in ("partition", "file", "first", "rows")), published)
        out += [Segment(p, f, first, first, first + n, at) for p, f, first, n, at in rows]
    return sorted(out)


def _ends(path: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for s in _segments(path):
        out[str(s.partition)] = max(s.hi, out.get(str(s.partition), 0))
    return out


def _between(path: str, start: dict[str, int], end: dict[str, int]) -> list[Segment]:
    """The parts of segments whose offsets lie in the range of their partition."""
    parts = []
    for s in _segments(path):
        lo, hi = max(s.lo, int(start.get(str(s.partition), 0))), min(s.hi, int(end.get(str(s.partition), 0)))
        if lo < hi:
            parts.append(s._replace(lo=lo, hi=hi))
    return parts


def _messages(s: Segment) -> Iterator[pa.RecordBatch]:
    """Messages of a part of a segment; row groups outside it are not read."""
    store, file = _open(s.file)
    with store.open_input_file(file) as opened:
        parquet, at = pq.ParquetFile(opened), s.first
        for group in range(parquet.num_row_groups):
            n = parquet.metadata.row_group(group).num_rows
            if at < s.hi and at + n > s.lo:
                base = at
                for batch in parquet.iter_batches(row_groups=[group], columns=["value"]):
                    a, b = max(s.lo - base, 0), min(s.hi - base, len(batch))
                    if a < b:
                        m = b - a
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([s.partition] * m, pa.int32()), pa.array(range(base + a, base + b), pa.int64()),
                             pa.array([s.published] * m, pa.timestamp("us", "UTC")), batch.column("value").slice(a, m)],
                            names=["partition", "offset", "published", "value"])
                    base += len(batch)
            at += n


class TopicSource(DataSource):
    """``spark.read`` and ``spark.readStream`` of a topic: format ``topic``, the folder as path.

    Options: ``starting`` is ``earliest`` (the default) or ``latest``, for a stream without a checkpoint.
    """

    @classmethod
    def name(cls) -> str:
        return "topic"

    def schema(self) -> str:
        return MESSAGES

    def reader(self, schema) -> DataSourceReader:
        return _Batch(self.options["path"])

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Stream(self.options["path"], self.options.get("starting", "earliest"))


class _Batch(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(tuple(s)) for s in _segments(self.path)] or [InputPartition(None)]

    def read(self, partition: InputPartition):
        yield from _messages(Segment(*partition.value)) if partition.value else ()


class _Stream(DataSourceStreamReader):
    def __init__(self, path: str, starting: str):
        self.path, self.starting = path, starting

    def initialOffset(self) -> dict:
        return _ends(self.path) if self.starting == "latest" else {}

    def latestOffset(self) -> dict:
        return _ends(self.path)

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [InputPartition(tuple(s)) for s in _between(self.path, start, end)]

    def read(self, partition: InputPartition):
        yield from _messages(Segment(*partition.value))

    def commit(self, end: dict) -> None:
        """Messages stay: other queries read the same topic."""


def read_topic_log(spark: SparkSession, path: str, streaming: bool = True, starting: str = "earliest") -> DataFrame:
    """Messages of a topic folder: ``partition, offset, published, value``."""
    spark.dataSource.register(TopicSource)
    reader = spark.readStream if streaming else spark.read
    return reader.format("topic").option("starting", starting).load(path)
