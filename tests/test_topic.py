"""Topics as files: offsets, order, restarts and replays."""

import pytest
from pyspark.sql import functions as F

from tidemark.session import scratch_path
from tidemark.sources import topic as tp
from tidemark.streaming import streams as s


def _publish(spark, path, lo, hi, partitions=4):
    tp.publish(spark.range(lo, hi, numPartitions=3), path, F.col("id") % 7, F.col("id"), partitions)


def _values(df):
    return sorted(int(r.value) for r in df.collect())


def test_offsets_are_gapless_per_partition(spark):
    path = scratch_path(spark, "topic")
    for lo in range(0, 300, 100):
        _publish(spark, path, lo, lo + 100)
    rows = tp.read_topic_log(spark, path, streaming=False).collect()
    assert sorted(int(r.value) for r in rows) == list(range(300))
    for p in {r.partition for r in rows}:
        mine = sorted((r.offset, int(r.value)) for r in rows if r.partition == p)
        assert [o for o, _ in mine] == list(range(len(mine)))
        assert [v // 100 for _, v in mine] == sorted(v // 100 for _, v in mine)  # later batches lie behind
        assert len({v % 7 for _, v in mine}) < 7
    keys = {}
    for r in rows:
        assert keys.setdefault(int(r.value) % 7, r.partition) == r.partition


def test_stream_goes_on_after_a_stop(spark):
    topic, sink, ckpt = (scratch_path(spark, x) for x in ("topic", "sink", "ckpt"))
    _publish(spark, topic, 0, 50)
    s.write_stream(tp.read_topic_log(spark, topic), sink, ckpt)
    assert _values(spark.read.parquet(sink)) == list(range(50))
    s.write_stream(tp.read_topic_log(spark, topic), sink, ckpt)  # nothing new
    _publish(spark, topic, 50, 80, partitions=9)  # more partitions than before
    s.write_stream(tp.read_topic_log(spark, topic), sink, ckpt)
    assert _values(spark.read.parquet(sink)) == list(range(80))
    again = scratch_path(spark, "sink")
    s.write_stream(tp.read_topic_log(spark, topic), again, scratch_path(spark, "ckpt"))  # a replay from the start
    assert _values(spark.read.parquet(again)) == list(range(80))


def test_a_batch_that_fails_reads_the_same_messages_again(spark):
    topic, ckpt, seen = scratch_path(spark, "topic"), scratch_path(spark, "ckpt"), []
    _publish(spark, topic, 0, 20)

    def broken(batch, batch_id):
        seen.append((batch_id, _values(batch)))
        raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        s.for_each_batch(tp.read_topic_log(spark, topic), broken, ckpt)
    _publish(spark, topic, 20, 30)
    for _ in range(2):  # the batch that failed, then what came since
        s.for_each_batch(tp.read_topic_log(spark, topic), lambda b, i: seen.append((i, _values(b))), ckpt)
    assert seen[0] == seen[1] == (0, list(range(20))) and seen[2:] == [(1, list(range(20, 30)))]


def test_latest_skips_what_was_there(spark):
    topic, sink, ckpt = (scratch_path(spark, x) for x in ("topic", "sink", "ckpt"))
    _publish(spark, topic, 0, 20)
    s.write_stream(tp.read_topic_log(spark, topic, starting="latest"), sink, ckpt)
    _publish(spark, topic, 20, 25)
    s.write_stream(tp.read_topic_log(spark, topic, starting="latest"), sink, ckpt)
    assert _values(spark.read.parquet(sink)) == list(range(20, 25))


def test_null_and_empty_messages(spark):
    topic = scratch_path(spark, "topic")
    assert tp.read_topic_log(spark, topic, streaming=False).count() == 0
    df = spark.createDataFrame([(None, None), (None, ""), (1, "x"), (1, None)], "k int, v string")
    tp.publish(df.limit(0), topic, F.col("k"), F.col("v"))
    tp.publish(df, topic, F.col("k"), F.col("v"))
    got = tp.read_topic_log(spark, topic, streaming=False)
    assert sorted(str(r.value) for r in got.collect()) == ["", "None", "None", "x"]
    assert got.groupBy("partition", "offset").count().filter("count > 1").count() == 0


def test_only_the_range_of_a_segment_is_read(spark):
    topic = scratch_path(spark, "topic")
    tp.publish(spark.range(1000, numPartitions=1), topic, F.lit(1), F.col("id"), 1)
    parts = tp._between(topic, {"0": 120}, {"0": 450})
    assert sum(p.hi - p.lo for p in parts) == 330
    offsets = [o for p in parts for b in tp._messages(p) for o in b.column("offset").to_pylist()]
    assert sorted(offsets) == list(range(120, 450))
