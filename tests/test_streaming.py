"""Streams in several micro-batches against their batch twins, also out of order and restarted."""

from pyspark.sql import functions as F

from tidemark.operators.joins import pair_events
from tidemark.plans.sinks import order_changes
from tidemark.plans.streams import EVENT_SCHEMA
from tidemark.session import scratch_path
from tidemark.sources.changes import apply_changes
from tidemark.streaming import streams as s, trips as tr

ONE_FILE = {"maxFilesPerTrigger": "1"}


def _rows(df):
    return sorted(map(tuple, df.collect()))


def _shuffled_files(t, spark):
    """The events cut into eight files without regard to time."""
    path = scratch_path(spark, "events")
    t.events.repartition(8, F.xxhash64("event_id")).write.parquet(path)
    return path


PAIRS = (["user_id"], "ts", "event_type", "view", "purchase", ["value"])


def test_pairs_do_not_depend_on_batches_or_order(spark, t):
    path = scratch_path(spark, "pairs")
    stream = s.read_stream(spark, _shuffled_files(t, spark), EVENT_SCHEMA, options=ONE_FILE)
    got = tr.pair_stream(stream, *PAIRS, path, scratch_path(spark, "ckpt"))
    want = _rows(pair_events(t.events, *PAIRS))
    assert _rows(got) == want
    rows, keys = spark.read.parquet(path).count(), t.events.select("user_id").distinct().count()
    assert keys <= rows < 8 * keys  # only changes reach the sink


def test_a_restart_goes_on_with_the_same_state(spark, t):
    landing, path, ckpt = (scratch_path(spark, x) for x in ("landing", "pairs", "ckpt"))
    parts = [t.events.filter("event_type = 'purchase'"), t.events.filter("event_type <> 'purchase' AND user_id % 2 = 0"), t.events.filter("event_type <> 'purchase' AND user_id % 2 = 1")]
    sizes = []
    for part in parts:  # ends come first, so every trip is a correction
        part.write.mode("append").parquet(landing)
        for _ in range(2):  # the second run finds nothing new
            got = tr.pair_stream(s.read_stream(spark, landing, EVENT_SCHEMA), *PAIRS, path, ckpt)
            sizes.append(spark.read.parquet(path).count())
    assert _rows(got) == _rows(pair_events(t.events, *PAIRS))
    assert sizes[0::2] == sizes[1::2]


def test_forgotten_keys_are_corrected_by_late_events(spark, t):
    """Without any idle time every key is forgotten between two runs; late starts and ends still count."""
    landing, path, ckpt = (scratch_path(spark, x) for x in ("landing", "pairs", "ckpt"))
    for keep in ("event_id % 3 = 2", "event_id % 3 = 0", "event_id % 3 = 1"):
        t.events.filter(keep).write.mode("append").parquet(landing)
        got = tr.pair_stream(s.read_stream(spark, landing, EVENT_SCHEMA), *PAIRS, path, ckpt, idle="0 SECONDS")
    assert _rows(got) == _rows(pair_events(t.events, *PAIRS))
    held = spark.read.format("statestore").option("path", ckpt).option("stateVarName", "pair").load()
    assert held.count() < t.events.select("user_id").distinct().count()


def test_state_is_kept_by_shares_of_the_keys(spark):
    """One state and one timer per share, however many keys are open; keys of a share are forgotten each in its time."""
    schema = "user_id long, part string, ts long, event_type string, value double"
    landing, path, ckpt = (scratch_path(spark, x) for x in ("landing", "pairs", "ckpt"))
    want = {}
    for k, (kind, users) in enumerate([("view", range(200)), ("purchase", range(100)), ("purchase", range(50, 300))]):
        rows = [(u if u else None, "a" if u % 2 else None, 10 * k + u % 7, kind, float("nan") if u % 5 == 0 else 0.5 * u) for u in users]
        spark.createDataFrame(rows * 2, schema).write.mode("append").parquet(landing)
        stream = s.read_stream(spark, landing, schema)
        got = tr.pair_stream(stream, ["user_id", "part"], *PAIRS[1:], path, ckpt, shares=4)
        held = spark.read.format("statestore").option("path", ckpt).option("stateVarName", "pair").load()
        for r in rows:
            side = want.setdefault(r[:2], [[], []])[kind == "purchase"]
            side.append(r[2])
    assert held.select("key").distinct().count() <= 4
    assert spark.read.parquet(path).count() <= 550  # a row twice in a batch changes a key once
    pairs = [(*k, min(a), max(b)) for k, (a, b) in want.items() if a and b and max(b) >= min(a)]
    assert sorted(map(tuple, got.select("user_id", "part", "start_ts", "end_ts").collect()), key=str) == sorted(pairs, key=str)
    assert len(pairs) == 200


def test_pairs_of_null_times_and_values(spark):
    rows = [(1, 1, "view", 5.0), (1, None, "view", 1.0), (1, 9, "purchase", None), (1, 9, "purchase", 2.0), (2, 3, "view", 1.0), (3, 4, "purchase", 1.0), (4, 9, "view", 1.0), (4, 2, "purchase", 1.0), (None, 1, "view", 0.0), (None, 2, "purchase", 7.0)]
    schema = "user_id long, ts long, event_type string, value double"
    path = scratch_path(spark, "rows")
    spark.createDataFrame(rows, schema).write.parquet(path)
    got = tr.pair_stream(s.read_stream(spark, path, schema), *PAIRS, scratch_path(spark, "pairs"), scratch_path(spark, "ckpt"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, 1, 5.0, 9, 2.0), (None, 1, 0.0, 2, 7.0)], key=str)


def test_change_feed_in_batches(spark, t):
    log, cols = order_changes(t)
    feed = scratch_path(spark, "feed")
    log.repartition(5).write.parquet(feed)
    base = t.orders.select(*cols)
    stream = s.read_stream(spark, feed, log.schema, options=ONE_FILE)
    got = tr.apply_changes_stream(stream, base, ["o_orderkey"], "op", ["seq"], scratch_path(spark, "state"), scratch_path(spark, "ckpt"))
    assert _rows(got) == _rows(apply_changes(base, log, ["o_orderkey"], "op", ["seq"]))


def test_tumbling_stream_matches_its_batch_form(spark, t):
    sink = scratch_path(spark, "buckets")
    aggs = [F.count("*").alias("n")]
    s.write_stream(s.tumble(s.read_stream(spark, t.stream_path("events"), EVENT_SCHEMA), "ts", 3600, ["event_type"], aggs, "1 hour"), sink, scratch_path(spark, "ckpt"))
    closed = t.events.agg((F.max("ts") - F.expr("INTERVAL 2 HOURS")).alias("m")).first().m
    batch = s.tumble(t.events, "ts", 3600, ["event_type"], aggs).filter(F.col("bucket") <= F.lit(closed))
    assert _rows(spark.read.parquet(sink).select("bucket", "event_type", "n")) == _rows(batch)


def test_restart_appends_only_new_files(spark, t):
    landing, sink, ckpt = (scratch_path(spark, x) for x in ("landing", "sink", "ckpt"))
    for part in (t.events.filter("event_type = 'view'"), t.events.filter("event_type <> 'view'")):
        part.write.mode("append").parquet(landing)
        for _ in range(2):
            s.write_stream(s.read_stream(spark, landing, EVENT_SCHEMA), sink, ckpt)
    assert spark.read.parquet(sink).count() == t.events.count()


def _ordered_files(t, spark, n=6):
    path = scratch_path(spark, "ordered")
    t.events.repartitionByRange(n, "ts").sortWithinPartitions("ts").write.parquet(path)
    return path


def test_last_windows_reach_the_sink(spark, t):
    sink, marks = scratch_path(spark, "buckets"), scratch_path(spark, "marks")
    aggs = [F.count("*").alias("n")]
    stream = s.read_stream(spark, t.stream_path("events"), EVENT_SCHEMA)
    s.write_flushed(stream, "ts", lambda rows: s.tumble(rows, "ts", 3600, ["event_type"], aggs, "1 hour"), sink, scratch_path(spark, "ckpt"), marks, 3 * 3600)
    assert _rows(spark.read.parquet(sink).select("bucket", "event_type", "n")) == _rows(s.tumble(t.events, "ts", 3600, ["event_type"], aggs))


def test_recency_windows_in_batches_and_after_a_restart(spark, t):
    """Files come in order, some per run; the sink has every tick once."""
    landing, sink, ckpt, marks = (scratch_path(spark, x) for x in ("landing", "recency", "ckpt", "marks"))
    spans, slide = {"hour": 3600, "day": 86400}, 1800
    middle = t.events.agg(F.expr("percentile_approx(ts, 0.5)")).first()[0]
    early = t.events.filter(F.col("ts") <= F.lit(middle)).select("event_id", "ts")
    late = t.events.filter(F.col("ts") > F.lit(middle)).select("event_id", "ts")
    early.repartitionByRange(3, "ts").write.mode("append").parquet(landing)
    shape = lambda rows: s.recency_windows(rows, "ts", spans, slide, 600)
    stream = s.read_stream(spark, landing, early.schema)
    spark.createDataFrame([], early.schema).write.parquet(marks)
    s.write_stream(shape(stream.unionByName(s.read_stream(spark, marks, early.schema))), sink, ckpt)
    late.repartitionByRange(3, "ts").write.mode("append").parquet(landing)
    s.write_flushed(stream, "ts", shape, sink, ckpt, marks, 3 * 86400)
    got = {(r.tick, r.span): r.n for r in spark.read.parquet(sink).collect()}
    assert len(got) == spark.read.parquet(sink).count()
    import datetime as dt
    from collections import Counter

    zero, want = dt.datetime(1970, 1, 1), Counter()
    for (ts,) in t.events.select("ts").collect():
        micros = (ts - zero) // dt.timedelta(microseconds=1)
        for name, span in spans.items():
            k = -(-micros // (slide * 10**6))
            while k * slide * 10**6 < micros + span * 10**6:
                want[zero + dt.timedelta(seconds=k * slide), name] += 1
                k += 1
    assert got == dict(want)


def test_flush_of_an_empty_stream(spark):
    schema, path = "event_id long, ts timestamp_ntz", scratch_path(spark, "empty")
    spark.createDataFrame([], schema).write.parquet(path)
    sink = scratch_path(spark, "sink")
    s.write_flushed(s.read_stream(spark, path, schema), "ts", lambda rows: s.recency_windows(rows, "ts", {"a": 60}, 60, 0), sink, scratch_path(spark, "ckpt"), scratch_path(spark, "marks"), 999)
    assert spark.read.schema("tick timestamp_ntz, span string, n long").parquet(sink).count() == 0
