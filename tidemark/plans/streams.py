"""Streaming jobs on the event table: each drains its input, then the sink is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import models as m
from tidemark.plans.aggregates import WINDOWS_SQL, window_report
from tidemark.plans.joins import PAIRS_SQL
from tidemark.plans.registry import query, spark_of
from tidemark.plans.sinks import ORDER_STATE_SQL, order_changes
from tidemark.session import materialize, scratch_path
from tidemark.sources import topic as tp
from tidemark.sources.readers import read_table
from tidemark.sources.tables import write_table
from tidemark.streaming import streams as s, trips as tr

EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def _new(t, label):
    return scratch_path(spark_of(t), label)


def _stream(t):
    return s.read_stream(spark_of(t), t.stream_path("events"), EVENT_SCHEMA)


def _messages(t, where="true"):
    """Events as JSON messages in text files."""
    body = F.to_json(F.struct("event_id", "ts", "user_id", "event_type", "value"), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})
    return t.events.filter(where).select(body.alias("value"))


@query("st01_topic_to_rows", "SELECT event_id, ts, user_id, event_type, value FROM events")
def topic_to_rows(t):
    """Messages of a topic, published in two steps; the second run goes on at the offsets of the first."""
    spark, sink, topic, ckpt = spark_of(t), _new(t, "rows"), _new(t, "topic"), _new(t, "ckpt")
    body = F.to_json(F.struct("event_id", "ts", "user_id", "event_type", "value"), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})
    for where in ("event_type <> 'purchase'", "event_type = 'purchase'"):
        tp.publish(t.events.filter(where), topic, F.col("user_id"), body)
        raw = tp.read_topic_log(spark, topic).select(F.col("value").alias("data"))
        s.write_stream(s.parse_json(raw, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"), sink, ckpt)
    return read_table(spark, sink)


@query("st02_row_enrichment", "SELECT event_id, 1 + (event_id * 7919) % 29120 AS product_id FROM events")
def row_enrichment(t):
    sink = _new(t, "enriched")
    out = _stream(t).select("event_id", (1 + (F.col("event_id") * 7919) % 29120).alias("product_id"))
    s.write_stream(out, sink, _new(t, "ckpt"))
    return read_table(spark_of(t), sink)


@query("st03_append_sink", "SELECT event_type, COUNT(*) AS n, ROUND(SUM(value), 2) AS total FROM events GROUP BY 1")
def append_sink(t):
    """A second start on the same checkpoint finds nothing new and appends nothing."""
    sink, ckpt = _new(t, "append"), _new(t, "ckpt")
    for _ in range(2):
        s.write_stream(_stream(t), sink, ckpt)
    return read_table(spark_of(t), sink).groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("st04_raw_landing", """
SELECT ts::DATE AS arrival_day, hour(ts)::INT AS arrival_hour, COUNT(*) AS messages FROM events GROUP BY 1, 2
""")
def raw_landing(t):
    sink = _new(t, "landing")
    out = _stream(t).select(
        F.to_json(F.struct("event_id", "ts", "user_id", "event_type", "value")).alias("data"),
        F.hour("ts").alias("arrival_hour"), F.to_date("ts").alias("arrival_day"))
    s.write_stream(out, sink, _new(t, "ckpt"), ["arrival_day", "arrival_hour"])
    landed = read_table(spark_of(t), sink, schema="data string, arrival_day date, arrival_hour int")
    return landed.filter("data IS NOT NULL").groupBy("arrival_day", "arrival_hour").agg(F.count("*").alias("messages"))


@query("st05_parse_landed", "SELECT event_id, user_id, event_type, value FROM events")
def parse_landed(t):
    """Messages land in two steps; the second run reads only the new files."""
    spark, landing, sink, ckpt = spark_of(t), _new(t, "landing"), _new(t, "parsed"), _new(t, "ckpt")
    for where in ("ts < TIMESTAMP_NTZ'2024-01-15'", "ts >= TIMESTAMP_NTZ'2024-01-15'"):
        write_table(_messages(t, where), landing, "text", mode="append")
        raw = s.read_stream(spark, landing, "data string", "text")
        s.write_stream(s.parse_json(raw, "event_id bigint, user_id bigint, event_type string, value double"), sink, ckpt)
    return read_table(spark, sink)


@query("st06_tumbling_bucket", """
SELECT make_timestamp((epoch_us(ts) // 180000000) * 180000000) - INTERVAL 5 HOUR AS bucket, event_type, COUNT(*) AS n, ROUND(SUM(value), 2) AS total
FROM events GROUP BY 1, 2
""")
def tumbling_bucket(t):
    """Three-minute buckets in local time; a bucket is final once the watermark has passed its end, the last ones by a flush."""
    sink, aggs = _new(t, "buckets"), [F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total")]
    s.write_flushed(
        _stream(t), "ts", lambda rows: s.tumble(rows, "ts", 180, ["event_type"], aggs, "10 minutes", "America/New_York"),
        sink, _new(t, "ckpt"), _new(t, "marks"), 3600)
    return read_table(spark_of(t), sink)


_SPANS = {"last_6_hours": 21600, "last_hour": 3600, "last_quarter": 900}


@query("st07_recency_windows", " UNION ALL ".join(f"""
SELECT make_timestamp(tick * 900000000) AS tick, '{name}' AS span, COUNT(*) AS n
FROM (SELECT unnest(generate_series((epoch_us(ts) + 899999999) // 900000000, (epoch_us(ts) + {seconds}000000 - 1) // 900000000)) AS tick FROM events) GROUP BY 1""" for name, seconds in _SPANS.items()))
def recency_windows(t):
    """Every quarter of an hour, the events of the last six hours, hour and quarter; the stream's last ticks included."""
    sink = _new(t, "recency")
    s.write_flushed(
        _stream(t).select("event_id", "ts"), "ts", lambda rows: s.recency_windows(rows, "ts", _SPANS, 900, 600),
        sink, _new(t, "ckpt"), _new(t, "marks"), 3 * 86400)
    return read_table(spark_of(t), sink)


@query("st07_recent_counts", """
WITH m AS (SELECT MAX(ts) AS ref FROM events)
SELECT COUNT(*) FILTER (ts > ref - INTERVAL 1 DAY) AS last_day, COUNT(*) FILTER (ts > ref - INTERVAL 1 HOUR) AS last_hour, COUNT(*) FILTER (ts > ref - INTERVAL 15 MINUTE) AS last_quarter FROM events, m
""")
def recent_counts(t):
    sink = _new(t, "recent")
    s.write_stream(_stream(t).select("event_id", "ts"), sink, _new(t, "ckpt"))
    return s.recent_counts(read_table(spark_of(t), sink), "ts", {"last_day": "1 DAY", "last_hour": "1 HOUR", "last_quarter": "15 MINUTES"})


@query("st08_pair_trips", f"SELECT user_id, start_ts, end_ts, amount FROM ({PAIRS_SQL})")
def pair_trips(t):
    pairs = tr.pair_stream(_stream(t), ["user_id"], "ts", "event_type", "view", "purchase", ["value"], _new(t, "pairs"), _new(t, "ckpt"))
    return pairs.select("user_id", "start_ts", "end_ts", F.col("end_value").alias("amount"))


_HAVERSINE = "2 * 6371010.0 * asin(least(1, sqrt(pow(sin(radians(blat - alat) / 2), 2) + cos(radians(alat)) * cos(radians(blat)) * pow(sin(radians(blon - alon) / 2), 2))))"
TRIPS_SQL = f"""
SELECT a.user_id, a.day, a.ts AS start_ts, b.ts AS end_ts, a.id % 25 AS start_zone, b.id % 25 AS end_zone, datediff('microsecond', a.ts, b.ts) // 60000000 AS minutes,
       round_even(b.value::DECIMAL(38,9), 2)::DOUBLE AS amount, round_even(({_HAVERSINE} / 1609.34)::DECIMAL(38,9), 5)::DOUBLE AS distance
FROM (SELECT user_id, ts::DATE AS day, MIN(ts) AS ts, arg_min(event_id, ts) AS id, 30 + (arg_min(event_id, ts) % 97) * 0.17::DOUBLE AS alat, -100 + (arg_min(event_id, ts) % 89) * 0.23::DOUBLE AS alon
      FROM events WHERE event_type = 'view' GROUP BY 1, 2) a
JOIN (SELECT user_id, ts::DATE AS day, MAX(ts) AS ts, arg_max(event_id, ts) AS id, arg_max(value, ts) AS value, 30 + (arg_max(event_id, ts) % 97) * 0.17::DOUBLE AS blat, -100 + (arg_max(event_id, ts) % 89) * 0.23::DOUBLE AS blon
      FROM events WHERE event_type = 'purchase' GROUP BY 1, 2) b USING (user_id, day) WHERE b.ts >= a.ts
"""


def streamed_trips(t):
    """One trip per user and day, with distance, duration, amount and zones."""
    src = _stream(t).withColumns({
        "day": F.to_date("ts"), "lat": 30 + (F.col("event_id") % 97) * 0.17, "lon": -100 + (F.col("event_id") % 89) * 0.23})
    pairs = tr.pair_stream(src, ["user_id", "day"], "ts", "event_type", "view", "purchase", ["event_id", "lat", "lon", "value"], _new(t, "trips"), _new(t, "ckpt"))
    trips = tr.trip_columns(materialize(pairs, "merged-trips"), "ts", "lat", "lon", "value")
    return trips.withColumns({"start_zone": F.col("start_event_id") % 25, "end_zone": F.col("end_event_id") % 25})


@query("st08_trip_columns", f"SELECT user_id, day, start_ts, end_ts, minutes, amount, distance FROM ({TRIPS_SQL})")
def trip_columns(t):
    return streamed_trips(t).select("user_id", "day", "start_ts", "end_ts", "minutes", "amount", "distance")


@query("st09_dashboard", f"""
WITH t AS ({TRIPS_SQL}), m AS (SELECT MAX(start_ts) AS ref FROM t),
f AS (SELECT COUNT(*) AS ride_count, AVG(minutes) AS am, AVG(amount) AS aa, AVG(distance) AS ad FROM t, m WHERE start_ts BETWEEN ref - INTERVAL 10 DAY AND ref),
p AS (SELECT start_zone AS z, COUNT(*) AS n FROM t, m WHERE start_ts BETWEEN ref - INTERVAL 10 DAY AND ref GROUP BY 1 ORDER BY n DESC, z LIMIT 1),
d AS (SELECT end_zone AS z, COUNT(*) AS n FROM t, m WHERE end_ts BETWEEN ref - INTERVAL 10 DAY AND ref GROUP BY 1 ORDER BY n DESC, z LIMIT 1)
SELECT ride_count, round_even(am::DECIMAL(38,9), 2)::DOUBLE AS average_minutes, round_even(aa::DECIMAL(38,9), 2)::DOUBLE AS average_amount,
 round_even(ad::DECIMAL(38,9), 2)::DOUBLE AS average_distance, (SELECT n_name FROM nation, p WHERE n_nationkey = z) AS pickup_zone, (SELECT n FROM p) AS pickup_rides,
 (SELECT n_name FROM nation, d WHERE n_nationkey = z) AS dropoff_zone, (SELECT n FROM d) AS dropoff_rides FROM f
""")
def dashboard(t):
    trips = streamed_trips(t)
    zones = t.nation.select(F.col("n_nationkey").cast("long").alias("n_nationkey"), "n_name")
    return tr.dashboard(trips, zones, "n_nationkey", "n_name", "10 DAYS", trips.agg(F.max("start_ts")).scalar())


@query("st10_window_trend", WINDOWS_SQL)
def window_trend(t):
    sink = _new(t, "trend")
    s.write_stream(_stream(t), sink, _new(t, "ckpt"))
    return window_report(read_table(spark_of(t), sink))


@query("st11_derived_view", """
SELECT event_id, user_id % 10 + 1 AS center, value / 10 AS distance, CASE WHEN event_type = 'view' THEN 0.0 ELSE value END AS amount FROM events
""")
def derived_view(t):
    sink = _new(t, "view")
    out = _stream(t).select("event_id", (F.col("user_id") % 10 + 1).alias("center"), (F.col("value") / 10).alias("distance"),
                            F.when(F.col("event_type") == "view", 0.0).otherwise(F.col("value")).alias("amount"))
    s.write_stream(out, sink, _new(t, "ckpt"))
    return read_table(spark_of(t), sink)


@query("st12_stream_anomalies")
def stream_anomalies(t):
    """Centroids and cut-off come from a model trained on the table; the stream only compares with them."""
    features = ["value", "minute"]
    shaped = t.events.withColumn("minute", F.minute("ts").cast("double"))
    model = m.train_kmeans(shaped, features, 4)
    centroids = [c.tolist() for c in model.stages[-1].clusterCenters()]
    limit = m.nearest_centroid(shaped, centroids, features).agg(F.percentile_approx("distance", 0.95, 10000)).first()[0]
    scored = m.nearest_centroid(_stream(t).withColumn("minute", F.minute("ts").cast("double")), centroids, features)
    sink = _new(t, "anomalies")
    s.write_stream(scored.filter(F.col("distance") > limit).select("event_id", "centroid_id", "distance"), sink, _new(t, "ckpt"))
    return read_table(spark_of(t), sink)


@query("st13_change_stream", ORDER_STATE_SQL)
def change_stream(t):
    log, cols = order_changes(t)
    feed = write_table(log, _new(t, "feed"))
    stream = s.read_stream(spark_of(t), feed, log.schema)
    return tr.apply_changes_stream(stream, t.orders.select(*cols), ["o_orderkey"], "op", ["seq"], _new(t, "state"), _new(t, "ckpt"))
