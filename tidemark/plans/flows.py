"""End-to-end reports and loads, composed of the operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import semantics as sem
from tidemark.operators import aggregates as ag, joins as j, quality as q, relational as rel, text as tx
from tidemark.plans.aggregates import HIST_SQL, _WEEK_SQL, habits_sql, with_habits
from tidemark.plans.joins import NEAREST_SQL, event_points, is_demand, stock_moves, supplier_points
from tidemark.plans.learning import NEGATIVE, POSITIVE, SENTIMENT_SQL
from tidemark.plans.projections import DETECTIONS_SQL, detections
from tidemark.plans.registry import query, spark_of
from tidemark.plans.sinks import ORDER_STATE_SQL, order_changes
from tidemark.session import materialize, scratch_path
from tidemark.sources import changes as ch
from tidemark.sources.readers import latest_by, read_table
from tidemark.sources.tables import write_clustered, write_table


def order_facts(t):
    """Orders with their customer and nation."""
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))


@query("pl01_high_value_orders", """
SELECT dayofweek(o_orderdate)::INT AS weekday_number, dayname(o_orderdate) AS weekday, c_mktsegment AS segment, COUNT(*) AS orders, ROUND(SUM(o_totalprice), 2) AS total, ROUND(AVG(o_totalprice), 4) AS average
FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey WHERE o_totalprice > 20000 GROUP BY 1, 2, 3 HAVING SUM(o_totalprice) > 1000 ORDER BY 1, 3
""")
def high_value_orders(t):
    facts = t.orders.filter("o_totalprice > 20000").join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return (
        facts.groupBy((F.dayofweek("o_orderdate") - 1).alias("weekday_number"), F.date_format("o_orderdate", "EEEE").alias("weekday"), F.col("c_mktsegment").alias("segment"))
        .agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"), F.round(F.avg("o_totalprice"), 4).alias("average"))
        .filter("total > 1000").orderBy("weekday_number", "segment")
    )


_MEASURES = ["orders", "average_lines", "price", "discount", "tax"]


@query("pl02_weekly_report", f"""
WITH l AS (SELECT l_orderkey, COUNT(*) AS lines, SUM(l_extendedprice) AS price, SUM(l_extendedprice * l_discount) AS discount, SUM(l_extendedprice * l_tax) AS tax FROM lineitem GROUP BY 1),
w AS (SELECT o_orderstatus AS company, year(o_orderdate)::INT AS year, {_WEEK_SQL} AS week, COUNT(*) AS orders, ROUND(AVG(lines), 6) AS average_lines, ROUND(SUM(price), 2) AS price, ROUND(SUM(discount), 4) AS discount, ROUND(SUM(tax), 4) AS tax
  FROM orders JOIN l ON l_orderkey = o_orderkey GROUP BY 1, 2, 3)
SELECT *, 'Week ' || lpad(week::VARCHAR, 2, '0') AS week_name, company || ':' || year || ':' || lpad(week::VARCHAR, 2, '0') AS group_partition,
 {', '.join(f"LAG({m}) OVER k AS prior_{m}" for m in _MEASURES)}, {', '.join(f"ROUND(({m} - LAG({m}) OVER k)::DOUBLE / nullif(LAG({m}) OVER k, 0)::DOUBLE, 6) AS change_{m}" for m in _MEASURES)}
FROM w WINDOW k AS (PARTITION BY company ORDER BY year, week)
""")
def weekly_report(t):
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count("*").alias("lines"), F.sum("l_extendedprice").alias("price"),
        F.sum(F.col("l_extendedprice") * F.col("l_discount")).alias("discount"), F.sum(F.col("l_extendedprice") * F.col("l_tax")).alias("tax"))
    weekly = t.orders.join(lines, "o_orderkey").groupBy(
        F.col("o_orderstatus").alias("company"), F.year("o_orderdate").alias("year"), sem.week_number(F.col("o_orderdate")).alias("week")
    ).agg(F.count("*").alias("orders"), F.round(F.avg("lines"), 6).alias("average_lines"), F.round(F.sum("price"), 2).alias("price"),
          F.round(F.sum("discount"), 4).alias("discount"), F.round(F.sum("tax"), 4).alias("tax"))
    out = ag.period_change(weekly, ["company"], ["year", "week"], _MEASURES)
    two = F.lpad(F.col("week").cast("string"), 2, "0")
    return out.withColumns({
        "week_name": F.concat(F.lit("Week "), two), "group_partition": F.concat_ws(":", "company", "year", two),
        **{f"change_{m}": F.round(f"change_{m}", 6) for m in _MEASURES}})


SPREAD, SPREAD_ABOVE = [(2, "focused"), (12, "varied")], "broad"  # own bands of how many places
HOME_SHARE = [(0.1, "rare"), (0.3, "some")]  # own bands of the share of trips in one region


def spread_sql(n):
    return "CASE " + " ".join(f"WHEN {n} <= {bound} THEN '{name}'" for bound, name in SPREAD) + f" ELSE '{SPREAD_ABOVE}' END"


_SUPPLIER_HIST = HIST_SQL.replace("user_id", "l_suppkey").replace("FROM events", "FROM trips").replace("(ts)", "(ts)")


@query("pl03_behaviour_profile", f"""
WITH trips AS (SELECT l_suppkey, l_shipdate + to_minutes(l_partkey % 1440) AS ts, c_nationkey AS pickup, p_type AS dropoff, l_extendedprice AS amount, n_regionkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN part ON p_partkey = l_partkey),
h AS ({_SUPPLIER_HIST}),
p AS (SELECT l_suppkey, COUNT(DISTINCT pickup) AS pickups, COUNT(DISTINCT dropoff) AS dropoffs, COUNT(*) FILTER (n_regionkey = 1) AS region_trips FROM trips GROUP BY 1),
z AS (SELECT l_suppkey, string_agg(dropoff, ', ' ORDER BY n DESC, dropoff) AS top_zones FROM (SELECT l_suppkey, dropoff, COUNT(*) AS n FROM trips GROUP BY 1, 2 QUALIFY ROW_NUMBER() OVER (PARTITION BY l_suppkey ORDER BY COUNT(*) DESC, dropoff) <= 5) GROUP BY 1),
s AS (SELECT l_suppkey, AVG(d) AS average_daily, stddev_samp(d) AS stddev_daily FROM (SELECT l_suppkey, ts::DATE AS day, SUM(amount) AS d FROM trips GROUP BY 1, 2) GROUP BY 1 HAVING stddev_samp(d) < 37000)
SELECT h.l_suppkey AS driver, pickups, dropoffs, {spread_sql('pickups')} AS pickup_spread, {spread_sql('dropoffs')} AS dropoff_spread, top_zones,
 CASE WHEN region_trips / total <= 0.1 THEN 'rare' WHEN region_trips / total <= 0.3 THEN 'some' ELSE 'often' END AS region_habit,
 {habits_sql()}, ROUND(average_daily, 4) AS average_daily, ROUND(stddev_daily, 4) AS stddev_daily
FROM h JOIN p USING (l_suppkey) JOIN z USING (l_suppkey) LEFT JOIN s USING (l_suppkey)
""")
def behaviour_profile(t):
    """Suppliers as drivers, lines as trips: where, when and how steadily they work."""
    trips = (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .select(F.col("l_suppkey").alias("driver"), F.timestamp_add("MINUTE", F.col("l_partkey") % 1440, "l_shipdate").cast("timestamp_ntz").alias("ts"),
                F.col("c_nationkey").alias("pickup"), F.col("p_type").alias("dropoff"), F.col("l_extendedprice").alias("amount"), "n_regionkey")
    )
    # four roll-ups share one join, so it is written once
    trips = materialize(trips, "trips")
    habits = with_habits(ag.time_histogram(trips, ["driver"], "ts")).select("driver", "total", "week_part", "day_part")
    places = trips.groupBy("driver").agg(
        F.count_distinct("pickup").alias("pickups"), F.count_distinct("dropoff").alias("dropoffs"), F.count_if(F.col("n_regionkey") == 1).alias("region_trips"))
    often = ag.top_per_group(trips.groupBy("driver", "dropoff").agg(F.count("*").alias("n")), ["driver"], [F.desc("n"), F.asc("dropoff")], 5)
    zones = often.groupBy("driver").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "dropoff"))), lambda x: x["dropoff"]), ", ").alias("top_zones"))
    steady = ag.steady_entities(trips, "driver", F.to_date("ts"), F.col("amount"), 37000)
    return habits.join(places, "driver").join(zones, "driver").join(steady, "driver", "left").select(
        "driver", "pickups", "dropoffs", ag.band_label(F.col("pickups"), SPREAD, SPREAD_ABOVE).alias("pickup_spread"),
        ag.band_label(F.col("dropoffs"), SPREAD, SPREAD_ABOVE).alias("dropoff_spread"), "top_zones",
        ag.band_label(F.col("region_trips") / F.col("total"), HOME_SHARE, "often").alias("region_habit"),
        "week_part", "day_part", F.round("average_daily", 4).alias("average_daily"), F.round("stddev_daily", 4).alias("stddev_daily"))


@query("pl04_delivery_shortage", """
WITH l AS (SELECT l_linestatus, s_nationkey AS center, p_type AS product, l_shipdate::DATE AS day, SUM(l_quantity) AS qty FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey GROUP BY 1, 2, 3, 4),
d AS (SELECT center, product, day, SUM(qty) OVER (PARTITION BY center, product ORDER BY day) AS required FROM l WHERE l_linestatus = 'O'),
s AS (SELECT center, product, day, SUM(qty) OVER (PARTITION BY center, product ORDER BY day) AS available FROM l WHERE l_linestatus = 'F')
SELECT day, n_name AS distribution_center, CASE WHEN length(product || ' of ' || n_name) > 12 THEN left(product || ' of ' || n_name, 12) || '...' ELSE product || ' of ' || n_name END AS product_name,
 required AS quantity_required, available AS quantity_available, available - required AS in_stock_qty,
 CASE WHEN available < required THEN 'short' WHEN available - required <= 15 THEN 'tight' ELSE 'covered' END AS stock_status
FROM d JOIN s USING (center, product, day) JOIN nation ON n_nationkey = center WHERE available - required <= 20
""")
def delivery_shortage(t):
    gaps = j.supply_gap(stock_moves(t), is_demand(), ["center", "product"], "day", "qty", 20).join(t.nation, F.col("center") == F.col("n_nationkey"))
    stock = F.col("in_stock")
    status = rel.score_rules([(stock < 0, "short"), (stock <= 15, "tight")], "covered")
    return gaps.select(
        "day", F.col("n_name").alias("distribution_center"), rel.shorten(F.concat("product", F.lit(" of "), "n_name"), 12).alias("product_name"),
        F.col("required").alias("quantity_required"), F.col("available").alias("quantity_available"), stock.alias("in_stock_qty"), status.alias("stock_status"))


@query("pl05_order_normalisation", """
WITH f AS (SELECT l_linenumber, l_orderkey * 10 + l_linenumber AS transaction_id, o_custkey AS customer_id, o_orderdate::DATE AS order_date, (l_orderkey % 86400) AS order_time, o_orderpriority AS region, p_partkey, l_quantity, l_extendedprice
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey)
SELECT 'header' AS kind, MIN(transaction_id) AS order_id, customer_id, order_date + to_seconds(order_time) AS order_datetime, arg_min(region, transaction_id) AS region, NULL::BIGINT AS product_id, NULL::DOUBLE AS quantity, NULL::DOUBLE AS price
 FROM f GROUP BY customer_id, order_date, order_time
UNION ALL SELECT 'detail', transaction_id, NULL, NULL, NULL, p_partkey, l_quantity, l_extendedprice FROM f
""")
def order_normalisation(t):
    """Flat transactions become headers (one per customer and instant) and details with product ids."""
    products = t.part.select(F.col("p_partkey").alias("product_id"), F.concat("p_name", F.lit("/"), F.col("p_partkey").cast("string")).alias("product"))
    flat = (
        t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey")).join(products, F.col("l_partkey") == F.col("product_id"))
        .select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("transaction_id"), F.col("o_custkey").alias("customer_id"),
                F.to_date("o_orderdate").alias("order_date"), (F.col("l_orderkey") % 86400).alias("order_time"), F.col("o_orderpriority").alias("region"),
                "product", F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"))
    )
    header = ag.first_by(flat, ["customer_id", "order_date", "order_time"], "transaction_id", {"transaction_id": "order_id", "region": "region"})
    header = header.withColumn("order_datetime", F.timestamp_add("SECOND", "order_time", F.col("order_date").cast("timestamp_ntz")).cast("timestamp_ntz"))
    detail = flat.join(products, "product", "left").select(F.col("transaction_id").alias("order_id"), "product_id", "quantity", "price")
    return rel.union_padded({"header": header.drop("order_date", "order_time"), "detail": detail}, "kind")


@query("pl06_sales_mart", """
SELECT l_orderkey, l_linenumber, o_orderdate, c_name, n_name, p_name, p_brand, s_name, l_quantity, l_extendedprice, ROUND(l_extendedprice * (1 - l_discount), 4) AS net
FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN supplier ON s_suppkey = l_suppkey
""")
def sales_mart(t):
    return (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(t.part, F.col("l_partkey") == F.col("p_partkey"), "left")
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left")
        .select("l_orderkey", "l_linenumber", "o_orderdate", "c_name", "n_name", "p_name", "p_brand", "s_name", "l_quantity", "l_extendedprice",
                F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4).alias("net"))
    )


@query("pl07_detection_counts", f"""
SELECT doc_id, COUNT(*) FILTER (name IN ('en', 'fr')) AS western, COUNT(*) FILTER (name = 'good') AS good, ROUND(AVG(score), 9) AS mean_score, COUNT(*) AS detections FROM ({DETECTIONS_SQL}) GROUP BY 1
""")
def detection_counts(t):
    return detections(t).groupBy("doc_id").agg(
        F.count_if(F.col("name").isin("en", "fr")).alias("western"), F.count_if(F.col("name") == "good").alias("good"),
        F.round(F.avg("score"), 9).alias("mean_score"), F.count("*").alias("detections"))


@query("pl08_feature_table", """
WITH r AS (SELECT user_id % 25 AS zone, ts::DATE AS day, event_type, MAX(value) AS value FROM events GROUP BY 1, 2, 3),
c AS (SELECT conv_id % 25 AS zone, COUNT(*) AS cnt FROM conversations GROUP BY 1)
SELECT event_id, (e.user_id % 25)::VARCHAR AS location_id, year(ts)::VARCHAR AS pickup_year, month(ts)::VARCHAR AS pickup_month, (dayofweek(ts) + 1)::VARCHAR AS pickup_day_of_week, hour(ts)::VARCHAR AS pickup_hour,
 CASE WHEN e.value < 20 THEN 'short' WHEN e.value < 60 THEN 'medium' ELSE 'long' END AS ride_distance, COALESCE(a.value, 0) > 50 AS is_raining, COALESCE(b.value, 0) > 50 AS is_snowing, COALESCE(cnt, 0)::VARCHAR AS people_cnt,
 CASE WHEN e.value > 150 AND length(props) > 8 THEN 1 WHEN e.value > 100 THEN 1 ELSE 0 END AS is_high_value
FROM events e JOIN nation ON n_nationkey = e.user_id % 25 LEFT JOIN r a ON a.zone = e.user_id % 25 AND a.day = ts::DATE AND a.event_type = 'error'
LEFT JOIN r b ON b.zone = e.user_id % 25 AND b.day = ts::DATE AND b.event_type = 'signup' LEFT JOIN c ON c.zone = e.user_id % 25
""")
def feature_table(t):
    """Trips joined to daily weather of their zone (two elements of one long table) and people counts."""
    weather = t.events.groupBy((F.col("user_id") % 25).alias("zone"), F.to_date("ts").alias("day")).agg(
        F.max(F.when(F.col("event_type") == "error", F.col("value"))).alias("rain"),
        F.max(F.when(F.col("event_type") == "signup", F.col("value"))).alias("snow"))
    people = t.conversations.groupBy((F.col("conv_id") % 25).alias("zone")).agg(F.count("*").alias("cnt"))
    trips = t.events.withColumns({"zone": F.col("user_id") % 25, "day": F.to_date("ts")}).join(
        t.nation.select(F.col("n_nationkey").cast("long").alias("zone"), "n_name"), "zone")
    v = F.col("value")
    return trips.join(weather, ["zone", "day"], "left").join(people, "zone", "left").select(
        "event_id", F.col("zone").cast("string").alias("location_id"), F.year("ts").cast("string").alias("pickup_year"), F.month("ts").cast("string").alias("pickup_month"),
        F.dayofweek("ts").cast("string").alias("pickup_day_of_week"), F.hour("ts").cast("string").alias("pickup_hour"),
        F.when(v < 20, "short").when(v < 60, "medium").otherwise("long").alias("ride_distance"),
        (F.coalesce("rain", F.lit(0.0)) > 50).alias("is_raining"), (F.coalesce("snow", F.lit(0.0)) > 50).alias("is_snowing"),
        F.coalesce("cnt", F.lit(0)).cast("string").alias("people_cnt"),
        rel.score_rules([((v > 150) & (F.length("props") > 8), 1), (v > 100, 1)], 0).alias("is_high_value"))


_WEATHER = "value / 5 - 20 AS c, sqrt(pow((event_id % 17)::DOUBLE, 2) + pow((event_id % 11)::DOUBLE, 2)) * 2.23694 AS w, 30 + (user_id % 60)::DOUBLE AS h"


@query("pl09_nearest_weather", f"""
WITH n AS ({NEAREST_SQL.strip()}),
o AS (SELECT n.s_suppkey, e.ts, e.event_id, {_WEATHER} FROM n JOIN events e USING (event_id)),
k AS (SELECT *, c * 9 / 5 + 32 AS f FROM o QUALIFY ROW_NUMBER() OVER (PARTITION BY s_suppkey, date_trunc('hour', ts) ORDER BY ts, event_id) = 1)
SELECT s_suppkey, date_trunc('hour', ts) AS hour, ROUND(f, 4) AS temperature_f, ROUND(w, 4) AS wind_mph,
 CASE WHEN f > 80 AND h > 60 THEN 'sultry' WHEN w > 12 THEN 'breezy' ELSE 'calm' END AS description,
 ROUND(CASE WHEN f < 50 AND w > 3 THEN 35.74 + 0.6215 * f - 35.75 * pow(w, 0.16) + 0.4275 * f * pow(w, 0.16)
  WHEN f > 80 AND h > 40 THEN -42.379 + 2.04901523 * f + 10.14333127 * h - 0.22475541 * f * h - 0.00683783 * f * f - 0.05481717 * h * h + 0.00122874 * f * f * h + 0.00085282 * f * h * h - 0.00000199 * f * f * h * h
  ELSE f END, 4) AS feels_like_f, hour(ts) BETWEEN 7 AND 19 AS is_day FROM k
""")
def nearest_weather(t):
    """Observations go to their nearest station; the first one of each hour gives that hour's weather."""
    near = j.nearest(event_points(t), supplier_points(t), "s_suppkey", "lat", "lon", 100)
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    first = latest_by(near.withColumn("hour", hour), ["s_suppkey", "hour"], [F.asc("ts"), F.asc("event_id")])
    wind = rel.wind_speed_mph((F.col("event_id") % 17).cast("double"), (F.col("event_id") % 11).cast("double"))
    temp, humid = rel.fahrenheit(F.col("value") / 5 - 20), 30 + (F.col("user_id") % 60).cast("double")
    text = rel.score_rules([((temp > 80) & (humid > 60), "sultry"), (wind > 12, "breezy")], "calm")
    return first.select("s_suppkey", "hour", F.round(temp, 4).alias("temperature_f"), F.round(wind, 4).alias("wind_mph"), text.alias("description"),
                        F.round(rel.feels_like(temp, wind, humid), 4).alias("feels_like_f"), F.hour("ts").between(7, 19).alias("is_day"))


@query("pl10_cost_comparison", """
WITH jobs AS (SELECT event_type AS project, month(ts)::INT AS month, event_id, day(ts) * 1440 + hour(ts) * 60 + minute(ts) AS lo, day(ts) * 1440 + hour(ts) * 60 + minute(ts) + 10 + event_id % 50 AS hi, value::DECIMAL(28,6) AS slots, value * 10 AS cost FROM events),
m AS (SELECT project, month, unnest(generate_series(lo, hi)) AS minute, slots FROM jobs),
p AS (SELECT project, month, minute, floor((floor(SUM(slots) + 0.5) + 99) / 100) * 100 AS rounded FROM m GROUP BY 1, 2, 3),
s AS (SELECT project, month, floor(0.060 * floor((SUM(rounded) + 99) / 100) + 0.5)::BIGINT AS slot_cost FROM p GROUP BY 1, 2),
d AS (SELECT project, month, floor(SUM(cost) + 0.5)::BIGINT AS on_demand_cost FROM jobs GROUP BY 1, 2)
SELECT project, month, on_demand_cost, slot_cost, on_demand_cost - slot_cost AS savings, repeat('$', ((on_demand_cost - slot_cost) // 20000)::INT) AS bar FROM d JOIN s USING (project, month) WHERE on_demand_cost > slot_cost * 2
""")
def cost_comparison(t):
    """Pay per query against slots bought by the minute in steps of one hundred."""
    minute = F.dayofmonth("ts") * 1440 + F.hour("ts") * 60 + F.minute("ts")
    jobs = t.events.select(
        F.col("event_type").alias("project"), F.month("ts").alias("month"), minute.cast("long").alias("lo"),
        (minute + 10 + F.col("event_id") % 50).cast("long").alias("hi"), F.col("value").alias("slots"), (F.col("value") * 10).alias("cost"))
    load = j.interval_load(jobs, ["project", "month"], "lo", "hi", "slots")
    rounded = F.floor((F.floor(F.col("total") + F.lit("0.5").cast("decimal(2,1)")) + 99) / 100) * 100
    slots = load.groupBy("project", "month").agg(sem.round_to_long(0.060 * F.floor((F.sum(rounded) + 99) / 100)).alias("slot_cost"))
    paid = jobs.groupBy("project", "month").agg(sem.round_to_long(F.sum("cost")).alias("on_demand_cost"))
    saved = F.col("on_demand_cost") - F.col("slot_cost")
    return paid.join(slots, ["project", "month"]).filter("on_demand_cost > slot_cost * 2").withColumns({
        "savings": saved, "bar": F.repeat(F.lit("$"), F.floor(saved / 20000).cast("int"))})


@query("pl11_json_rides_summary", """
SELECT r_name AS region, COUNT(*) AS rides, ROUND(AVG(top), 6) AS mean_top, SUM(minutes)::BIGINT AS minutes FROM
 (SELECT user_id, MAX(value) AS top, datediff('microsecond', MIN(ts), MAX(ts)) // 60000000 AS minutes FROM events GROUP BY 1) JOIN region ON r_regionkey = user_id % 5 GROUP BY 1
""")
def json_rides_summary(t):
    """JSON events to typed rows, rows to rides, rides to a summary by looked-up region; keys asserted on the way."""
    body = F.to_json(F.struct("user_id", "ts", "value"), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})
    typed = t.events.select(body.alias("data")).select(F.from_json("data", "user_id bigint, ts timestamp_ntz, value double").alias("m")).select("m.*")
    rides = materialize(ag.envelope(typed, ["user_id"], "ts", ["value"]), "rides")
    bad = q.key_check(rides, ["user_id"]).first()
    if bad["repeated_keys"] or bad["null_key_rows"]:
        raise ValueError("ride key is not unique")
    region = t.region.select(F.col("r_regionkey").cast("long").alias("k"), F.col("r_name").alias("region"))
    return rides.withColumn("k", F.col("user_id") % 5).join(region, "k").groupBy("region").agg(
        F.count("*").alias("rides"), F.round(F.avg("max_value"), 6).alias("mean_top"), F.sum("minutes").alias("minutes"))


@query("pl12_lakehouse_load", """
SELECT o_orderkey, o_orderdate::DATE AS partition_date, round_even(o_totalprice::DECIMAL(38,9), 1)::DOUBLE AS total, c_name, n_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON n_nationkey = c_nationkey
""")
def lakehouse_load(t):
    """Raw files in three formats, an enriched zone with types, and a curated zone rounded and clustered by date."""
    spark = spark_of(t)
    raw = scratch_path(spark, "raw")
    write_table(t.orders, f"{raw}/orders", "json")
    write_table(t.customer, f"{raw}/customer", "csv", options={"sep": "|"})
    write_table(t.nation, f"{raw}/nation", "parquet")
    orders = read_table(spark, f"{raw}/orders", "json", t.orders.schema).withColumn("partition_date", F.to_date("o_orderdate"))
    customers = read_table(spark, f"{raw}/customer", "csv", t.customer.schema, {"sep": "|"})
    enriched = read_table(spark, write_table(orders, scratch_path(spark, "enriched")))
    wide = enriched.join(customers, F.col("o_custkey") == F.col("c_custkey")).join(
        read_table(spark, f"{raw}/nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    curated = wide.select("o_orderkey", "partition_date", sem.half_even(F.col("o_totalprice"), 1).alias("total"), "c_name", "n_name")
    return read_table(spark, write_clustered(curated, scratch_path(spark, "curated"), ["partition_date"]))


@query("pl13_change_feed_ratings", f"""
WITH s AS ({ORDER_STATE_SQL}), r AS (SELECT o_custkey, ROUND(AVG(o_totalprice), 4) AS average FROM s GROUP BY 1)
SELECT o.o_orderkey, o.o_orderpriority, s.o_orderstatus AS state, c_name, average FROM s JOIN orders o ON o.o_custkey = s.o_custkey AND o.o_orderkey = s.o_orderkey AND o.o_totalprice::VARCHAR = (CASE WHEN s.o_orderstatus = 'P' AND s.o_orderkey >= 0 THEN s.o_totalprice - 1 ELSE s.o_totalprice END)::VARCHAR
LEFT JOIN r ON r.o_custkey = s.o_custkey LEFT JOIN customer ON c_custkey = s.o_custkey WHERE s.o_orderstatus <> 'P'
""")
def change_feed_ratings(t):
    """Latest state of a change feed matched to the warehouse on several keys, with an average per customer."""
    log, cols = order_changes(t)
    state = materialize(ch.apply_changes(t.orders.select(*cols), log, ["o_orderkey"], "op", ["seq"]), "state")
    rating = state.groupBy("o_custkey").agg(F.round(F.avg("o_totalprice"), 4).alias("average"))
    warehouse = t.orders.select(F.col("o_orderkey").alias("w_key"), F.col("o_custkey").alias("w_cust"), F.col("o_totalprice").alias("w_price"), "o_orderpriority")
    matched = j.match_on(state.filter("o_orderstatus <> 'P'"), warehouse, [
        (F.col("o_orderkey"), F.col("w_key")), (F.col("o_custkey"), F.col("w_cust")),
        (F.col("o_totalprice").cast("string"), F.col("w_price").cast("string"))])
    return matched.join(rating, "o_custkey", "left").join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        "o_orderkey", "o_orderpriority", F.col("o_orderstatus").alias("state"), "c_name", "average")


@query("pl14_surrogate_dimensions", """
WITH c AS (SELECT p_type, ROW_NUMBER() OVER (ORDER BY p_type) AS category_id FROM (SELECT DISTINCT p_type FROM part)),
p AS (SELECT DISTINCT p_name, p_brand, p_type FROM part)
SELECT p_name, p_brand, category_id, ROW_NUMBER() OVER (ORDER BY p_name, p_brand, p_type) AS product_id FROM p JOIN c USING (p_type)
""")
def surrogate_dimensions(t):
    categories = rel.add_surrogate_key(t.part.select("p_type").distinct(), [F.asc("p_type")], "category_id")
    products = t.part.select("p_name", "p_brand", "p_type").distinct()
    keyed = rel.add_surrogate_key(products, [F.asc("p_name"), F.asc("p_brand"), F.asc("p_type")], "product_id")
    return keyed.join(categories, "p_type").select("p_name", "p_brand", "category_id", "product_id")


@query("pl15_entity_mart", f"""
WITH t AS (SELECT user_id, COUNT(*) AS trips, ROUND(AVG(value), 6) AS average, ROUND(SUM(value), 2) AS total FROM events GROUP BY 1),
r AS (SELECT conv_id AS user_id, COUNT(*) FILTER (s = 'positive') AS positive_count, COUNT(*) FILTER (s = 'neutral') AS neutral_count, COUNT(*) FILTER (s = 'negative') AS negative_count
  FROM (SELECT conv_id, {SENTIMENT_SQL} AS s FROM conversations) GROUP BY 1)
SELECT c_custkey, c_name, COALESCE(trips, 0) AS trips, average, total, COALESCE(positive_count, 0) AS positive_count, COALESCE(neutral_count, 0) AS neutral_count, COALESCE(negative_count, 0) AS negative_count
FROM customer LEFT JOIN t ON t.user_id = c_custkey LEFT JOIN r ON r.user_id = c_custkey
""")
def entity_mart(t):
    trips = t.events.groupBy(F.col("user_id").alias("c_custkey")).agg(
        F.count("*").alias("trips"), F.round(F.avg("value"), 6).alias("average"), F.round(F.sum("value"), 2).alias("total"))
    labelled = t.conversations.select(F.col("conv_id").alias("c_custkey"), tx.sentiment(F.col("text"), POSITIVE, NEGATIVE).alias("answer"))
    reviews = tx.label_rollup(labelled, ["c_custkey"], "answer", ["positive", "neutral", "negative"])
    counts = ["trips", "positive_count", "neutral_count", "negative_count"]
    return t.customer.select("c_custkey", "c_name").join(trips, "c_custkey", "left").join(reviews, "c_custkey", "left").fillna(0, counts)
