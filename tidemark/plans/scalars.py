"""Scalar function families, each over a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import geo, jsons, semantics as sem
from tidemark.plans.joins import POINT_SQL, event_points
from tidemark.plans.registry import query, spark_of


@query("fn_s1_concat", "SELECT c_custkey, c_name || ':' || c_mktsegment AS label FROM customer")
def s1(t):
    return t.customer.select("c_custkey", F.concat("c_name", F.lit(":"), "c_mktsegment").alias("label"))


@query("fn_s2_substr_length", "SELECT doc_id, substr(text, 3, 10) AS part, length(text)::INT AS size FROM documents")
def s2(t):
    return t.documents.select("doc_id", F.substring("text", 3, 10).alias("part"), F.length("text").alias("size"))


@query("fn_s3_case_trim", "SELECT p_partkey, upper(p_name) AS up, lower(p_type) AS low, trim('  ' || p_brand || ' ') AS brand FROM part")
def s3(t):
    return t.part.select("p_partkey", F.upper("p_name").alias("up"), F.lower("p_type").alias("low"),
                         F.trim(F.concat(F.lit("  "), "p_brand", F.lit(" "))).alias("brand"))


@query("fn_s4_replace", "SELECT o_orderkey, replace(replace(o_orderpriority, '-', ':'), 'NOT SPECIFIED', 'NONE') AS priority FROM orders")
def s4(t):
    inner = F.replace(F.col("o_orderpriority"), F.lit("-"), F.lit(":"))
    return t.orders.select("o_orderkey", F.replace(inner, F.lit("NOT SPECIFIED"), F.lit("NONE")).alias("priority"))


@query("fn_s5_split_unnest", "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part")
def s5(t):
    return t.part.select("p_partkey", F.explode(F.split("p_name", " ")).alias("word"))


@query("fn_s6_prefix_suffix_like", """
SELECT p_partkey, starts_with(p_name, 'red') AS is_red, ends_with(p_name, 'ring') AS is_ring, p_type LIKE '%O%' AS has_o FROM part
""")
def s6(t):
    return t.part.select("p_partkey", F.startswith("p_name", F.lit("red")).alias("is_red"), F.endswith("p_name", F.lit("ring")).alias("is_ring"),
                         F.col("p_type").like("%O%").alias("has_o"))


@query("fn_s7_regex", r"""
SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host, regexp_matches(url, '[?&]page=[0-9]+') AS paged FROM pages
""")
def s7(t):
    return t.pages.select("page_id", F.regexp_extract("url", "^https?://([^/?#]+)", 1).alias("host"), F.col("url").rlike("[?&]page=[0-9]+").alias("paged"))


@query("fn_s8_format", """
SELECT o_orderkey, format('{:,}', floor(o_totalprice)::BIGINT) AS thousands, lpad(month(o_orderdate)::VARCHAR, 2, '0') AS month,
       printf('%.2f', o_totalprice) AS money, 'order ' || o_orderkey || ' of ' || o_custkey AS label FROM orders
""")
def s8(t):
    return t.orders.select(
        "o_orderkey", F.format_number(F.floor("o_totalprice"), 0).alias("thousands"),
        F.lpad(F.month("o_orderdate").cast("string"), 2, "0").alias("month"),
        F.format_string("%.2f", "o_totalprice").alias("money"), F.format_string("order %d of %d", "o_orderkey", "o_custkey").alias("label"))


@query("fn_s9_money_text", "SELECT o_orderkey, '$' || format('{:,}', floor(o_totalprice)::BIGINT) AS money FROM orders")
def s9(t):
    return t.orders.select("o_orderkey", F.concat(F.lit("$"), F.format_number(F.floor("o_totalprice"), 0)).alias("money"))


@query("fn_s10_repeat_join", "SELECT n_regionkey, repeat('=', COUNT(*)::INT) AS bar, array_to_string(list_sort(list(n_name)), ', ') AS names FROM nation GROUP BY 1")
def s10(t):
    return t.nation.groupBy("n_regionkey").agg(
        F.repeat(F.lit("="), F.count("*").cast("int")).alias("bar"), F.array_join(F.array_sort(F.collect_list("n_name")), ", ").alias("names"))


@query("fn_s11_base64", "SELECT c_custkey, base64(c_name::BLOB) AS encoded, from_base64(base64(c_name::BLOB))::VARCHAR AS decoded FROM customer")
def s11(t):
    enc = F.base64(F.encode("c_name", "UTF-8"))
    return t.customer.select("c_custkey", enc.alias("encoded"), F.decode(F.unbase64(enc), "UTF-8").alias("decoded"))


@query("fn_d1_format_date", """
SELECT o_orderkey, dayofweek(o_orderdate)::INT AS w, dayname(o_orderdate) AS weekday, monthname(o_orderdate) AS month_name, strftime(o_orderdate, '%m') AS month FROM orders
""")
def d1(t):
    d = F.col("o_orderdate")
    return t.orders.select("o_orderkey", (F.dayofweek(d) - 1).alias("w"), F.date_format(d, "EEEE").alias("weekday"),
                           F.date_format(d, "MMMM").alias("month_name"), F.date_format(d, "MM").alias("month"))


@query("fn_d2_extract", """
SELECT event_id, year(ts)::INT AS y, month(ts)::INT AS mo, day(ts)::INT AS d, hour(ts)::INT AS h, minute(ts)::INT AS mi, (dayofweek(ts) + 1)::INT AS dow,
       dayofyear(ts)::INT AS doy, ((dayofyear(ts) + 7 - (dayofweek(ts) + 1)) // 7)::INT AS week FROM events
""")
def d2(t):
    ts = F.col("ts")
    return t.events.select("event_id", F.year(ts).alias("y"), F.month(ts).alias("mo"), F.dayofmonth(ts).alias("d"), F.hour(ts).alias("h"),
                           F.minute(ts).alias("mi"), F.dayofweek(ts).alias("dow"), F.dayofyear(ts).alias("doy"), sem.week_number(ts).alias("week"))


@query("fn_d3_diffs", """
SELECT l_orderkey, l_linenumber, l_partkey, datediff('day', o_orderdate, l_shipdate) AS days, (epoch(ts2) - epoch(o_orderdate))::BIGINT // 3600 AS hours,
       datediff('hour', o_orderdate, ts2) AS hour_marks
FROM (SELECT *, l_shipdate + to_minutes(l_partkey % 1440) AS ts2 FROM lineitem JOIN orders ON l_orderkey = o_orderkey) WHERE l_shipdate >= o_orderdate
""")
def d3(t):
    end = F.timestamp_add("MINUTE", F.col("l_partkey") % 1440, "l_shipdate").cast("timestamp_ntz")
    j = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).filter("l_shipdate >= o_orderdate").withColumn("ts2", end)
    start = F.col("o_orderdate")
    return j.select("l_orderkey", "l_linenumber", "l_partkey", sem.whole_units(start, F.col("l_shipdate"), "DAY").alias("days"),
                    sem.whole_units(start, F.col("ts2"), "HOUR").alias("hours"), sem.boundaries(start, F.col("ts2"), "HOUR").alias("hour_marks"))


@query("fn_d4_add_sub", """
SELECT event_id, ts + INTERVAL 30 MINUTE AS later, ts - INTERVAL 1 DAY AS earlier, (ts::DATE + INTERVAL 1 MONTH)::DATE AS next_month, ts::DATE - 7 AS week_ago FROM events
""")
def d4(t):
    ts, day = F.col("ts"), F.to_date("ts")
    return t.events.select("event_id", (ts + F.expr("INTERVAL 30 MINUTES")).alias("later"), (ts - F.expr("INTERVAL 1 DAY")).alias("earlier"),
                           F.add_months(day, 1).alias("next_month"), F.date_sub(day, 7).alias("week_ago"))


@query("fn_d5_trunc", """
SELECT event_id, date_trunc('hour', ts) AS hour, date_trunc('month', ts)::TIMESTAMP AS month, ts::DATE - dayofweek(ts)::INT AS week FROM events
""")
def d5(t):
    ts = F.col("ts")
    return t.events.select("event_id", F.date_trunc("hour", ts).cast("timestamp_ntz").alias("hour"),
                           F.date_trunc("month", ts).cast("timestamp_ntz").alias("month"), sem.sunday_week(ts).alias("week"))


@query("fn_d6_make_date", "SELECT o_orderkey, make_date(year(o_orderdate), month(o_orderdate), 1) AS month_start FROM orders")
def d6(t):
    return t.orders.select("o_orderkey", F.make_date(F.year("o_orderdate"), F.month("o_orderdate"), F.lit(1)).alias("month_start"))


@query("fn_d7_epochs", """
SELECT event_id, epoch_us(ts) // 1000000 AS seconds, make_timestamp((epoch_us(ts) // 1000000) * 1000000) AS back, make_timestamp(epoch_us(ts)) AS micros FROM events
""")
def d7(t):
    sec = sem.epoch_seconds(F.col("ts"))
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts"))
    return t.events.select("event_id", sec.alias("seconds"), sem.from_epoch_seconds(sec).alias("back"),
                           F.timestamp_add("MICROSECOND", micros, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")).cast("timestamp_ntz").alias("micros"))


@query("fn_d8_time_zone", "SELECT event_id, ts - INTERVAL 5 HOUR AS local_ts FROM events")
def d8(t):
    """January in New York is five hours behind."""
    return t.events.select("event_id", F.convert_timezone(F.lit("UTC"), F.lit("America/New_York"), "ts").alias("local_ts"))


@query("fn_d8_clock_changes", """
SELECT o_orderkey, timezone('America/New_York', timezone('UTC', o_orderdate::TIMESTAMP + INTERVAL (o_orderkey % 24) HOUR)) AS new_york,
 timezone('Europe/Berlin', timezone('UTC', o_orderdate::TIMESTAMP + INTERVAL (o_orderkey % 24) HOUR)) AS berlin FROM orders
""")
def d8_clock_changes(t):
    """Orders of all seasons at all hours: both sides of every clock change of seven years, in two zones."""
    at = F.col("o_orderdate").cast("timestamp_ntz") + F.make_interval(hours=(F.col("o_orderkey") % 24).cast("int"))
    zones = {"new_york": "America/New_York", "berlin": "Europe/Berlin"}
    return t.orders.select("o_orderkey", *[F.convert_timezone(F.lit("UTC"), F.lit(z), at).alias(n) for n, z in zones.items()])


@query("fn_d9_parse_format", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS text, strptime(strftime(ts, '%Y-%m-%d') || ' ' || strftime(ts, '%H:%M'), '%Y-%m-%d %H:%M') AS parsed FROM events
""")
def d9(t):
    both = F.concat_ws(" ", F.date_format("ts", "yyyy-MM-dd"), F.date_format("ts", "HH:mm"))
    return t.events.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("text"),
                           F.to_timestamp_ntz(both, F.lit("yyyy-MM-dd HH:mm")).alias("parsed"))


@query("fn_d10_reference_time", "SELECT event_id, datediff('day', ts::DATE, (SELECT MAX(ts) FROM events)::DATE)::INT AS age_days FROM events")
def d10(t):
    """Ages are taken from the newest row, where a live report would take the clock."""
    now = t.events.agg(F.max("ts")).scalar()
    return t.events.select("event_id", F.date_diff(F.to_date(now), F.to_date("ts")).alias("age_days"))


@query("fn_m1_rounding", """
SELECT event_id, ROUND(value, 1) AS rounded, trunc(value) AS truncated, floor(value)::BIGINT AS floored, abs(value - 50) AS absolute, event_id % 7 AS modulo, event_id // 7 AS quotient,
       (round_even(value::DECIMAL(18,2), 1))::DOUBLE AS half_even FROM events
""")
def m1(t):
    v = F.col("value")
    return t.events.select("event_id", F.round(v, 1).alias("rounded"), F.when(v >= 0, F.floor(v)).otherwise(F.ceil(v)).cast("double").alias("truncated"),
                           F.floor(v).alias("floored"), F.abs(v - 50).alias("absolute"), (F.col("event_id") % 7).alias("modulo"),
                           F.expr("event_id div 7").alias("quotient"), sem.half_even(v, 1).alias("half_even"))


@query("fn_m2_power", "SELECT event_id, ROUND(pow(value, 1.5), 4) AS p, ROUND(sqrt(value), 6) AS s FROM events")
def m2(t):
    return t.events.select("event_id", F.round(F.pow("value", F.lit(1.5)), 4).alias("p"), F.round(F.sqrt("value"), 6).alias("s"))


@query("fn_m3_safe_math", """
SELECT p_partkey, ROUND(p_retailprice / nullif(p_size - 10, 0), 6) AS ratio, try_cast(split_part(p_brand, '#', 2) AS INT) AS brand_no, try_cast(p_name AS DOUBLE) AS nothing FROM part
""")
def m3(t):
    return t.part.select("p_partkey", F.round(F.try_divide("p_retailprice", F.col("p_size") - 10), 6).alias("ratio"),
                         F.split_part("p_brand", F.lit("#"), F.lit(2)).try_cast("int").alias("brand_no"), F.col("p_name").try_cast("double").alias("nothing"))


@query("fn_m4_clamp", "SELECT event_id, least(greatest(value, 10), 100) AS clamped FROM events")
def m4(t):
    return t.events.select("event_id", F.least(F.greatest("value", F.lit(10.0)), F.lit(100.0)).alias("clamped"))


@query("fn_m5_random")
def m5(t):
    return t.customer.select("c_custkey", F.round(1 + F.rand(7) * 262).cast("int").alias("zone"), F.expr("uuid()").alias("id"))


@query("fn_n1_null_handling", """
SELECT c_custkey, COALESCE(o_totalprice, 0.0) AS price, CASE WHEN o_orderkey IS NULL THEN 'none' ELSE 'some' END AS has
FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_totalprice > 490000
""")
def n1(t):
    j = t.customer.join(t.orders.filter("o_totalprice > 490000"), F.col("c_custkey") == F.col("o_custkey"), "left")
    return j.select("c_custkey", F.ifnull("o_totalprice", F.lit(0.0)).alias("price"), F.when(F.col("o_orderkey").isNull(), "none").otherwise("some").alias("has"))


@query("fn_a1_arrays", "SELECT vec_id, len(embedding)::INT AS size, embedding[1] AS first, embedding[4] AS fourth, [vec_id, label::BIGINT] AS pair FROM embeddings")
def a1(t):
    e = F.col("embedding")
    return t.embeddings.select("vec_id", F.size(e).alias("size"), e[0].alias("first"), e[3].alias("fourth"), F.array("vec_id", F.col("label").cast("long")).alias("pair"))


@query("fn_a2_unnest", """
SELECT l_orderkey, COUNT(*) AS n, SUM(p) AS total FROM (SELECT l_orderkey, unnest([l_extendedprice, l_extendedprice * l_tax]) AS p FROM lineitem) GROUP BY 1
""".replace("SUM(p)", "ROUND(SUM(p), 4)"))
def a2(t):
    rows = t.lineitem.select("l_orderkey", F.explode(F.array("l_extendedprice", F.col("l_extendedprice") * F.col("l_tax"))).alias("p"))
    return rows.groupBy("l_orderkey").agg(F.count("*").alias("n"), F.round(F.sum("p"), 4).alias("total"))


@query("fn_a3_pair_lookup", "SELECT event_id, value AS amount, NULL::INT AS kind, user_id AS who FROM events")
def a3(t):
    pairs = F.array(
        F.struct(F.lit("amount").alias("name"), F.col("value").cast("string").alias("value")),
        F.struct(F.lit("kind").alias("name"), F.col("event_type").alias("value")),
        F.struct(F.lit("who").alias("name"), F.col("user_id").cast("string").alias("value")))
    e = t.events.withColumn("pairs", pairs)
    p = F.col("pairs")
    return e.select("event_id", jsons.pair_value(p, "amount", "double").alias("amount"), jsons.pair_value(p, "kind", "int").alias("kind"),
                    jsons.pair_value(p, "who", "bigint").alias("who"))


@query("fn_j1_parse_json", "SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE props END IS NOT NULL AS is_json FROM events")
def j1(t):
    text = F.when(F.col("event_type") == "error", F.concat(F.lit("{broken"), "props")).otherwise(F.col("props"))
    return t.events.select("event_id", F.try_parse_json(text).isNotNull().alias("is_json"))


@query("fn_j2_path_access", "SELECT event_id, json_extract_string(props, '$.k') AS text, json_extract_string(props, '$.k')::INT AS k, json_extract_string(props, '$.none') AS missing FROM events")
def j2(t):
    return t.events.select("event_id", jsons.scalar(F.col("props"), "$.k").alias("text"), F.variant_get(F.parse_json("props"), "$.k", "int").alias("k"),
                           jsons.scalar(F.col("props"), "$.none").alias("missing"))


@query("fn_j3_strict_numbers", """
SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k, NULL::BIGINT AS from_text, NULL::DOUBLE AS missing FROM events
""")
def j3(t):
    text = F.regexp_replace("props", r'"k": (\d+)', '"k": $1, "t": "$1"')
    return t.events.select("event_id", jsons.strict_number(text, "$.k", "bigint").alias("k"), jsons.strict_number(text, "$.t", "bigint").alias("from_text"),
                           jsons.strict_number(text, "$.none", "double").alias("missing"))


@query("fn_j4_json_arrays", """
SELECT p_partkey, unnest(json_extract_string(to_json(string_split(p_name, ' ')), '$[*]')) AS word FROM part
""")
def j4(t):
    items = F.from_json(F.to_json(F.split("p_name", " ")), "array<string>")
    return t.part.select("p_partkey", F.explode(items).alias("word"))


@query("fn_j5_to_json", "SELECT n_nationkey, '{\"name\":\"' || n_name || '\",\"region\":' || n_regionkey || '}' AS doc FROM nation")
def j5(t):
    return t.nation.select("n_nationkey", F.to_json(F.struct(F.col("n_name").alias("name"), F.col("n_regionkey").alias("region"))).alias("doc"))


@query("fn_g1_distance", f"""
SELECT event_id, ROUND(lat, 6) AS y, ROUND(lon, 6) AS x, ROUND(2 * 6371010.0 * asin(least(1, sqrt(pow(sin(radians(40.73061 - lat) / 2), 2)
 + cos(radians(lat)) * cos(radians(40.73061)) * pow(sin(radians(-73.935242 - lon) / 2), 2)))) / 1609.34, 4) AS miles FROM (SELECT event_id, {POINT_SQL} FROM events)
""")
def g1(t):
    e = event_points(t)
    miles = geo.distance_miles(F.col("lat"), F.col("lon"), F.lit(40.73061), F.lit(-73.935242))
    return e.select("event_id", F.round("lat", 6).alias("y"), F.round("lon", 6).alias("x"), F.round(miles, 4).alias("miles"))


@query("fn_g2_within", f"""
SELECT event_id, 2 * 6371010.0 * asin(least(1, sqrt(pow(sin(radians(39.0 - lat) / 2), 2) + cos(radians(lat)) * cos(radians(39.0)) * pow(sin(radians(-90.5 - lon) / 2), 2)))) <= 500000 AS near,
 ROUND((lat + lat + 1 + lat + 2) / 3, 6) AS mid_lat, ROUND((lon + lon + 2 + lon + 1) / 3, 6) AS mid_lon FROM (SELECT event_id, {POINT_SQL} FROM events)
""")
def g2(t):
    """Radius test around a WKT point, and the centroid of a triangle on each point."""
    e = event_points(t).withColumn("wkt", F.lit("POINT(-90.5 39.0)"))
    lat, lon = F.col("lat"), F.col("lon")
    near = geo.within_m(lat, lon, geo.point_lat(F.col("wkt")), geo.point_lon(F.col("wkt")), 500000)
    mid = geo.vertex_mean([(lat, lon), (lat + 1, lon + 2), (lat + 2, lon + 1)])
    return e.select("event_id", near.alias("near"), F.round(mid[0], 6).alias("mid_lat"), F.round(mid[1], 6).alias("mid_lon"))


@query("fn_c1_encrypt_round_trip", "SELECT c_custkey, c_name AS opened, TRUE AS hidden FROM customer")
def c1(t):
    key, aad = F.unhex(F.sha2(F.lit("test key"), 256)), F.col("c_custkey").cast("string")
    sealed = F.aes_encrypt("c_name", key, F.lit("GCM"), F.lit("DEFAULT"), F.lit(""), aad)
    c = t.customer.withColumn("sealed", sealed)
    opened = F.aes_decrypt("sealed", key, F.lit("GCM"), F.lit("DEFAULT"), aad).cast("string")
    return c.select("c_custkey", opened.alias("opened"), (F.hex("sealed") != F.hex("c_name")).alias("hidden"))


@query("fn_u1_sql_function", """
SELECT make_timestamp((epoch_us(ts) // 180000000) * 180000000) - INTERVAL 5 HOUR AS three_min, COUNT(*) AS n FROM events GROUP BY 1
""")
def u1(t):
    """A SQL function for local-time buckets, called from SQL."""
    spark = spark_of(t)
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION tidemark_tumble(val TIMESTAMP_NTZ, seconds BIGINT) RETURNS TIMESTAMP_NTZ
        RETURN convert_timezone('UTC', 'America/New_York',
            CAST(timestampadd(SECOND, (timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01', val) div seconds) * seconds, TIMESTAMP_NTZ'1970-01-01') AS TIMESTAMP_NTZ))
    """)
    return spark.sql("SELECT tidemark_tumble(ts, 180) AS three_min, COUNT(*) AS n FROM {e} GROUP BY 1", e=t.events)
