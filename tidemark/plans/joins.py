"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.semantics import epoch_seconds
from tidemark.operators import joins as j
from tidemark.operators.ordered import running_sum
from tidemark.plans.registry import query, spark_of
from tidemark.session import scratch_path
from tidemark.sources.readers import inline_rows, read_table
from tidemark.sources.tables import write_table


@query("jn01_star_join", """
SELECT n_name, o_orderpriority, COUNT(*) AS lines, ROUND(SUM(l_extendedprice * (1 - l_discount)), 4) AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2
""")
def star_join(t):
    return (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("n_name", "o_orderpriority")
        .agg(F.count("*").alias("lines"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 4).alias("revenue"))
    )


@query("jn02_left_join", """
SELECT c_custkey, COUNT(o_orderkey) AS orders FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_totalprice > 400000 GROUP BY 1
""")
def left_join(t):
    """Orders are counted per customer before the join, so a customer with very many adds one row to it."""
    counts = t.orders.filter("o_totalprice > 400000").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    return t.customer.join(counts, "c_custkey", "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("orders"))


@query("jn03_one_row_and_grid", """
SELECT r_name, m.month::INT AS month, COALESCE(n, 0) AS orders, ROUND(COALESCE(n, 0) / (SELECT COUNT(*) FROM orders), 6) AS share
FROM region, generate_series(1, 12) m(month)
LEFT JOIN (SELECT n_regionkey AS k, month(o_orderdate) AS mm, COUNT(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)
  ON k = r_regionkey AND mm = m.month
""")
def one_row_and_grid(t):
    """Every region and month from a generated calendar; the one-row total is a scalar subquery, not a join."""
    grid = t.region.withColumn("month", F.explode(F.sequence(F.lit(1), F.lit(12))))
    counts = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("n_regionkey").alias("r_regionkey"), F.month("o_orderdate").alias("month")).agg(F.count("*").alias("n"))
    )
    n = F.coalesce("n", F.lit(0))
    total = t.orders.agg(F.count("*")).scalar()
    return grid.join(counts, ["r_regionkey", "month"], "left").select("r_name", "month", n.alias("orders"), F.round(n / total, 6).alias("share"))


PAIRS_SQL = """
SELECT a.user_id, a.started AS start_ts, b.ended AS end_ts, datediff('second', a.started, b.ended) // 60 AS minutes, b.value AS amount
FROM (SELECT user_id, MIN(ts) AS started FROM events WHERE event_type = 'view' GROUP BY 1) a
JOIN (SELECT user_id, MAX(ts) AS ended, arg_max(value, ts) AS value FROM events WHERE event_type = 'purchase' GROUP BY 1) b USING (user_id) WHERE ended >= started
"""


@query("jn04_pair_events", f"SELECT user_id, start_ts, end_ts, amount FROM ({PAIRS_SQL})")
def pair_events(t):
    pairs = j.pair_events(t.events, ["user_id"], "ts", "event_type", "view", "purchase", ["value"])
    return pairs.select("user_id", "start_ts", "end_ts", F.col("end_value").alias("amount"))


@query("jn05_dimension_twice", """
SELECT cn.n_name AS customer_nation, sn.n_name AS supplier_nation, COUNT(*) AS lines, SUM(l_quantity) AS quantity
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
JOIN nation cn ON cn.n_nationkey = c_nationkey JOIN nation sn ON sn.n_nationkey = s_nationkey GROUP BY 1, 2
""")
def dimension_twice(t):
    buyers = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("customer_nation"))
    sellers = t.nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("supplier_nation"))
    return (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(buyers, "c_nationkey").join(sellers, "s_nationkey")
        .groupBy("customer_nation", "supplier_nation").agg(F.count("*").alias("lines"), F.sum("l_quantity").alias("quantity"))
    )


@query("jn06_interval_load", """
WITH job AS (SELECT event_type, event_id, epoch_us(ts) // 60000000 AS lo, epoch_us(ts) // 60000000 + 5 + (floor(value + 0.5)::BIGINT % 60) AS hi, value FROM events)
SELECT event_type, m.minute AS minute, COUNT(*)::BIGINT AS active, SUM(value::DECIMAL(28,6))::DOUBLE AS load
FROM job, (SELECT unnest(generate_series(epoch_us((SELECT MIN(ts) FROM events)) // 60000000, epoch_us((SELECT MAX(ts) FROM events)) // 60000000 + 100)) AS minute) m
WHERE m.minute BETWEEN lo AND hi GROUP BY 1, 2
""")
def interval_load(t):
    """Each event is a job of 5 to 64 minutes; active jobs and their load for every minute."""
    start = F.floor(epoch_seconds(F.col("ts")) / 60).cast("long")
    jobs = t.events.select("event_type", "value", start.alias("lo")).withColumn("hi", F.col("lo") + 5 + F.round("value").cast("long") % 60)
    load = j.interval_load(jobs, ["event_type"], "lo", "hi", "value")
    return load.select("event_type", F.col("point").alias("minute"), F.col("active").cast("long").alias("active"), F.col("total").cast("double").alias("load"))


@query("jn06_count_in_intervals", """
SELECT e.event_id, COUNT(p.event_id) AS purchases FROM events e LEFT JOIN events p ON p.event_type = 'purchase' AND p.ts BETWEEN e.ts AND e.ts + INTERVAL 2 HOUR
WHERE e.event_type = 'error' GROUP BY 1
""")
def count_in_intervals(t):
    """Purchases in the two hours after each error, counted without building the pairs."""
    spans = t.events.filter("event_type = 'error'").select("event_id", F.col("ts").alias("lo"), (F.col("ts") + F.expr("INTERVAL 2 HOURS")).alias("hi"))
    points = t.events.filter("event_type = 'purchase'").select("ts")
    return j.count_in_intervals(spans, "event_id", "lo", "hi", points, "ts").select("event_id", F.col("points").alias("purchases"))


@query("jn07_composite_match", """
SELECT l_orderkey, l_linenumber, p_partkey, COUNT(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey AND year(l_shipdate) = year(o_orderdate)
JOIN part ON p_partkey = l_partkey AND p_size::VARCHAR = l_quantity::INT::VARCHAR GROUP BY 1, 2, 3
""")
def composite_match(t):
    """Order and year must agree, then part and its size written as text."""
    first = j.match_on(t.lineitem, t.orders, [
        (F.col("l_orderkey"), F.col("o_orderkey")), (F.year("l_shipdate"), F.year("o_orderdate"))])
    both = j.match_on(first, t.part, [
        (F.col("l_partkey"), F.col("p_partkey")), (F.col("l_quantity").cast("int").cast("string"), F.col("p_size").cast("string"))])
    return both.groupBy("l_orderkey", "l_linenumber", "p_partkey").agg(F.count("*").alias("n"))


GAP_SQL = """
WITH d AS (SELECT s_nationkey AS center, p_type AS product, l_shipdate::DATE AS day, SUM(l_quantity) AS qty FROM lineitem
           JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey WHERE l_linestatus = 'O' GROUP BY 1, 2, 3),
     s AS (SELECT s_nationkey AS center, p_type AS product, l_shipdate::DATE AS day, SUM(l_quantity) AS qty FROM lineitem
           JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey WHERE l_linestatus = 'F' GROUP BY 1, 2, 3),
     rd AS (SELECT center, product, day, SUM(qty) OVER (PARTITION BY center, product ORDER BY day) AS required FROM d),
     rs AS (SELECT center, product, day, SUM(qty) OVER (PARTITION BY center, product ORDER BY day) AS available FROM s)
SELECT center, product, day, required, available, available - required AS in_stock FROM rd JOIN rs USING (center, product, day) WHERE available - required <= 20
"""


def stock_moves(t):
    """Lines by supplier nation, part type and day; open ones are demand, finished ones supply."""
    return (
        t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .select("l_linestatus", F.col("s_nationkey").alias("center"), F.col("p_type").alias("product"),
                F.to_date("l_shipdate").alias("day"), F.col("l_quantity").alias("qty"))
    )


def is_demand():
    return F.when(F.col("l_linestatus") == "O", True).when(F.col("l_linestatus") == "F", False)


@query("jn08_supply_gap", GAP_SQL)
def supply_gap(t):
    return j.supply_gap(stock_moves(t), is_demand(), ["center", "product"], "day", "qty", 20)


POINT_SQL = "30 + (user_id % 97) * 0.17::DOUBLE AS lat, -100 + (user_id % 89) * 0.23::DOUBLE AS lon"
NEAREST_SQL = f"""
WITH l AS (SELECT event_id, {POINT_SQL} FROM events),
r AS (SELECT s_suppkey, 29.5::DOUBLE + (s_suppkey % 31) * 0.61::DOUBLE AS rlat, -101 + (s_suppkey % 37) * 0.67::DOUBLE AS rlon FROM supplier),
p AS (SELECT lat, lon, s_suppkey, 2 * 6371010.0 * asin(least(1, sqrt(pow(sin(radians(rlat - lat) / 2), 2) + cos(radians(lat)) * cos(radians(rlat)) * pow(sin(radians(rlon - lon) / 2), 2)))) AS m
      FROM (SELECT DISTINCT lat, lon FROM l), r),
b AS (SELECT lat, lon, s_suppkey, m FROM p WHERE m <= 100000 QUALIFY ROW_NUMBER() OVER (PARTITION BY lat, lon ORDER BY m, s_suppkey) = 1)
SELECT event_id, s_suppkey, ROUND(m, 3) AS distance_m FROM l JOIN b USING (lat, lon)
"""


def event_points(t):
    return t.events.withColumns({"lat": 30 + (F.col("user_id") % 97) * 0.17, "lon": -100 + (F.col("user_id") % 89) * 0.23})


def supplier_points(t):
    return t.supplier.select("s_suppkey", (29.5 + (F.col("s_suppkey") % 31) * 0.61).alias("lat"), (-101 + (F.col("s_suppkey") % 37) * 0.67).alias("lon"))


@query("jn09_nearest_point", NEAREST_SQL)
def nearest_point(t):
    near = j.nearest(event_points(t).select("event_id", "lat", "lon"), supplier_points(t), "s_suppkey", "lat", "lon", 100)
    return near.select("event_id", "s_suppkey", F.round("distance_m", 3).alias("distance_m"))


@query("jn10_left_join_ranked", """
SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer
LEFT JOIN (SELECT * FROM orders QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1) ON o_custkey = c_custkey
""")
def left_join_ranked(t):
    orders = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")
    out = j.left_join_ranked(t.customer, orders, ["c_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")])
    return out.select("c_custkey", "c_name", "o_orderkey", "o_totalprice")


@query("jn11_semi_join", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)")
def semi_join(t):
    big = t.orders.filter("o_totalprice > 450000")
    return t.customer.join(big, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_name")


@query("jn12_anti_join", """
SELECT 'not_exists' AS form, COUNT(*) AS n FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c.c_custkey AND o_totalprice > 400000)
UNION ALL SELECT 'not_in', COUNT(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)
""")
def anti_join(t):
    big = t.orders.filter("o_totalprice > 400000")
    not_exists = t.customer.join(big, F.col("c_custkey") == F.col("o_custkey"), "left_anti").agg(F.count("*").alias("n"))
    not_in = j.not_in(t.customer, "c_custkey", big, "o_custkey").agg(F.count("*").alias("n"))
    return not_exists.withColumn("form", F.lit("not_exists")).unionByName(not_in.withColumn("form", F.lit("not_in")))


@query("jn13_aggregate_then_join", """
SELECT n_name, p_brand, SUM(quantity) AS quantity FROM (SELECT l_suppkey, l_partkey, SUM(l_quantity) AS quantity FROM lineitem GROUP BY 1, 2)
JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON n_nationkey = s_nationkey JOIN part ON p_partkey = l_partkey GROUP BY 1, 2
""")
def aggregate_then_join(t):
    small = t.lineitem.groupBy("l_suppkey", "l_partkey").agg(F.sum("l_quantity").alias("quantity"))
    return (
        small.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy("n_name", "p_brand").agg(F.sum("quantity").alias("quantity"))
    )


@query("jn14_lookup_default", """
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'now' WHEN '2-HIGH' THEN 'soon' ELSE '(unknown)' END AS label FROM orders
""")
def lookup_default(t):
    words = inline_rows(spark_of(t), [("1-URGENT", "now"), ("2-HIGH", "soon")], "o_orderpriority string, label string")
    return j.lookup(t.orders.select("o_orderkey", "o_orderpriority"), words, "o_orderpriority", "label").select("o_orderkey", "label")


@query("jn15_multi_format_join", """
SELECT r_name, COUNT(*) AS customers, ROUND(SUM(c_acctbal), 2) AS balance FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1
""")
def multi_format_join(t):
    """Parquet facts, JSON and CSV dimensions."""
    spark = spark_of(t)
    nations = read_table(spark, write_table(t.nation, scratch_path(spark, "n"), "json"), "json", t.nation.schema)
    regions = read_table(spark, write_table(t.region, scratch_path(spark, "r"), "csv"), "csv", t.region.schema)
    return (
        t.customer.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy("r_name").agg(F.count("*").alias("customers"), F.round(F.sum("c_acctbal"), 2).alias("balance"))
    )


@query("jn16_lateral_unnest", """
SELECT word, COUNT(*) AS n FROM (SELECT unnest(string_split(p_name || ' ' || p_brand || ' ' || p_type, ' ')) AS word FROM part) GROUP BY 1
""")
def lateral_unnest(t):
    words = F.split(F.concat_ws(" ", "p_name", "p_brand", "p_type"), " ")
    return t.part.select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


@query("wn05_running_sum", """
SELECT l_suppkey, l_shipdate::DATE AS day, SUM(SUM(l_quantity)) OVER (PARTITION BY l_suppkey ORDER BY l_shipdate::DATE) AS running
FROM lineitem GROUP BY 1, 2
""")
def running(t):
    daily = t.lineitem.select("l_suppkey", F.to_date("l_shipdate").alias("day"), "l_quantity")
    return running_sum(daily, ["l_suppkey"], ["day"], {"l_quantity": "running"}).drop("l_quantity")
