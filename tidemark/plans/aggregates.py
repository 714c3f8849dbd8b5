"""Aggregations and windows."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from tidemark.functions.semantics import half_even, week_number
from tidemark.operators import aggregates as ag
from tidemark.operators.joins import pair_events
from tidemark.operators.relational import bin_counts
from tidemark.plans.joins import PAIRS_SQL
from tidemark.plans.registry import query, spark_of
from tidemark.sources.readers import latest_by


@query("ag01_group_by", """
SELECT l_returnflag, l_linestatus, SUM(l_quantity) AS quantity, ROUND(AVG(l_extendedprice), 4) AS average, COUNT(*) AS n, MIN(l_shipdate) AS first_day, MAX(l_extendedprice) AS highest
FROM lineitem GROUP BY 1, 2
""")
def group_by(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("quantity"), F.round(F.avg("l_extendedprice"), 4).alias("average"), F.count("*").alias("n"),
        F.min("l_shipdate").alias("first_day"), F.max("l_extendedprice").alias("highest"))


@query("ag02_group_by_all", """
SELECT o_orderstatus, year(o_orderdate)::INT AS year, COUNT(*) AS n, ROUND(SUM(o_totalprice), 2) AS total FROM orders GROUP BY ALL
""")
def group_by_all(t):
    return spark_of(t).sql("""
        SELECT o_orderstatus, year(o_orderdate) AS year, COUNT(*) AS n, ROUND(SUM(o_totalprice), 2) AS total FROM {o} GROUP BY ALL
    """, o=t.orders)


@query("ag03_having", "SELECT o_custkey, COUNT(*) AS n, ROUND(SUM(o_totalprice), 2) AS total FROM orders GROUP BY 1 HAVING SUM(o_totalprice) > 3000000")
def having(t):
    totals = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return totals.filter("total > 3000000")


@query("ag04_count_distinct", """
SELECT l_returnflag, COUNT(DISTINCT l_partkey) AS parts, COUNT(DISTINCT l_suppkey) AS suppliers, COUNT(*) AS n FROM lineitem GROUP BY 1
""")
def count_distinct(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.count_distinct("l_partkey").alias("parts"), F.count_distinct("l_suppkey").alias("suppliers"), F.count("*").alias("n"))


_HIST = ", ".join([f"COUNT(*) FILTER (dayofweek(ts) + 1 = {d}) AS dow_{d}" for d in range(1, 8)] + [f"COUNT(*) FILTER (hour(ts) = {h}) AS hour_{h}" for h in range(24)])
HIST_SQL = f"SELECT user_id, COUNT(*) AS total, {_HIST} FROM events GROUP BY 1"


@query("ag05_time_histogram", HIST_SQL)
def time_histogram(t):
    return ag.time_histogram(t.events, ["user_id"], "ts")


def _plus(prefix, numbers):
    return " + ".join(f"{prefix}_{n}" for n in numbers)


# Own choice of parts of the week and of the day, by count columns of the histogram.
WEEK_PARTS = {"midweek": ["dow_3", "dow_4", "dow_5"], "edges": ["dow_1", "dow_2", "dow_6", "dow_7"]}
DAY_PARTS = {"morning": [f"hour_{h}" for h in range(5, 13)], "evening": [f"hour_{h}" for h in range(13, 22)]}
LEAD_SHARE = 0.55


def habits_sql():
    def case(parts):
        return "CASE " + " ".join(f"WHEN {' + '.join(cols)} > floor(total * {LEAD_SHARE} + 0.5) THEN '{name}'" for name, cols in parts.items()) + " ELSE 'mixed' END"

    return f"{case(WEEK_PARTS)} AS week_part, {case(DAY_PARTS)} AS day_part"


def with_habits(hist):
    """The part of the week and of the day that leads in each row of a time histogram."""
    total = F.col("total")
    return hist.withColumns({
        "week_part": ag.leading_group(WEEK_PARTS, total, LEAD_SHARE, "mixed"), "day_part": ag.leading_group(DAY_PARTS, total, LEAD_SHARE, "mixed")})


@query("ag06_classify_habits", f"SELECT user_id, event_type, {habits_sql()} FROM ({HIST_SQL.replace('SELECT user_id,', 'SELECT user_id, event_type,').replace('GROUP BY 1', 'GROUP BY 1, 2')})")
def classify_habits(t):
    hist = ag.time_histogram(t.events, ["user_id", "event_type"], "ts")
    return with_habits(hist).select("user_id", "event_type", "week_part", "day_part")


@query("ag07_array_agg", """
SELECT n_regionkey, array_to_string(list_sort(list(DISTINCT n_name)), '|') AS nations, COUNT(*) AS n FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY 1
""")
def array_agg(t):
    """Names come from a fixed list of 25, so the array stays short however many customers there are."""
    joined = t.nation.join(t.customer, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("n_regionkey").agg(F.array_join(F.array_sort(F.collect_set("n_name")), "|").alias("nations"), F.count("*").alias("n"))


@query("ag08_string_agg_distinct", """
SELECT o_orderstatus, string_agg(DISTINCT o_orderpriority, ', ' ORDER BY o_orderpriority) AS priorities FROM orders GROUP BY 1
""")
def string_agg(t):
    return spark_of(t).sql("""
        SELECT o_orderstatus, listagg(DISTINCT o_orderpriority, ', ') WITHIN GROUP (ORDER BY o_orderpriority) AS priorities FROM {o} GROUP BY 1
    """, o=t.orders)


@query("ag09_steady_entities", """
SELECT user_id, ROUND(AVG(d), 6) AS average_daily, ROUND(stddev_samp(d), 6) AS stddev_daily
FROM (SELECT user_id, ts::DATE AS day, SUM(value) AS d FROM events GROUP BY 1, 2) GROUP BY 1 HAVING stddev_samp(d) < 70
""")
def steady_entities(t):
    steady = ag.steady_entities(t.events, "user_id", F.to_date("ts"), F.col("value"), 70)
    return steady.select("user_id", F.round("average_daily", 6).alias("average_daily"), F.round("stddev_daily", 6).alias("stddev_daily"))


@query("ag10_distinct", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def distinct(t):
    return t.lineitem.select("l_suppkey", "l_returnflag", "l_linestatus").distinct()


_DAYS = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
_PIVOT_SQL = ", ".join(f"ROUND(SUM(o_totalprice) FILTER (dayname(o_orderdate) = '{d}'), 2) AS \"{d}\"" for d in _DAYS)


@query("ag11_pivot", f"SELECT month(o_orderdate)::INT AS month, {_PIVOT_SQL} FROM orders GROUP BY 1")
def pivot(t):
    orders = t.orders.withColumns({"month": F.month("o_orderdate"), "weekday": F.date_format("o_orderdate", "EEEE")})
    return ag.pivot(orders, ["month"], "weekday", _DAYS, [F.round(F.sum("o_totalprice"), 2)])


@query("ag12_pivot_many", """
SELECT event_type, ROUND(AVG(value) FILTER (ts >= '2024-01-16'), 6) AS late_average, COUNT(*) FILTER (ts >= '2024-01-16') AS late_n,
       ROUND(AVG(value) FILTER (ts < '2024-01-16'), 6) AS early_average, COUNT(*) FILTER (ts < '2024-01-16') AS early_n FROM events GROUP BY 1
""")
def pivot_many(t):
    half = F.when(F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz"), "late").otherwise("early")
    return ag.pivot(t.events.withColumn("half", half), ["event_type"], "half", ["late", "early"], [
        F.round(F.avg("value"), 6).alias("average"), F.count(F.lit(1)).alias("n")]).fillna(0, ["late_n", "early_n"])


TREND, TREND_ABOVE = [(-0.25, "falling"), (0.25, "level")], "rising"  # own bands of relative change


def trend_sql(cur, prior):
    change = f"({cur} - {prior}) / nullif({prior}, 0)"
    return "CASE " + " ".join(f"WHEN {change} <= {bound} THEN '{name}'" for bound, name in TREND) + f" ELSE '{TREND_ABOVE}' END"


WINDOWS_SQL = f"""
WITH m AS (SELECT MAX(ts) AS ref FROM events), w AS (SELECT event_type, value, length(props)::DOUBLE AS size, ts > ref - INTERVAL 6 HOUR AS cur FROM events, m WHERE ts > ref - INTERVAL 5 DAY),
p AS (SELECT event_type, AVG(value) FILTER (cur) AS cv, AVG(value) FILTER (NOT cur) AS pv, AVG(size) FILTER (cur) AS cs, AVG(size) FILTER (NOT cur) AS ps,
             COUNT(*) FILTER (cur) AS current_rows, COUNT(*) FILTER (NOT cur) AS prior_rows FROM w GROUP BY 1)
SELECT event_type, current_rows, prior_rows, ROUND(cv, 4) AS value_current, ROUND(pv, 4) AS value_prior, {trend_sql('cv', 'pv')} AS value_trend,
       ROUND(cs, 4) AS size_current, ROUND(ps, 4) AS size_prior, {trend_sql('cs', 'ps')} AS size_trend FROM p
"""


def window_report(events):
    src = events.withColumn("size", F.length("props").cast("double"))
    wide = ag.compare_windows(src, ["event_type"], "ts", ["value", "size"], "6 HOURS", "5 DAYS", TREND, TREND_ABOVE)
    return wide.select(
        "event_type", "current_rows", "prior_rows",
        F.round("current_avg_value", 4).alias("value_current"), F.round("prior_avg_value", 4).alias("value_prior"), "value_trend",
        F.round("current_avg_size", 4).alias("size_current"), F.round("prior_avg_size", 4).alias("size_prior"), "size_trend")


@query("ag13_compare_windows", WINDOWS_SQL)
def compare_windows(t):
    return window_report(t.events)


@query("ag14_aggregate_twice", """
WITH d AS (SELECT user_id, ts::DATE AS day, event_type, MAX(value) AS top FROM events GROUP BY 1, 2, 3)
SELECT day, user_id, total FROM (SELECT day, user_id, SUM(top) AS total, RANK() OVER (PARTITION BY day ORDER BY SUM(top) DESC) AS r FROM d GROUP BY 1, 2) WHERE r = 1
""")
def aggregate_twice(t):
    tops = t.events.groupBy("user_id", F.to_date("ts").alias("day"), "event_type").agg(F.max("value").alias("top"))
    totals = tops.groupBy("day", "user_id").agg(F.sum("top").alias("total"))
    return ag.top_per_group(totals, ["day"], [F.desc("total")], 1, ties=True).drop("rank")


@query("ag15_private_aggregate", """
SELECT hour(ts)::INT AS hour, event_type, COUNT(DISTINCT user_id) AS entities, ROUND(AVG(value), 6) AS average, COUNT(value) AS n
FROM events GROUP BY 1, 2 HAVING COUNT(DISTINCT user_id) >= 5
""")
def private_aggregate(t):
    measures = {"average": ("avg", "value"), "n": ("count", "value")}
    shown = ag.private_agg(t.events, [F.hour("ts").alias("hour"), F.col("event_type")], "user_id", measures, 5)
    return shown.withColumn("average", F.round("average", 6))


@query("ag16_first_per_group", "SELECT o_custkey, MIN(o_orderkey) AS first_order, arg_min(o_orderstatus, o_orderkey) AS first_status FROM orders GROUP BY 1")
def first_per_group(t):
    return ag.first_by(t.orders, ["o_custkey"], "o_orderkey", {"o_orderkey": "first_order", "o_orderstatus": "first_status"})


@query("ag17_envelope", """
SELECT user_id, MIN(ts) AS started, MAX(ts) AS ended, MAX(value) AS max_value, datediff('microsecond', MIN(ts), MAX(ts)) // 60000000 AS minutes FROM events GROUP BY 1
""")
def envelope(t):
    return ag.envelope(t.events, ["user_id"], "ts", ["value"])


@query("ag18_customer_profile", """
WITH l AS (SELECT o_custkey, l_extendedprice * l_quantity AS amount, l_partkey, p_type FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey),
a AS (SELECT o_custkey, ROUND(SUM(amount), 2) AS total_spend, ROUND(AVG(amount), 8) AS average_ticket, COUNT(*) AS transactions FROM l GROUP BY 1),
p AS (SELECT o_custkey, l_partkey FROM l GROUP BY 1, 2 QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY COUNT(*) DESC, l_partkey) = 1),
c AS (SELECT o_custkey, p_type FROM l GROUP BY 1, 2 QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY COUNT(*) DESC, p_type) = 1)
SELECT c_custkey, c_name, total_spend, average_ticket, transactions, p.l_partkey AS favorite_product, c.p_type AS favorite_category
FROM customer LEFT JOIN a ON a.o_custkey = c_custkey LEFT JOIN p ON p.o_custkey = c_custkey LEFT JOIN c ON c.o_custkey = c_custkey
""")
def customer_profile(t):
    lines = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey")).join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    prof = ag.customer_profile(lines.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", F.col("l_extendedprice") * F.col("l_quantity"), "l_partkey", "p_type", digits=8)
    return t.customer.select("c_custkey", "c_name").join(prof, "c_custkey", "left")


@query("ag19_rate", "SELECT o_orderpriority, ROUND(COUNT(*) FILTER (o_orderstatus = 'F') / COUNT(*), 6) AS finished_rate FROM orders GROUP BY 1")
def rate(t):
    return t.orders.groupBy("o_orderpriority").agg(F.round(F.count_if(F.col("o_orderstatus") == "F") / F.count("*"), 6).alias("finished_rate"))


@query("ag20_value_counts", "SELECT lang, COUNT(*) AS n FROM documents GROUP BY 1 ORDER BY n DESC")
def value_counts(t):
    return t.documents.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"))


def job_log(t):
    """Lines as jobs: two stages and two timeline points each, as arrays in the row."""
    q, n = F.col("l_quantity"), F.col("l_linenumber")
    stages = F.array(
        F.struct((q * 1000).alias("slot_ms"), F.lit(0).alias("start_ms"), (n * 100).alias("end_ms")),
        F.struct((q * 500).alias("slot_ms"), F.lit(100).alias("start_ms"), (F.lit(100) + (F.col("l_partkey") % 50).cast("int")).alias("end_ms")))
    timeline = F.array(F.struct(n.cast("long").alias("runnable_units")), F.struct((F.col("l_suppkey") % 13).alias("runnable_units")))
    return t.lineitem.select(
        F.col("l_returnflag").alias("project_id"), F.col("l_shipdate").alias("started"),
        F.when(F.col("l_linestatus") == "F", "reserved").alias("reservation_id"),
        (F.floor("l_extendedprice") * 1000000000).alias("bytes_billed"), (q * 1500).alias("slot_ms"), (n * 60000).alias("duration_ms"),
        stages.alias("stages"), timeline.alias("timeline"))


@query("ag21_job_cost", """
WITH j AS (SELECT l_returnflag AS project_id, l_shipdate AS started, l_linestatus, floor(l_extendedprice) * 1000000000 * 0.00000000000568434188608080::DOUBLE AS cost,
  l_quantity * 1500 / (l_linenumber * 60000) AS slots, unnest([{'s': l_quantity * 1000 / (l_linenumber * 100), 'u': l_linenumber::BIGINT}, {'s': l_quantity * 500 / nullif(l_partkey % 50, 0), 'u': l_suppkey % 13}]) AS x FROM lineitem)
SELECT project_id, year(started)::INT AS year, month(started)::INT AS month, COUNT(*) // 2 AS jobs, ROUND(SUM(CASE WHEN l_linestatus = 'F' THEN 0 ELSE cost END) / 2, 4) AS cost,
 ROUND(AVG(slots), 10) AS avg_slots, ROUND(MAX(x.s), 6) AS max_stage_slots, MAX(x.u) AS runnable_units FROM j GROUP BY 1, 2, 3
""")
def job_cost(t):
    costs = ag.job_cost(job_log(t), "stages", "timeline", "duration_ms")
    return costs.groupBy("project_id", F.year("started").alias("year"), F.month("started").alias("month")).agg(
        F.count("*").alias("jobs"), F.round(F.sum("cost"), 4).alias("cost"), F.round(F.avg("avg_slots"), 10).alias("avg_slots"),
        F.round(F.max("max_stage_slots"), 6).alias("max_stage_slots"), F.max("runnable_units").alias("runnable_units"))


@query("ag22_bar_text", "SELECT o_orderpriority, repeat('$', (COUNT(*) // 1000)::INT + 1) AS bar FROM orders GROUP BY 1")
def bar_text(t):
    return t.orders.groupBy("o_orderpriority").agg(F.repeat(F.lit("$"), (F.floor(F.count("*") / 1000) + 1).cast("int")).alias("bar"))


@query("ag23_bins", """
SELECT CASE WHEN l_quantity < 10 THEN '0-10' WHEN l_quantity < 25 THEN '10-25' WHEN l_quantity < 40 THEN '25-40' ELSE '40+' END AS bin, COUNT(*) AS n FROM lineitem GROUP BY 1
""")
def bins(t):
    return bin_counts(t.lineitem, "l_quantity", [0, 10, 25, 40])


@query("wn01_rank_with_ties", """
SELECT day, o_orderpriority, orders FROM (SELECT o_orderdate::DATE AS day, o_orderpriority, COUNT(*) AS orders, RANK() OVER (PARTITION BY o_orderdate::DATE ORDER BY COUNT(*) DESC) AS r FROM orders GROUP BY 1, 2) WHERE r = 1
""")
def rank_with_ties(t):
    counts = t.orders.groupBy(F.to_date("o_orderdate").alias("day"), "o_orderpriority").agg(F.count("*").alias("orders"))
    return ag.top_per_group(counts, ["day"], [F.desc("orders")], 1, ties=True).drop("rank")


@query("wn02_latest_row", "SELECT user_id, event_id, ts, event_type FROM events QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) = 1")
def latest_row(t):
    return latest_by(t.events, ["user_id"], [F.desc("ts"), F.asc("event_id")]).select("user_id", "event_id", "ts", "event_type")


@query("wn03_mode_per_key", """
SELECT user_id, event_type, COUNT(*) AS n FROM events GROUP BY 1, 2 QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY COUNT(*) DESC, event_type) = 1
""")
def mode_per_key(t):
    return ag.mode_per_key(t.events, ["user_id"], "event_type")


_WEEK_SQL = "((dayofyear(o_orderdate) + 7 - (dayofweek(o_orderdate) + 1)) // 7)::INT"


@query("wn04_period_change", f"""
WITH w AS (SELECT o_orderstatus, year(o_orderdate)::INT AS year, {_WEEK_SQL} AS week, COUNT(*) AS orders, ROUND(SUM(o_totalprice), 2) AS total FROM orders GROUP BY 1, 2, 3),
l AS (SELECT *, LAG(orders) OVER k AS prior_orders, LAG(total) OVER k AS prior_total FROM w WINDOW k AS (PARTITION BY o_orderstatus ORDER BY year, week))
SELECT o_orderstatus, year, week, orders, total, prior_orders, prior_total, ROUND((orders - prior_orders) / nullif(prior_orders, 0)::DOUBLE, 6) AS change_orders,
       ROUND((total - prior_total) / nullif(prior_total, 0), 6) AS change_total FROM l
""")
def period_change(t):
    weekly = t.orders.groupBy("o_orderstatus", F.year("o_orderdate").alias("year"), week_number(F.col("o_orderdate")).alias("week")).agg(
        F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    out = ag.period_change(weekly, ["o_orderstatus"], ["year", "week"], ["orders", "total"])
    return out.withColumns({c: F.round(c, 6) for c in ("change_orders", "change_total")})


@query("wn06_qualify", """
SELECT p_type, p_partkey, p_retailprice FROM part QUALIFY RANK() OVER (PARTITION BY p_type ORDER BY p_retailprice DESC) <= 3
""")
def qualify(t):
    w = Window.partitionBy("p_type").orderBy(F.desc("p_retailprice"))
    return t.part.withColumn("r", F.rank().over(w)).filter("r <= 3").select("p_type", "p_partkey", "p_retailprice")


@query("wn08_first_last_pairing", f"SELECT user_id, start_ts, end_ts, minutes, ROUND(amount, 2) AS amount FROM ({PAIRS_SQL.replace('''datediff('second', a.started, b.ended) // 60''', '''datediff('microsecond', a.started, b.ended) // 60000000''')})")
def first_last_pairing(t):
    pairs = pair_events(t.events, ["user_id"], "ts", "event_type", "view", "purchase", ["value"])
    return pairs.select("user_id", "start_ts", "end_ts", F.timestamp_diff("MINUTE", "start_ts", "end_ts").alias("minutes"),
                        half_even(F.col("end_value"), 2).alias("amount"))
