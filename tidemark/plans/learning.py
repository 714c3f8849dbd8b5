"""Models, forecasts, vectors and text."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from tidemark.operators import aggregates as ag, models as m, seasonal as se, table_functions as tf, text as tx, vectors as v
from tidemark.plans.registry import query, spark_of
from tidemark.session import materialize
from tidemark.sources.readers import latest_by


def priced_lines(t):
    return t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", "l_linenumber", "l_returnflag", "p_type", "l_quantity", "p_retailprice", "l_extendedprice")


@query("ml01_linear_regression")
def linear_regression(t):
    lines = priced_lines(t)
    model = m.train_linear(lines, "l_extendedprice", ["l_returnflag", "p_type"], ["l_quantity", "p_retailprice"])
    return m.regression_report(m.predict(model, lines), "l_extendedprice", "predicted")


def returning(t):
    """Many small pseudo users out of the event log: a user and a band of the JSON counter."""
    band = F.floor(F.get_json_object("props", "$.k").cast("int") / 4).cast("int")
    return t.events.select(F.concat_ws("-", "user_id", band).alias("visitor"), "ts", "event_type", "props", "value")


KINDS = ["click", "error", "purchase", "signup", "view"]
_PSEUDO = "SELECT user_id || '-' || (json_extract_string(props, '$.k')::INT // 4) AS visitor, ts, event_type, props FROM events"
_COUNTS = ", ".join(f"COUNT(*) FILTER (e.event_type = '{k}') AS cnt_{k}" for k in KINDS)
CHURN_SQL = f"""
WITH e AS ({_PSEUDO}), f AS (SELECT visitor, MIN(ts) AS first_touch, MAX(ts) AS last_touch, arg_max(event_type, ts) AS event_type, arg_max(props, ts) AS props FROM e GROUP BY 1),
c AS (SELECT e.visitor, {_COUNTS} FROM e JOIN f USING (visitor) WHERE e.ts <= first_touch + INTERVAL 24 HOUR GROUP BY 1)
SELECT f.*, month(first_touch)::INT AS month, dayofyear(first_touch)::INT AS day_of_year, (dayofweek(first_touch) + 1)::INT AS dayofweek, first_touch + INTERVAL 24 HOUR AS horizon_end,
 (last_touch < first_touch + INTERVAL 24 HOUR)::INT AS churned, (last_touch <= first_touch + INTERVAL 10 MINUTE)::INT AS bounced, {', '.join('cnt_' + k for k in KINDS)}
FROM f JOIN c USING (visitor)
"""


def churn(t):
    return m.churn_features(returning(t), "visitor", "ts", "event_type", KINDS, ["event_type", "props"])


@query("ml02_logistic_classifier")
def logistic_classifier(t):
    rows = materialize(churn(t), "churn")
    model = m.train_logistic(rows, "churned", ["event_type"], [f"cnt_{k}" for k in KINDS] + ["day_of_year", "dayofweek"], reg=0.01)
    scored = m.predict(model, rows)
    return m.evaluate(scored, "churned", "probability")


def _probability(t):
    p = F.least(F.greatest(F.col("o_totalprice") / 510000, F.lit(0.001)), F.lit(0.999))
    return t.orders.select("o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("label"), p.alias("p"))


_PROB = "SELECT (o_orderstatus = 'F')::INT AS y, least(greatest(o_totalprice / 510000, 0.001), 0.999) AS p FROM orders"


@query("ml02_metrics", f"""
WITH s AS (SELECT COUNT(*) FILTER (y = 1 AND p >= 0.5) AS tp, COUNT(*) FILTER (y = 0 AND p >= 0.5) AS fp, COUNT(*) FILTER (y = 1 AND p < 0.5) AS fn, COUNT(*) FILTER (y = 0 AND p < 0.5) AS tn,
 AVG(CASE WHEN y = 1 THEN -ln(p) ELSE -ln(1 - p) END) AS ll FROM ({_PROB}))
SELECT ROUND(tp / (tp + fp), 6) AS precision, ROUND(tp / (tp + fn), 6) AS recall, ROUND((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy,
 ROUND(2 * tp / (2 * tp + fp + fn), 6) AS f1_score, ROUND(ll, 6) AS log_loss FROM s
""")
def metrics(t):
    return m.evaluate(_probability(t), "label", "p")


@query("ml02_roc_auc", f"""
WITH r AS (SELECT p, SUM(y) AS pos, SUM(1 - y) AS neg FROM ({_PROB}) GROUP BY 1), c AS (SELECT *, SUM(neg) OVER (ORDER BY p) AS upto FROM r)
SELECT ROUND(SUM(pos * (upto - neg / 2.0))::DOUBLE / (SUM(pos) * SUM(neg))::DOUBLE, 6) AS roc_auc FROM c
""")
def roc_auc(t):
    return m.roc_auc(_probability(t), "label", "p")


@query("ml03_kmeans")
def kmeans(t):
    features = ["l_quantity", "price"]
    rows = t.lineitem.select("l_orderkey", "l_quantity", (F.col("l_extendedprice") / 1000).alias("price"))
    model = m.train_kmeans(rows, features, 5)
    centroids = [c.tolist() for c in model.stages[-1].clusterCenters()]
    near = m.nearest_centroid(rows, centroids, features)
    return near.groupBy("centroid_id").agg(F.count("*").alias("n"), F.round(F.avg("distance"), 4).alias("mean_distance"))


CENTROIDS = [[60.0, 90.0], [200.0, 180.0], [350.0, 270.0]]


@query("ml04_anomalies", """
WITH f AS (SELECT o_orderkey, o_totalprice / 1000 AS x, dayofyear(o_orderdate)::DOUBLE AS y FROM orders),
d AS (SELECT o_orderkey, unnest([{'c': 1, 'd': sqrt(pow(x - 60, 2) + pow(y - 90, 2))}, {'c': 2, 'd': sqrt(pow(x - 200, 2) + pow(y - 180, 2))}, {'c': 3, 'd': sqrt(pow(x - 350, 2) + pow(y - 270, 2))}]) AS s FROM f),
n AS (SELECT o_orderkey, s.c AS c, s.d AS d FROM d QUALIFY ROW_NUMBER() OVER (PARTITION BY o_orderkey ORDER BY s.d, s.c) = 1),
z AS (SELECT *, d / AVG(d) OVER (PARTITION BY c) AS nd FROM n)
SELECT o_orderkey, c::INT AS centroid_id, ROUND(d, 6) AS distance, ROUND(nd, 6) AS normalized_distance,
 ROW_NUMBER() OVER (ORDER BY nd DESC, o_orderkey) <= floor((SELECT COUNT(*) FROM orders) * 0.02) AS is_anomaly FROM z
""")
def anomalies(t):
    rows = t.orders.select("o_orderkey", (F.col("o_totalprice") / 1000).alias("x"), F.dayofyear("o_orderdate").cast("double").alias("y"))
    out = m.detect_anomalies(rows, CENTROIDS, ["x", "y"], 0.02, "o_orderkey")
    return out.select("o_orderkey", "centroid_id", F.round("distance", 6).alias("distance"),
                      F.round("normalized_distance", 6).alias("normalized_distance"), "is_anomaly")


@query("ml05_churn_features", CHURN_SQL)
def churn_rows(t):
    return churn(t)


@query("ml05_churn_rate", f"""
SELECT bounced, COUNT(*) AS users, COUNT(*) FILTER (churned = 1) AS churned_users, ROUND(COUNT(*) FILTER (churned = 1) / COUNT(*), 6) AS churn_rate FROM ({CHURN_SQL}) GROUP BY 1
""")
def churn_rate(t):
    touch = m.touch_features(returning(t), "visitor", "ts")
    return touch.groupBy("bounced").agg(
        F.count("*").alias("users"), F.count_if(F.col("churned") == 1).alias("churned_users"),
        F.round(F.count_if(F.col("churned") == 1) / F.count("*"), 6).alias("churn_rate"))


@query("ml06_explain")
def explain(t):
    lines = priced_lines(t)
    model = m.train_linear(lines, "l_extendedprice", ["l_returnflag"], ["l_quantity", "p_retailprice"])
    top = m.explain(model, lines, "l_orderkey", 2)
    return top.groupBy("feature", "rank").agg(F.count("*").alias("n"), F.round(F.avg("attribution"), 4).alias("mean_attribution"))


@query("ml07_compare_models", """
SELECT l_orderkey, l_linenumber, l_partkey, ROUND(l_extendedprice - l_quantity * 2000, 3) AS diff_a, ROUND(l_extendedprice - l_quantity * 2100, 3) AS diff_b,
 CASE WHEN abs(ROUND(l_extendedprice - l_quantity * 2000, 3)) < abs(ROUND(l_extendedprice - l_quantity * 2100, 3)) THEN 'a' ELSE 'b' END AS winner FROM lineitem
""")
def compare_models(t):
    q = F.col("l_quantity")
    return m.compare_models(t.lineitem, F.col("l_extendedprice"), q * 2000, q * 2100, ("a", "b")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "diff_a", "diff_b", "winner")


@query("ml08_score_grid")
def score_grid(t):
    """Every customer under four scenarios; the best scenario each, then the ten best customers."""
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_totalprice", "c_mktsegment", "o_orderpriority", F.month("o_orderdate").cast("double").alias("month"))
    model = m.train_linear(rows, "o_totalprice", ["c_mktsegment", "o_orderpriority"], ["month"])
    grid = [{"o_orderpriority": p, "month": mo} for p in ("1-URGENT", "5-LOW") for mo in (1.0, 7.0)]
    best = m.score_grid(model, t.customer.select("c_custkey", "c_mktsegment"), grid, "c_custkey", 251000.0)
    return ag.keep_top(best, "c_custkey", "score", 5, 10, "is_high")


@query("ml09_write_prediction")
def write_prediction(t):
    totals = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.avg("o_totalprice").alias("average"), F.count("*").alias("n"))
    rows = t.customer.join(totals, "c_custkey")
    model = m.train_linear(rows, "c_acctbal", ["c_mktsegment"], ["average", "n"])
    return m.write_prediction(rows, model, "c_custkey", "predicted_balance")


SERIES_SQL = "SELECT event_type, datediff('day', DATE '2024-01-01', ts::DATE) AS step, SUM(value) AS y FROM events GROUP BY 1, 2"
FIT_SQL = f"""
WITH s AS ({SERIES_SQL}), f AS (SELECT event_type, COUNT(*) AS n, MAX(step) AS last_step, AVG(step) AS mx, regr_slope(y, step) AS b, regr_intercept(y, step) AS a,
  regr_sxx(y, step) AS sxx, regr_syy(y, step) AS syy, regr_sxy(y, step) AS sxy FROM s GROUP BY 1),
p AS (SELECT event_type, last_step + h AS forecast_step, a + b * (last_step + h) AS yhat, 1.959963984540054 * sqrt((syy - b * sxy) / (n - 2)) * sqrt(1 + 1 / n + pow(last_step + h - mx, 2) / sxx) AS e
  FROM f, generate_series(1, 7) g(h))
SELECT event_type, forecast_step, ROUND(yhat, 4) AS forecast_value, ROUND(yhat - e, 4) AS interval_lower, ROUND(yhat + e, 4) AS interval_upper FROM p
"""


def daily_series(t):
    step = F.date_diff(F.to_date("ts"), F.lit("2024-01-01").cast("date")).cast("long")
    return t.events.groupBy("event_type", step.alias("step")).agg(F.sum("value").alias("y"))


@query("ml10_forecast", FIT_SQL)
def forecast(t):
    fc = m.forecast(daily_series(t), "y", "step", 7, 0.95, ["event_type"])
    return fc.select("event_type", "forecast_step", *[F.round(c, 4).alias(c) for c in ("forecast_value", "interval_lower", "interval_upper")])


@query("ml10_forecast_by_time", f"""
SELECT event_type, (DATE '2024-01-01' + forecast_step::INT)::TIMESTAMP AS forecast_timestamp, forecast_value, interval_lower, interval_upper FROM ({FIT_SQL})
""")
def forecast_by_time(t):
    day = F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")
    daily = t.events.groupBy("event_type", day).agg(F.sum("value").alias("y"))
    fc = m.forecast_by_time(daily, "y", "day", 7, 0.95, ["event_type"])
    return fc.select("event_type", "forecast_timestamp", *[F.round(c, 4).alias(c) for c in ("forecast_value", "interval_lower", "interval_upper")])


_WEEK, _WEIGHTS = 7, se.GRID
SEASONAL_SQL = f"""
WITH RECURSIVE d AS (SELECT event_type, datediff('day', MIN(ts::DATE) OVER (PARTITION BY event_type), ts::DATE) AS i, MIN(ts::DATE) OVER (PARTITION BY event_type) AS began, value FROM events),
s AS (SELECT event_type, began, i, SUM(value) AS y, MAX(i) OVER (PARTITION BY event_type) AS last FROM d GROUP BY event_type, began, i),
w AS (SELECT * FROM (VALUES {", ".join(f"({k}, {a}, {b}, {c})" for k, (a, b, c) in enumerate(_WEIGHTS))}) v(k, a, b, c)),
f AS (SELECT event_type, began, last, AVG(y) FILTER (i < {_WEEK}) AS level, coalesce((AVG(y) FILTER (i >= {_WEEK} AND i < {2 * _WEEK}) - AVG(y) FILTER (i < {_WEEK})) / {_WEEK}, 0) AS trend,
  map_from_entries(list((i, y)) FILTER (i < {_WEEK})) AS seen FROM s GROUP BY 1, 2, 3),
r AS (SELECT event_type, began, last, k, a, b, c, {_WEEK - 1}::BIGINT AS i, level::DOUBLE AS level, trend::DOUBLE AS trend,
    list_transform(range({_WEEK}), lambda q: coalesce(seen[q] - level, 0))::DOUBLE[] AS season, 0::DOUBLE AS sse, 0 AS n FROM f, w
  UNION ALL
  SELECT event_type, began, last, k, a, b, c, i, level + trend + a * e, trend + a * b * e,
    list_transform(range({_WEEK}), lambda q: season[q + 1] + CASE WHEN q = i % {_WEEK} THEN c * (1 - a) * e ELSE 0 END), sse + e * e, n + seen
  FROM (SELECT r.event_type, r.began, r.last, k, a, b, c, r.i + 1 AS i, level, trend, season, sse, n, (y IS NOT NULL)::INT AS seen,
    coalesce(y - (level + trend + season[(r.i + 1) % {_WEEK} + 1]), 0) AS e FROM r LEFT JOIN s ON s.event_type = r.event_type AND s.i = r.i + 1 WHERE r.i < r.last)),
e AS (SELECT * FROM r WHERE i = last AND n > 0 QUALIFY ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY sse, k) = 1),
h AS (SELECT *, unnest(range(1, 8)) AS h, sqrt(sse / n) AS rmse FROM e),
p AS (SELECT *, level + h * trend + season[(last + h) % {_WEEK} + 1] AS v, 1.959963984540054 * rmse * sqrt(1 + coalesce(list_sum(list_transform(range(1, h),
  lambda j: pow(a + a * b * j + CASE WHEN j % {_WEEK} = 0 THEN c * (1 - a) ELSE 0 END, 2))), 0)) AS e FROM h)
SELECT event_type, (began + (last + h)::INT)::TIMESTAMP AS forecast_timestamp, ROUND(v, 4) AS forecast_value, ROUND(v - e, 4) AS interval_lower, ROUND(v + e, 4) AS interval_upper,
 ROUND(rmse, 4) AS backtest_rmse, a::DOUBLE AS level_weight, b::DOUBLE AS trend_weight, c::DOUBLE AS season_weight FROM p
"""


@query("ml10_seasonal_forecast", SEASONAL_SQL)
def seasonal_forecast(t):
    """A week ahead with a season of a week, in steps of the gap found."""
    day = F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")
    daily = t.events.groupBy("event_type", day).agg(F.sum("value").alias("y"))
    fc = se.seasonal_forecast_by_time(daily, "y", "day", "7 DAYS", "7 DAYS", 0.95, ["event_type"])
    rounded = ("forecast_value", "interval_lower", "interval_upper", "backtest_rmse")
    return fc.select("event_type", "forecast_timestamp", *[F.round(c, 4).alias(c) for c in rounded], "level_weight", "trend_weight", "season_weight")


@query("ml11_granularity", """
WITH p AS (SELECT DISTINCT event_type, date_trunc('minute', ts + INTERVAL 30 SECOND) AS mi FROM events),
g AS (SELECT event_type, datediff('second', LAG(mi) OVER (PARTITION BY event_type ORDER BY mi), mi) AS gap FROM p),
c AS (SELECT event_type, gap, COUNT(*) AS n, SUM(COUNT(*)) OVER (PARTITION BY event_type) AS gaps FROM g WHERE gap IS NOT NULL GROUP BY 1, 2)
SELECT event_type, gap AS gap_seconds, gaps::BIGINT AS gaps, ROUND(n / gaps::DOUBLE, 6) AS confidence, ceil(86400 / gap)::INT AS horizon FROM c
QUALIFY ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY n DESC, gap) = 1
""")
def granularity(t):
    """Times are rounded to the nearest minute first; the horizon is one day in steps of the gap found."""
    minute = F.date_trunc("minute", F.col("ts") + F.expr("INTERVAL 30 SECONDS")).cast("timestamp_ntz")
    found = m.infer_granularity(t.events.select("event_type", minute.alias("minute")), "minute", ["event_type"])
    return found.withColumn("horizon", m.horizon_steps(F.lit(86400), F.col("gap_seconds")))


@query("ml12_threshold_crossing", f"""
SELECT event_type, MIN(forecast_step) AS crossing_step FROM ({FIT_SQL.replace('generate_series(1, 7)', 'generate_series(1, 3650)')}) WHERE forecast_value <= 1200 GROUP BY 1
""")
def threshold_crossing(t):
    return m.first_crossing(m.forecast(daily_series(t), "y", "step", 3650, 0.95, ["event_type"]), ["event_type"], 1200)


# --- vectors ---------------------------------------------------------------------------------


@query("vs01_distances", """
SELECT a.vec_id, ROUND(list_cosine_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS cosine, ROUND(list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS euclidean,
 ROUND(-list_inner_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS dot FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1
""")
def distances(t):
    other = t.embeddings.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    a, b = F.col("embedding"), F.col("other")
    return t.embeddings.join(other, "vec_id").select(
        "vec_id", *[F.round(v.distance(a, b, k), 6).alias(k) for k in ("cosine", "euclidean", "dot")])


def label_queries(t):
    """One query vector per label: the first one."""
    first = latest_by(t.embeddings, ["label"], [F.asc("vec_id")])
    return first.select(F.col("label").alias("query_id"), F.col("embedding").alias("q"))


_QUERIES = "SELECT label AS query_id, arg_min(embedding, vec_id)::DOUBLE[] AS q FROM embeddings GROUP BY 1"


@query("vs02_vector_search", f"""
SELECT query_id, vec_id AS base_id, ROUND(d, 6) AS distance, r::INT AS rank FROM (SELECT query_id, vec_id, d, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY ROUND(d, 9), vec_id) AS r
 FROM (SELECT query_id, vec_id, list_cosine_distance(embedding::DOUBLE[], q) AS d FROM embeddings, ({_QUERIES}))) WHERE r <= 5
""")
def vector_search(t):
    near = v.vector_search(t.embeddings, label_queries(t), 5, "cosine", b_id="vec_id", q_vec="q")
    return near.withColumn("distance", F.round("distance", 6))


# Measured (README): these vectors have no near neighbours, so few lists hold them only if each vector lies in several.
LISTS, COPIES, PROBED = 64, 3, 0.25


def hundredth_queries(t):
    """One query vector per id divisible by 100."""
    return t.embeddings.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q"))


def vector_index(t):
    """Codebook and written index of all embeddings."""
    codebook = v.train_codebook(t.embeddings, "embedding", LISTS)
    return codebook, materialize(v.build_index(t.embeddings, codebook, "vec_id", copies=COPIES), "vector-index")


@query("vs03_probed_search")
def probed_search(t):
    codebook, index = vector_index(t)
    return v.search_index(index, codebook, hundredth_queries(t), 5, PROBED, q_vec="q")


@query("vs03_index_recall", """
SELECT COUNT(DISTINCT vec_id) AS queries, true AS recalled FROM embeddings WHERE vec_id % 100 = 0
""")
def index_recall(t):
    """The index against brute force: at least nine in ten of the true neighbours, for every id divisible by 100."""
    exact = v.vector_search(t.embeddings, hundredth_queries(t), 5, "euclidean", b_id="vec_id", q_vec="q")
    found = v.recall(probed_search(t), exact)
    return found.select("queries", (F.col("recall") >= 0.9).alias("recalled"))


@query("vs04_entity_matching", """
WITH p AS (SELECT a.vec_id AS customer, b.vec_id AS driver, list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS d FROM embeddings a JOIN embeddings b ON a.label < 5 AND b.label >= 5),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY customer ORDER BY ROUND(d, 9), driver) AS r FROM p)
SELECT customer, array_to_string(list(driver ORDER BY r), ',') AS drivers FROM r WHERE r <= 3 GROUP BY 1
""")
def entity_matching(t):
    customers = t.embeddings.filter("label < 5").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q"))
    drivers = t.embeddings.filter("label >= 5")
    near = v.vector_search(drivers, customers, 3, "euclidean", b_id="vec_id", q_vec="q")
    return v.match_top(near, "customer", "drivers").select("customer", F.array_join(F.col("drivers").cast("array<string>"), ",").alias("drivers"))


@query("vs05_length_guard", "SELECT label, COUNT(*) FILTER (len(embedding) = 64) AS valid, COUNT(*) FILTER (len(embedding) <> 64) AS invalid FROM embeddings GROUP BY 1")
def length_guard(t):
    ok = v.has_length(F.col("embedding"), 64)
    return t.embeddings.groupBy("label").agg(F.count_if(ok).alias("valid"), F.count_if(~ok).alias("invalid"))


@query("vs06_similarity_split", """
WITH q AS (SELECT arg_min(embedding, vec_id)::DOUBLE[] AS q FROM embeddings WHERE label = 3),
d AS (SELECT label, CASE WHEN list_cosine_distance(embedding::DOUBLE[], q) < 0.9 THEN 'near' ELSE 'far' END AS side FROM embeddings, q)
SELECT side, COUNT(*) AS n, ROUND(AVG(label), 6) AS mean_label FROM d GROUP BY 1
""")
def similarity_split(t):
    probe = t.embeddings.filter("label = 3").agg(F.min_by("embedding", "vec_id")).first()[0]
    split = v.similar_split(t.embeddings, "embedding", probe, 0.9, ("near", "far"))
    return split.groupBy("side").agg(F.count("*").alias("n"), F.round(F.avg("label"), 6).alias("mean_label"))


_TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def named_tables(t):
    return {n: getattr(t, n) for n in _TABLES}


# The text columns of the tables that are not ids.
_TEXTS = [tuple(x.split(".")) for x in (
    "region.r_name nation.n_name customer.c_name customer.c_mktsegment supplier.s_name part.p_name part.p_brand part.p_type orders.o_orderstatus "
    "orders.o_orderpriority lineitem.l_returnflag lineitem.l_linestatus events.event_type events.props documents.text documents.lang documents.source "
    "pages.url pages.html benchmark.text conversations.role conversations.text").split()]


@query("vs07_distinct_values", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, '{c}' AS column_name, {c} AS text_content FROM {n} WHERE {c} IS NOT NULL GROUP BY ALL" for n, c in _TEXTS))
def distinct_values(t):
    return v.distinct_values(named_tables(t))


@query("vs08_text_embedding")
def text_embedding(t):
    docs = t.documents.select("doc_id", "text")
    return v.embed(docs, "text", v.fit_embedder(docs, "text")).select("doc_id", "embedding")


@query("vs09_best_column")
def best_column(t):
    """The column that holds the value nearest to a search text. The values are read twice, to fit and to embed."""
    values = materialize(v.distinct_values(named_tables(t)), "values")
    model = v.fit_embedder(values, "text_content")
    probe = v.embed(spark_of(t).createDataFrame([("machinery",)], "text string"), "text", model)
    return v.best_column(v.embed(values, "text_content", model), probe, "embedding", 3)


# --- text ------------------------------------------------------------------------------------

POSITIVE, NEGATIVE = ["the", "with", "der", "les", "los"], ["not", "to", "nicht", "pas", "no"]
_WORDS = "string_split_regex(lower(text), '[^\\p{L}\\p{N}]+')"


def _hits(words):
    return "+".join(f"len(list_filter({_WORDS}, lambda w: w = '{w}'))" for w in words)


SENTIMENT_SQL = f"CASE WHEN ({_hits(POSITIVE)}) > ({_hits(NEGATIVE)}) THEN 'positive' WHEN ({_hits(NEGATIVE)}) > ({_hits(POSITIVE)}) THEN 'negative' ELSE 'neutral' END"


@query("tx01_text_inference", f"""
WITH d AS (SELECT lang, {SENTIMENT_SQL} AS sentiment FROM documents) SELECT lang, sentiment, COUNT(*) AS n FROM d GROUP BY 1, 2
""")
def text_inference(t):
    """Scored in two runs; the second takes only what the first left, and answers stay raw JSON until counted."""
    scorer = tx.lexicon_scorer(POSITIVE, NEGATIVE)
    first = materialize(tx.infer_text(t.documents.filter("lang = 'en'"), "doc_id", "text", scorer), "scored")
    rest = tx.infer_text(t.documents, "doc_id", "text", scorer, done=first)
    answers = first.unionByName(rest).withColumn("sentiment", F.get_json_object("raw", "$.sentiment"))
    return answers.join(t.documents.select("doc_id", "lang"), "doc_id").groupBy("lang", "sentiment").agg(F.count("*").alias("n"))


CATEGORIES = {"legal": ["license", "copyright"], "contact": ["example", "mail"], "plain": ["the", "de", "la", "der"]}


@query("tx02_classify", f"""
WITH d AS (SELECT lang, {_hits(CATEGORIES['legal'])} AS a, {_hits(CATEGORIES['contact'])} AS b, {_hits(CATEGORIES['plain'])} AS c FROM documents)
SELECT lang, CASE WHEN a + b + c = 0 THEN 'other' WHEN a >= b AND a >= c THEN 'legal' WHEN b >= c THEN 'contact' ELSE 'plain' END AS category, COUNT(*) AS n FROM d GROUP BY 1, 2
""")
def classify(t):
    scorer = tx.keyword_scorer(CATEGORIES, "other")
    return tx.classify(t.documents, "text", scorer).groupBy("category", "lang").agg(F.count("*").alias("n"))


@query("tx03_build_prompt", """
SELECT r_name, 'Describe: ' || string_agg('{"n_name":"' || n_name || '","customers":' || n || '}', chr(10) ORDER BY n_name) || ' end' AS prompt
FROM (SELECT r_name, n_name, COUNT(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2) GROUP BY 1
""")
def build_prompt(t):
    rows = (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy("r_name", "n_name").agg(F.count("*").alias("customers"))
    )
    return tx.build_prompt(rows, ["r_name"], "Describe: {rows} end", "{rows}", "n_name")


@query("tx04_chunk_documents", r"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(text, '\s+'), lambda x: x <> '') AS w FROM documents),
c AS (SELECT doc_id, w, unnest(range(0, len(w), 100)) AS pos FROM w)
SELECT doc_id, (pos // 100)::INT AS chunk_id, array_to_string(w[pos + 1 : pos + 100], ' ') AS content FROM c
""")
def chunk_documents(t):
    return tx.chunk(t.documents, "doc_id", "text", 100)


@query("tx04_nested_chunks", r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents),
s AS (SELECT doc_id, i, unnest(string_split(line, '. ')) AS sentence, generate_subscripts(string_split(line, '. '), 1) - 1 AS j FROM l),
w AS (SELECT doc_id, '$.sections[' || i || '].body[' || j || '].text' AS path, list_filter(string_split_regex(sentence, '\s+'), lambda x: x <> '') AS w FROM s
  UNION ALL SELECT doc_id, '$.meta.title', list_filter(string_split_regex(lang || ' from ' || source, '\s+'), lambda x: x <> '') FROM documents),
c AS (SELECT doc_id, path, w, unnest(range(0, len(w), 20)) AS pos FROM w)
SELECT doc_id, path, (pos // 20)::INT AS chunk_id, array_to_string(w[pos + 1 : pos + 20], ' ') AS content FROM c
""")
def nested_chunks(t):
    """Documents as nested JSON of sections, bodies and sentences; chunks keep the path they come from."""
    body = F.transform(F.split("text", "\n"), lambda line: F.struct(F.transform(F.split(line, r"\. "), lambda x: F.struct(x.alias("text"))).alias("body")))
    meta = F.struct(F.concat_ws(" from ", "lang", "source").alias("title"), F.col("n_chars"))
    nested = t.documents.select("doc_id", F.to_json(F.struct(meta.alias("meta"), body.alias("sections"))).alias("json"))
    return tx.chunk_json(nested, "doc_id", "json", ["text", "title"], 20)


@query("tx05_label_rollup", f"""
WITH d AS (SELECT role, {SENTIMENT_SQL} AS s FROM conversations)
SELECT role, COUNT(*) FILTER (s = 'positive') AS positive_count, COUNT(*) FILTER (s = 'neutral') AS neutral_count, COUNT(*) FILTER (s = 'negative') AS negative_count FROM d GROUP BY 1
""")
def label_rollup(t):
    answers = t.conversations.withColumn("answer", F.concat(F.lit("Sentiment: "), F.initcap(tx.sentiment(F.col("text"), POSITIVE, NEGATIVE))))
    return tx.label_rollup(answers, ["role"], "answer", ["positive", "neutral", "negative"])


@query("tx06_rank_attributes", """
SELECT user_id, event_type, attribute, COUNT(*) AS cnt FROM (SELECT user_id, event_type, 'k' || (json_extract_string(props, '$.k')::INT // 20) AS attribute FROM events) GROUP BY 1, 2, 3
QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY COUNT(*) DESC, attribute) = 1 AND COUNT(*) > 5
""")
def rank_attributes(t):
    band = F.floor(F.get_json_object("props", "$.k").cast("int") / 20).cast("string")
    rows = t.events.select("user_id", "event_type", F.concat(F.lit("k"), band).alias("attribute"))
    return tx.rank_attributes(rows, "user_id", "event_type", "attribute", 5)


# --- function surfaces -----------------------------------------------------------------------


@query("ud01_sql_function", "SELECT o_orderkey, CASE WHEN o_totalprice < 100000 THEN 'short' WHEN o_totalprice < 300000 THEN 'medium' ELSE 'long' END AS band FROM orders")
def sql_function(t):
    spark = spark_of(t)
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION tidemark_band(x DOUBLE) RETURNS STRING
        RETURN CASE WHEN x < 100000 THEN 'short' WHEN x < 300000 THEN 'medium' ELSE 'long' END
    """)
    return spark.sql("SELECT o_orderkey, tidemark_band(o_totalprice) AS band FROM {o}", o=t.orders)


@query("ud02_batched_function", "SELECT part_key, size FROM (SELECT p_partkey AS part_key, length(p_name || p_brand)::VARCHAR AS size FROM part)")
def batched_function(t):
    """A function that answers whole batches, at most 500 calls each."""
    fn = tx.batch_fn("name_size", lambda s: s.str.len().astype(str), 500)
    return t.part.select(F.col("p_partkey").alias("part_key"), fn(F.concat("p_name", "p_brand")).alias("size"))


@query("ud03_table_function", "SELECT o_custkey, o_orderkey, o_totalprice, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey)::INT AS rank FROM orders QUALIFY rank <= 2")
def table_function(t):
    cols = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    return cols.transform(ag.top_per_group, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 2)


@query("ud03_sql_top_rows", "SELECT o_custkey, o_orderkey, o_totalprice, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey)::INT AS rank FROM orders QUALIFY rank <= 2")
def sql_top_rows(t):
    """A table function called from SQL; twice, so that no customer has to fit in one task."""
    tf.register(spark_of(t))
    orders = t.orders.select("o_custkey", "o_orderkey", "o_totalprice", F.pmod(F.xxhash64("o_orderkey"), F.lit(8)).alias("spread"))
    return spark_of(t).sql("""
SELECT * FROM top_rows(TABLE(SELECT o_custkey, o_orderkey, o_totalprice FROM top_rows(TABLE({orders}) PARTITION BY (o_custkey, spread) ORDER BY (o_totalprice DESC, o_orderkey), 2))
 PARTITION BY (o_custkey) ORDER BY (o_totalprice DESC, o_orderkey), 2)""", orders=orders)


@query("ud03_sql_predict", """
WITH m AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem)
SELECT l_orderkey, l_linenumber, l_quantity, ROUND(a + b * l_quantity, 4) AS prediction FROM lineitem, m
""")
def sql_predict(t):
    """A model fitted on the table, handed to a table function as a constant."""
    tf.register(spark_of(t))
    fit = t.lineitem.agg(F.regr_slope("l_extendedprice", "l_quantity").alias("b"), F.regr_intercept("l_extendedprice", "l_quantity").alias("a")).first()
    model = json.dumps({"intercept": fit["a"], "weights": {"l_quantity": fit["b"]}})
    scored = spark_of(t).sql("SELECT * FROM predict_linear(TABLE({lines}), :model)", {"model": model}, lines=t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity"))
    return scored.withColumn("prediction", F.round("prediction", 4))


@query("ud03_sql_forecast", FIT_SQL)
def sql_forecast(t):
    """One forecast a partition, from SQL."""
    tf.register(spark_of(t))
    fc = spark_of(t).sql("SELECT * FROM forecast_linear(TABLE({series}) PARTITION BY (event_type), 'step', 'y', 7, 'event_type')", series=daily_series(t))
    return fc.select("event_type", "forecast_step", *[F.round(c, 4).alias(c) for c in ("forecast_value", "interval_lower", "interval_upper")])


@query("ud04_row_function", "SELECT event_id, value, 1 + (event_id * 7919) % 29120 AS product_id FROM events")
def row_function(t):
    """The row function of the stream job: arithmetic, so a column expression."""
    return t.events.select("event_id", "value", (1 + (F.col("event_id") * 7919) % 29120).alias("product_id"))


@query("ud05_until_done", "SELECT doc_id, length(text)::VARCHAR AS raw FROM documents")
def until_done(t):
    """A loop over unprocessed rows becomes one anti-join and one pass; a further run has nothing to do."""
    def size(text):
        return F.char_length(text).cast("string")

    first = materialize(tx.infer_text(t.documents.filter("n_chars < 2000"), "doc_id", "text", size), "done")
    both = materialize(first.unionByName(tx.infer_text(t.documents, "doc_id", "text", size, done=first)), "done")
    return both.unionByName(tx.infer_text(t.documents, "doc_id", "text", size, done=both))


@query("ud06_per_table_loop", " UNION ALL ".join(f"SELECT '{n}' AS table_name, COUNT(*) AS n FROM {n}" for n in _TABLES))
def per_table_loop(t):
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in named_tables(t).items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
