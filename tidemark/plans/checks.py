"""Data quality, profiling and privacy."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import privacy as pv, quality as q
from tidemark.plans.registry import query, spark_of
from tidemark.session import materialize
from tidemark.sources.readers import inline_rows


def _num(table, cols, other=()):
    rows = [
        f"SELECT '{c}' AS column_name, COUNT(*) AS row_count, COUNT(*) - COUNT({c}) AS null_count, ROUND(AVG({c}::DOUBLE), 4) AS mean, ROUND(stddev_samp({c}::DOUBLE), 4) AS std, MIN({c})::DOUBLE AS lowest, MAX({c})::DOUBLE AS highest FROM {table}"
        for c in cols
    ] + [f"SELECT '{c}', COUNT(*), COUNT(*) - COUNT({c}), NULL, NULL, NULL, NULL FROM {table}" for c in other]
    return " UNION ALL ".join(rows)


@query("dq01_column_profile", _num(
    "lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"],
    ["l_returnflag", "l_linestatus", "l_shipdate"]))
def column_profile(t):
    """The exact part of the profile; its estimates are tested for their error bounds."""
    prof = q.profile(t.lineitem)
    return prof.select("column_name", "row_count", "null_count", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"),
                       F.col("min_value").try_cast("double").alias("lowest"), F.col("max_value").try_cast("double").alias("highest"))


@query("dq01_estimates")
def profile_estimates(t):
    return q.profile(t.orders).select("column_name", "distinct_estimate", "quartiles")


_BY_MONTH = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(*) AS row_count, COUNT(*) - COUNT({c}) AS null_count, "
    + (f"MIN({c})::DOUBLE AS lowest, MAX({c})::DOUBLE AS highest, ROUND(AVG({c}::DOUBLE), 4) AS mean, ROUND(stddev_samp({c}::DOUBLE), 4) AS std, " if num else "NULL AS lowest, NULL AS highest, NULL AS mean, NULL AS std, ")
    + ("(SELECT string_agg(v || ':' || n, ',' ORDER BY n DESC, v) FROM (SELECT " + f"{c}::VARCHAR AS v, COUNT(*) AS n FROM lineitem GROUP BY 1)) AS top, " if not num else "NULL AS top, ")
    + "true AS distinct_holds, true AS median_holds FROM lineitem"
    for c, num in (("l_quantity", True), ("l_extendedprice", True), ("l_returnflag", False), ("l_linestatus", False)))


@query("dq01_merged_profile", _BY_MONTH)
def merged_profile(t):
    """Profiles of each month are kept and add up to that of the table; estimates are held to their bounds."""
    cols = ["l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus"]
    monthly = materialize(q.sketch_profile(t.lineitem.select(F.trunc("l_shipdate", "month").alias("month"), *cols), ["month"]), "monthly-profile")
    prof = materialize(q.read_profile(q.merge_profiles(monthly)), "profile")
    exact = q.profile(t.lineitem.select(*cols), exact=True).select("column_name", F.col("distinct_estimate").alias("distinct"))
    medians = prof.filter("quartiles IS NOT NULL").agg(F.map_from_entries(F.collect_list(F.struct("column_name", F.col("quartiles")[1]))).alias("m"))  # a row a column
    held = medians.scalar()
    below = t.lineitem.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("x")) for c in cols[:2]])).alias("v"))
    ranks = below.groupBy("v.column_name").agg(
        F.avg((F.col("v.x") <= held[F.col("v.column_name")]).cast("double")).alias("upto"), F.avg((F.col("v.x") < held[F.col("v.column_name")]).cast("double")).alias("under"))
    top = F.when(F.col("mean").isNull(), F.array_join(F.transform(F.array_sort(F.transform("top", lambda x: F.struct((-x["n"]).alias("less"), x["value"].alias("value")))), lambda x: F.concat_ws(":", x["value"], (-x["less"]).cast("string"))), ","))
    return prof.join(exact, "column_name").join(ranks, "column_name", "left").select(
        "column_name", "row_count", "null_count", F.col("min_value").try_cast("double").alias("lowest"), F.col("max_value").try_cast("double").alias("highest"),
        F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"), top.alias("top"),
        (F.abs(F.col("distinct_estimate") / F.col("distinct") - 1) <= 0.06).alias("distinct_holds"),
        F.coalesce((F.col("under") <= 0.52) & (F.col("upto") >= 0.48), F.lit(True)).alias("median_holds"))


_TOP_COLS = ["o_orderstatus", "o_orderpriority", "o_custkey"]


@query("dq01_top_values", " UNION ALL ".join(f"""
SELECT * FROM (SELECT '{c}' AS column_name, {c}::VARCHAR AS value, COUNT(*) AS n, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, {c}::VARCHAR)::INT AS rank FROM orders GROUP BY {c}) WHERE rank <= 10
""" for c in _TOP_COLS))
def top_values(t):
    return q.top_values(t.orders, _TOP_COLS, 10)


@query("dq02_profilable_columns", """
SELECT column_name, kept, (SELECT COUNT(*) FROM embeddings) AS row_count FROM (VALUES ('vec_id', true), ('embedding (array<float>)', false), ('label', true)) v(column_name, kept)
""")
def profilable(t):
    kept, skipped = q.profilable(t.embeddings)
    names = inline_rows(spark_of(t), [(c, True) for c in kept] + [(c, False) for c in skipped], "column_name string, kept boolean")
    return names.withColumn("row_count", t.embeddings.agg(F.count("*")).scalar())


RULES = {
    "amount_not_negative": ("correctness", "$column >= 0"),
    "status_listed": ("conformance", "$column IN ('F', 'O')"),
    "value_present": ("completeness", "$column IS NOT NULL", True),
    "key_in_range": ("integrity", "$column BETWEEN 1 AND 1200"),
    "before_cutoff": ("integrity", "$column < TIMESTAMP_NTZ'2001-01-01'"),
    "priority_shape": ("integrity", "$column RLIKE '^[1-5]-[A-Z ]+$'"),
    "five_letters": ("conformance", "LENGTH($column) = 5"),
}
FILTERS = {"NONE": "true", "URGENT": "o_orderpriority = '1-URGENT'", "LARGE": "o_totalprice > 300000"}
_SQL_RULES = {**{k: r[1] for k, r in RULES.items()}, "before_cutoff": "$column < '2001-01-01'", "priority_shape": "regexp_matches($column, '^[1-5]-[A-Z ]+$')"}
BINDINGS = [
    ("amount_not_negative", "o_totalprice", "NONE"), ("status_listed", "o_orderstatus", "NONE"), ("status_listed", "o_orderstatus", "URGENT"),
    ("value_present", "o_custkey", "NONE"), ("key_in_range", "o_custkey", "LARGE"), ("before_cutoff", "o_orderdate", "NONE"),
    ("priority_shape", "o_orderpriority", "NONE"), ("five_letters", "o_orderpriority", "NONE"),
]


def _rules_sql(bindings):
    out = []
    for rule, col, flt in bindings:
        ok = _SQL_RULES[rule].replace("$column", col)
        out.append(f"""
SELECT '{rule}' AS rule_id, '{RULES[rule][0]}' AS dimension, '{col}' AS column_id, '{flt}' AS row_filter, COUNT(*) AS rows_validated, COUNT(*) FILTER ({ok}) AS success_count,
 0::BIGINT AS null_count, COUNT(*) FILTER (NOT ({ok})) AS failed_count, ROUND(COUNT(*) FILTER ({ok}) / COUNT(*), 6) AS success_percentage,
 ROUND(COUNT(*) FILTER (NOT ({ok})) / COUNT(*), 6) AS failed_percentage, 0.0::DOUBLE AS null_percentage FROM orders WHERE {FILTERS[flt]}""")
    return " UNION ALL ".join(out)


@query("dq03_row_rules", _rules_sql([b for b in BINDINGS if b[0] in ("amount_not_negative", "key_in_range", "before_cutoff", "five_letters")]))
def row_rules(t):
    picked = [b for b in BINDINGS if b[0] in ("amount_not_negative", "key_in_range", "before_cutoff", "five_letters")]
    return q.run_rules(t.orders, RULES, picked, FILTERS)


@query("dq04_regex_rule", _rules_sql([b for b in BINDINGS if b[0] == "priority_shape"]))
def regex_rule(t):
    return q.run_rules(t.orders, RULES, [b for b in BINDINGS if b[0] == "priority_shape"], FILTERS)


@query("dq05_set_range_null_rules", """
SELECT 'set' AS rule, COUNT(*) FILTER (o_orderstatus IN ('F', 'O')) / COUNT(*) >= 0.6 AS passed FROM orders
UNION ALL SELECT 'strict_min', COUNT(*) FILTER (o_totalprice > 1000) / COUNT(*) >= 0.999 FROM orders
UNION ALL SELECT 'not_null', COUNT(o_orderkey) / COUNT(*) >= 1 FROM orders
""")
def set_range_null(t):
    """Rules with a threshold on the share of rows that must pass."""
    rules = {"set": ("", "$column IN ('F', 'O')"), "strict_min": ("", "$column > 1000"), "not_null": ("", "$column IS NOT NULL", True)}
    bars = inline_rows(spark_of(t), [("set", 0.6), ("strict_min", 0.999), ("not_null", 1.0)], "rule_id string, bar double")
    found = q.run_rules(t.orders, rules, [("set", "o_orderstatus", "ALL"), ("strict_min", "o_totalprice", "ALL"), ("not_null", "o_orderkey", "ALL")], {"ALL": "true"})
    return found.join(bars, "rule_id").select(F.col("rule_id").alias("rule"), (F.col("success_percentage") >= F.col("bar")).alias("passed"))


def _ruled(name, column, holds, bar, ignore):
    judged = f"COUNT(o.{column})" if ignore else "COUNT(*)"
    return (f"SELECT '{name}' AS rule, '{column}' AS column_name, {judged} AS evaluated, COUNT(*) FILTER ({holds}) AS passed_count, COUNT(*) - COUNT(o.{column}) AS null_count, "
            f"ROUND(COUNT(*) FILTER ({holds}) / {judged}::DOUBLE, 6) AS ratio, {bar}::DOUBLE AS threshold, COUNT(*) FILTER ({holds}) / {judged}::DOUBLE >= {bar} AS passed FROM o")


_HOLED = "WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_totalprice END AS price, o_orderstatus FROM orders) "


@query("dq05_typed_rules", _HOLED + " UNION ALL ".join([
    _ruled("price range", "price", "price > 1000 AND price <= 400000", 0.8, True), _ruled("price range, nulls fail", "price", "price > 1000 AND price <= 400000", 0.8, False),
    _ruled("status", "o_orderstatus", "o_orderstatus IN ('F', 'O')", 0.9, False), _ruled("price there", "price", "price IS NOT NULL", 0.85, False),
    _ruled("open below", "price", "price < 500000", 1.0, True)]))
def typed_rules(t):
    """Bounds that may be strict, missing values that are ignored or fail, and a share of rows that has to pass."""
    price = F.when(F.col("o_orderkey") % 10 != 0, F.col("o_totalprice")).alias("price")
    rules = [
        q.range_rule("price range", "price", 1000, 400000, strict_low=True, threshold=0.8, ignore_null=True),
        q.range_rule("price range, nulls fail", "price", 1000, 400000, strict_low=True, threshold=0.8),
        q.set_rule("status", "o_orderstatus", ["F", "O"], 0.9), q.not_null_rule("price there", "price", 0.85),
        q.range_rule("open below", "price", high=500000, strict_high=True, ignore_null=True),
    ]
    return q.check_rows(t.orders.select("o_orderkey", price, "o_orderstatus"), rules).withColumn("ratio", F.round("ratio", 6))


@query("dq06_duplicates", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem JOIN (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1) USING (l_orderkey, l_linenumber)
""")
def duplicates(t):
    return q.duplicates(t.lineitem, ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("dq07_rule_bindings", _rules_sql(BINDINGS))
def rule_bindings(t):
    return q.run_rules(t.orders, RULES, BINDINGS, FILTERS)


@query("dq08_score_rollup", f"""
WITH r AS ({_rules_sql(BINDINGS)})
SELECT 'table' AS level, COUNT(DISTINCT column_id) AS columns_validated, ROUND(SUM(success_count)::DOUBLE / SUM(rows_validated)::DOUBLE, 6) AS success_percentage,
 ROUND(1 - SUM(success_count)::DOUBLE / SUM(rows_validated)::DOUBLE, 6) AS failed_percentage, 6::BIGINT AS columns_count, (SELECT COUNT(*) FROM orders) AS record_count FROM r
UNION ALL SELECT dimension, COUNT(DISTINCT column_id), ROUND(SUM(success_count)::DOUBLE / SUM(rows_validated)::DOUBLE, 6),
 ROUND(1 - SUM(success_count)::DOUBLE / SUM(rows_validated)::DOUBLE, 6), 6, (SELECT COUNT(*) FROM orders) FROM r GROUP BY dimension
""")
def score_rollup(t):
    """Two runs are on record; the roll-up takes the latest one, for the table and for each dimension."""
    results = materialize(q.run_rules(t.orders, RULES, BINDINGS, FILTERS), "rules")
    earlier = results.withColumns({"run": F.lit(1), "success_count": F.lit(0).cast("long")})
    history = earlier.unionByName(results.withColumn("run", F.lit(2)))
    latest = history.filter(F.col("run") == history.agg(F.max("run")).scalar())
    both = latest.withColumn("level", F.explode(F.array(F.lit("table"), "dimension")))
    return q.score(both, ["level"]).withColumns({
        "columns_count": F.lit(len(t.orders.columns)).cast("long"), "record_count": t.orders.agg(F.count("*")).scalar()})


@query("dq09_orphans", """
SELECT 'orders_of_machinery' AS relation, COUNT(*) AS orphans FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'MACHINERY')
UNION ALL SELECT 'lineitem_orders', COUNT(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'labels_documents', COUNT(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
""")
def orphans(t):
    checks = {
        "orders_of_machinery": q.orphans(t.orders, t.customer.filter("c_mktsegment <> 'MACHINERY'"), "o_custkey", "c_custkey"),
        "lineitem_orders": q.orphans(t.lineitem, t.orders, "l_orderkey", "o_orderkey"),
        "labels_documents": q.orphans(t.documents, t.labels, "doc_id", "doc_id"),
    }
    parts = [df.agg(F.count("*").alias("orphans")).select(F.lit(n).alias("relation"), "orphans") for n, df in checks.items()]
    return parts[0].union(parts[1]).union(parts[2])


_KEYS = {"orders": ["o_orderkey"], "customer": ["c_custkey"], "lineitem": ["l_orderkey", "l_linenumber"], "conversations": ["conv_id", "turn"]}


@query("dq10_key_assertions", " UNION ALL ".join(f"""
SELECT '{n}' AS table_name, SUM(n)::BIGINT AS row_count, COUNT(*) FILTER (n > 1) AS repeated_keys, 0::BIGINT AS null_key_rows FROM (SELECT COUNT(*) AS n FROM {n} GROUP BY {', '.join(k)})
""" for n, k in _KEYS.items()))
def key_assertions(t):
    out = None
    for name, keys in _KEYS.items():
        part = q.key_check(getattr(t, name), keys).withColumn("table_name", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


@query("dq11_table_condition", """
SELECT (SELECT AVG(o_totalprice) > 200000 FROM orders) AS average_high, COUNT(*) FILTER (o_totalprice <= 3 * (SELECT AVG(o_totalprice) FROM orders)) AS within, COUNT(*) AS row_count FROM orders
""")
def table_condition(t):
    average = t.orders.agg(F.avg("o_totalprice")).scalar()
    return t.orders.agg(
        F.count_if(F.col("o_totalprice") <= 3 * average).alias("within"), F.count("*").alias("row_count")
    ).withColumn("average_high", average > 200000)


@query("dq12_recommend_rules")
def recommend_rules(t):
    return q.recommend_rules(t.orders, q.profile(t.orders))


@query("dq13_quarantine_repair", """
SELECT event_id, least(value, 100) AS value, CASE WHEN event_type = 'error' THEN 'view' ELSE event_type END AS event_type, value > 100 OR event_type = 'error' AS repaired FROM events
""")
def quarantine_repair(t):
    rules = {"value_range": "value BETWEEN 0 AND 100", "known_type": "event_type IN ('click', 'purchase', 'signup', 'view')"}
    good, bad = q.quarantine(t.events.select("event_id", "value", "event_type"), rules)
    fixed = q.repair(bad, {"value_range": ("value", F.lit(100.0)), "known_type": ("event_type", F.lit("view"))})
    return good.withColumn("repaired", F.lit(False)).unionByName(fixed.withColumn("repaired", F.lit(True)))


def _luhn(c):
    digit = f"substr(regexp_replace({c}, '[^0-9]', '', 'g'), i, 1)::INT"
    return f"list_sum(list_transform(range(1, 17), lambda i: CASE WHEN i % 2 = 0 THEN {digit} WHEN {digit} > 4 THEN {digit} * 2 - 9 ELSE {digit} * 2 END)) % 10 = 0"


def _found(kind, extra=""):
    return f"SELECT doc_id, 'text' AS column_name, '{kind}' AS info_type, quote FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{q.SENSITIVE[kind]}')) AS quote FROM documents) {extra}"


_KINDS = ["EMAIL_ADDRESS", "IP_ADDRESS", "CREDIT_CARD_NUMBER", "US_SOCIAL_SECURITY_NUMBER", "DATE", "GENDER"]
FINDINGS_SQL = " UNION ALL ".join(_found(k, f"WHERE {_luhn('quote')}" if k == "CREDIT_CARD_NUMBER" else "") for k in _KINDS)


@query("dq14_sensitive_scan", FINDINGS_SQL)
def sensitive_scan(t):
    return q.scan_sensitive(t.documents, "doc_id", ["text"], _KINDS)


@query("dq14_name_scan", r"""
WITH n AS (SELECT DISTINCT regexp_extract(text, '^\p{L}+') AS name FROM benchmark),
w AS (SELECT DISTINCT doc_id, unnest(string_split_regex(text, '[^\p{L}]+')) AS name FROM documents)
SELECT doc_id, 'text' AS column_name, 'PERSON_NAME' AS info_type, name AS quote FROM w JOIN n USING (name) WHERE name <> ''
""")
def name_scan(t):
    """Dictionary words: here the first words of the benchmark texts."""
    names = t.benchmark.select(F.regexp_extract("text", r"^\p{L}+", 0).alias("name"))
    return q.scan_names(t.documents, "doc_id", "text", names, "name")


def people(t):
    """Customers with contact columns derived from their key."""
    key = F.col("c_custkey")
    return t.customer.withColumns({
        "email": F.concat(F.lit("user"), key.cast("string"), F.lit("@example.com")),
        "card": F.concat(F.lit("4000-1234-5678-"), F.lpad((key % 10000).cast("string"), 4, "0")),
        "ip": F.concat_ws(".", F.lit("10"), key % 250, key % 100, key % 10),
    })


PEOPLE_SQL = """
SELECT *, 'user' || c_custkey || '@example.com' AS email, '4000-1234-5678-' || lpad((c_custkey % 10000)::VARCHAR, 4, '0') AS card,
 '10.' || (c_custkey % 250) || '.' || (c_custkey % 100) || '.' || (c_custkey % 10) AS ip FROM customer
"""


def _last4(c):
    return f"repeat('X', length({c}) - 4) || right({c}, 4)"


@query("dq15_masks", f"""
SELECT c_custkey, {_last4('card')} AS card, left(c_name, 4) || repeat('X', length(c_name) - 4) AS name, NULL::VARCHAR AS segment, sha256(ip) AS ip, 'XXXXX@example.com' AS email, 0.0::DOUBLE AS balance FROM ({PEOPLE_SQL})
""")
def masks(t):
    c = F.col
    return people(t).select(
        "c_custkey", pv.mask(c("card"), "LAST_FOUR").alias("card"), pv.mask(c("c_name"), "FIRST_FOUR").alias("name"),
        pv.mask(c("c_mktsegment"), "ALWAYS_NULL").alias("segment"), pv.mask(c("ip"), "SHA256").alias("ip"),
        pv.mask(c("email"), "EMAIL_MASK").alias("email"), pv.mask(c("c_acctbal"), "DEFAULT", "double").alias("balance"))


POLICIES = {
    "card": {"manager": "LAST_FOUR"}, "c_acctbal": {"manager": "CLEAR"}, "ip": {"manager": "LAST_FOUR", "employee": "SHA256"},
    "email": {"manager": "EMAIL_MASK", "employee": "EMAIL_MASK"}, "c_name": {"manager": "FIRST_FOUR", "employee": "LAST_FOUR"},
}


@query("dq16_role_view", f"""
SELECT 'manager' AS role, c_custkey, left(c_name, 4) || repeat('X', length(c_name) - 4) AS c_name, c_nationkey, c_mktsegment, c_acctbal, 'XXXXX@example.com' AS email,
 {_last4('card')} AS card, {_last4('ip')} AS ip FROM ({PEOPLE_SQL})
UNION ALL SELECT 'employee', c_custkey, {_last4('c_name')}, c_nationkey, c_mktsegment, NULL, 'XXXXX@example.com', NULL, sha256(ip) FROM ({PEOPLE_SQL})
""")
def role_view(t):
    """A denied column is missing from the employee's view, so it is NULL in the union."""
    views = [pv.role_view(people(t), POLICIES, r).withColumn("role", F.lit(r)) for r in ("manager", "employee")]
    return views[0].unionByName(views[1], allowMissingColumns=True)


@query("dq17_row_access", """
SELECT 'anna' AS who, o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F' OR o_totalprice > 400000
UNION ALL SELECT 'bob', o_orderkey, o_orderstatus FROM orders WHERE o_totalprice > 400000
""")
def row_access(t):
    """Grants of one user add up; a user without grants sees nothing."""
    rules = [({"anna"}, F.col("o_orderstatus") == "F"), ({"anna", "bob"}, F.col("o_totalprice") > 400000)]
    seen = [pv.row_access(t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice"), rules, u).withColumn("who", F.lit(u)) for u in ("anna", "bob", "carl")]
    return seen[0].unionByName(seen[1]).unionByName(seen[2]).drop("o_totalprice")


@query("dq18_entitlements", """
SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 2)
""")
def entitlements(t):
    grants = t.nation.select(F.concat(F.lit("user"), F.col("n_regionkey").cast("string")).alias("user"), F.col("n_nationkey").alias("c_nationkey"))
    return pv.entitled(t.customer, grants, "user2", "c_nationkey").select("c_custkey", "c_nationkey")


@query("dq19_crypto_shredding", "SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_mktsegment <> 'FURNITURE'")
def crypto_shredding(t):
    """One key per customer; after the keys of one segment are disabled its rows can no longer be read."""
    cols = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    keys = pv.make_keys(cols, "c_custkey", "test secret")
    sealed = materialize(pv.encrypt(cols, keys, "c_custkey", ["c_name", "c_mktsegment"]), "sealed")
    left = pv.shred(keys, "c_custkey", t.customer.filter("c_mktsegment = 'FURNITURE'"))
    return pv.decrypt(sealed, left, "c_custkey", ["c_name", "c_mktsegment"])


@query("dq20_anonymize_table", f"""
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 'XXXXX@example.com' AS email, sha256(ip) AS ip,
 {_last4('card')} AS card FROM ({PEOPLE_SQL})
""")
def anonymize_table(t):
    """Findings per column choose the mask."""
    rows = people(t).withColumn("card", F.concat(F.lit("4539-1488-0343-6467 "), F.col("card")))
    found = q.scan_sensitive(rows, "c_custkey", ["c_name", "c_mktsegment", "email", "card", "ip"], _KINDS)
    out = pv.anonymize(rows, pv.plan_from_findings(rows, found, "KEEP"))
    return out.withColumn("card", F.right("card", F.lit(19)))


@query("dq21_latest_findings", f"""
SELECT column_name, info_type, MAX(doc_id) AS doc_id FROM ({FINDINGS_SQL}) GROUP BY 1, 2
""")
def latest_findings(t):
    found = q.scan_sensitive(t.documents, "doc_id", ["text"], _KINDS)
    return q.latest_findings(found, ["column_name", "info_type"], [F.desc("doc_id"), F.asc("quote")]).select("column_name", "info_type", "doc_id")
