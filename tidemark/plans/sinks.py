"""Sinks and table maintenance. Each query writes tables to the shared folder and reads them back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tidemark.plans.registry import query, spark_of
from tidemark.session import materialize, scratch_path
from tidemark.sources import changes as ch, tables as w
from tidemark.sources.readers import read_table


def _new(t, label):
    return scratch_path(spark_of(t), label)


@query("snk01_create_table_as", """
SELECT o_orderpriority, COUNT(*) AS orders, ROUND(AVG(o_totalprice), 4) AS average FROM orders GROUP BY 1
""")
def create_table_as(t):
    df = t.orders.groupBy("o_orderpriority").agg(F.count("*").alias("orders"), F.round(F.avg("o_totalprice"), 4).alias("average"))
    return read_table(spark_of(t), w.write_table(df, _new(t, "ctas")))


@query("snk02_load_files", """
SELECT s_suppkey, s_name, s_acctbal FROM supplier UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier WHERE s_acctbal > 5000
""")
def load_files(t):
    spark, path = spark_of(t), _new(t, "load")
    cols = t.supplier.select("s_suppkey", "s_name", "s_acctbal")
    staged = w.write_table(cols, _new(t, "stage"), "csv", options={"header": "true"})
    files = read_table(spark, staged, "csv", "s_suppkey bigint, s_name string, s_acctbal double", {"header": "true"})
    w.write_table(files, path, mode="overwrite")
    w.write_table(files.filter("s_acctbal > 5000"), path, mode="append")
    return read_table(spark, path)


@query("snk03_export_formats", """
SELECT f.fmt, s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier, (VALUES ('parquet'), ('json'), ('csv'), ('orc')) f(fmt)
""")
def export_formats(t):
    spark, out = spark_of(t), None
    for fmt, codec in (("parquet", "snappy"), ("json", "gzip"), ("csv", "gzip"), ("orc", "snappy")):
        path = w.write_table(t.supplier, _new(t, fmt), fmt, options={"compression": codec})
        part = read_table(spark, path, fmt, t.supplier.schema).withColumn("fmt", F.lit(fmt))
        out = part if out is None else out.unionByName(part)
    return out


@query("snk04_partitioned_write", """
SELECT year(ts)::INT AS year, month(ts)::INT AS month, day(ts)::INT AS day, hour(ts)::INT AS hour, COUNT(*) AS events, ROUND(SUM(value), 2) AS total FROM events GROUP BY 1, 2, 3, 4
""")
def partitioned_write(t):
    parts = {"year": F.year("ts"), "month": F.month("ts"), "day": F.dayofmonth("ts"), "hour": F.hour("ts")}
    path = w.write_table(t.events.withColumns(parts), _new(t, "parts"), partition_by=list(parts))
    scan = read_table(spark_of(t), path, schema="value double, year int, month int, day int, hour int")
    return scan.groupBy(*parts).agg(F.count("*").alias("events"), F.round(F.sum("value"), 2).alias("total"))


@query("snk05_compact_files", """
SELECT 'before' AS stage, 64::BIGINT AS files, COUNT(*) AS row_count, SUM(l_quantity) AS quantity FROM lineitem
UNION ALL SELECT 'after', 4, COUNT(*), SUM(l_quantity) FROM lineitem
""")
def compact_files(t):
    spark, many = spark_of(t), _new(t, "small")
    w.write_table(t.lineitem.repartition(64), many)
    few = w.compact(spark, many, _new(t, "compact"), 4)

    def stats(stage, path):
        return read_table(spark, path).agg(
            F.count_distinct("_metadata.file_path").alias("files"), F.count("*").alias("row_count"), F.sum("l_quantity").alias("quantity")
        ).withColumn("stage", F.lit(stage))

    return stats("before", many).unionByName(stats("after", few))


@query("snk06_clustered_layout", """
SELECT l_shipdate::DATE AS day, COUNT(*) AS row_count, SUM(l_quantity) AS quantity FROM lineitem
WHERE l_shipdate BETWEEN '1997-03-01' AND '1997-03-31' GROUP BY 1
""")
def clustered_layout(t):
    path = w.write_clustered(t.lineitem, _new(t, "clustered"), ["l_shipdate", "l_suppkey"])
    scan = read_table(spark_of(t), path).filter("l_shipdate BETWEEN TIMESTAMP_NTZ'1997-03-01' AND TIMESTAMP_NTZ'1997-03-31'")
    return scan.groupBy(F.to_date("l_shipdate").alias("day")).agg(F.count("*").alias("row_count"), F.sum("l_quantity").alias("quantity"))


_CUTS = {"l_shipdate": "l_shipdate BETWEEN TIMESTAMP'1997-03-01' AND TIMESTAMP'1997-03-31'", "l_suppkey": "l_suppkey <= 2", "l_extendedprice": "l_extendedprice < 5000"}


@query("snk06_curve_layout", " UNION ALL ".join(f"""
SELECT '{c}' AS filtered, COUNT(*) FILTER ({f}) AS row_count, ROUND(SUM(l_quantity) FILTER ({f}), 2) AS quantity, true AS skips FROM lineitem""" for c, f in _CUTS.items()))
def curve_layout(t):
    """One layout for filters on three columns: each leaves out at least a third of the files by their bounds."""
    path = w.write_clustered(t.lineitem, _new(t, "curve"), list(_CUTS), 64)
    table = read_table(spark_of(t), path)
    bounds = materialize(w.file_bounds(table, list(_CUTS)), "bounds")
    limits = {"l_shipdate": ("TIMESTAMP_NTZ'1997-03-01'", "TIMESTAMP_NTZ'1997-03-31'"), "l_suppkey": ("0", "2"), "l_extendedprice": ("0", "5000")}
    out = []
    for c, f in _CUTS.items():
        lo, hi = limits[c]
        left = bounds.agg((F.count_if(F.expr(f"max_{c} >= {lo} AND min_{c} <= {hi}")) * 3 <= F.count("*") * 2).alias("skips"))
        hit = table.filter(f.replace("TIMESTAMP'", "TIMESTAMP_NTZ'")).agg(F.count("*").alias("row_count"), F.round(F.sum("l_quantity"), 2).alias("quantity"))
        out.append(hit.select(F.lit(c).alias("filtered"), "row_count", "quantity", left.scalar().alias("skips")))
    return reduce(lambda a, b: a.unionByName(b), out)


@query("snk07_insert_append", "SELECT o_orderstatus, COUNT(*) AS orders FROM orders GROUP BY 1")
def insert_append(t):
    path = _new(t, "append")
    for status in ("F", "O", "P"):
        w.write_table(t.orders.filter(F.col("o_orderstatus") == status), path, mode="append")
    return read_table(spark_of(t), path).groupBy("o_orderstatus").agg(F.count("*").alias("orders"))


@query("snk08_delete_where", """
SELECT COUNT(*) AS total, COUNT(*) FILTER (o_totalprice < 100000) AS deleted, COUNT(*) FILTER (o_totalprice >= 100000) AS kept FROM orders
""")
def delete_where(t):
    """The table without the deleted rows is a new table next to the old one."""
    spark = spark_of(t)
    before = read_table(spark, w.write_table(t.orders, _new(t, "before")))
    after = read_table(spark, w.write_table(w.delete_where(before, F.col("o_totalprice") < 100000), _new(t, "after")))
    return before.agg(F.count("*").alias("total"), F.count_if(F.col("o_totalprice") < 100000).alias("deleted")).withColumn(
        "kept", after.agg(F.count("*")).scalar())


@query("snk09_update_where", """
SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN 'X' ELSE o_orderstatus END AS o_orderstatus, COUNT(*) AS orders FROM orders GROUP BY 1
""")
def update_where(t):
    df = w.update_where(t.orders, F.col("o_orderpriority") == "1-URGENT", {"o_orderstatus": F.lit("X")})
    return read_table(spark_of(t), w.write_table(df, _new(t, "update"))).groupBy("o_orderstatus").agg(F.count("*").alias("orders"))


@query("snk10_update_from", """
SELECT c_custkey, c_name, c_nationkey, COALESCE(s.total, c_acctbal) AS c_acctbal, c_mktsegment
FROM customer LEFT JOIN (SELECT o_custkey, ROUND(SUM(o_totalprice), 2) AS total FROM orders GROUP BY 1) s ON s.o_custkey = c_custkey
""")
def update_from(t):
    totals = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.round(F.sum("o_totalprice"), 2).alias("total"))
    return w.update_from(t.customer, totals, "c_custkey", {"c_acctbal": "total"})


@query("snk11_truncate_reload", "SELECT p_brand, COUNT(*) AS parts FROM part WHERE p_size > 25 GROUP BY 1")
def truncate_reload(t):
    path = _new(t, "reload")
    w.write_table(t.part, path)
    w.write_table(t.part.filter("p_size > 25"), path, mode="overwrite")
    return read_table(spark_of(t), path).groupBy("p_brand").agg(F.count("*").alias("parts"))


@query("snk12_schema_evolution", """
SELECT o_orderkey, o_totalprice, CASE WHEN o_orderstatus = 'F' THEN 'none' ELSE o_orderpriority END AS priority FROM orders
""")
def schema_evolution(t):
    """Old files lack a column; new files have it; a merged read sees NULLs, which are backfilled."""
    path = _new(t, "evolve")
    old = t.orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice")
    new = t.orders.filter("o_orderstatus <> 'F'").select("o_orderkey", "o_totalprice", F.col("o_orderpriority").alias("priority"))
    w.write_table(old, path)
    w.write_table(new, path, mode="append")
    merged = read_table(spark_of(t), path, options={"mergeSchema": "true"})
    return w.update_where(w.add_columns(merged, {"priority": "string"}), F.col("priority").isNull(), {"priority": F.lit("none")})


@query("snk15_materialized_view", """
SELECT l_returnflag, year(l_shipdate)::INT AS year, SUM(l_quantity) AS quantity, ROUND(SUM(l_extendedprice), 2) AS revenue,
       COUNT(*) AS row_count, ROUND(SUM(l_quantity) / COUNT(*), 6) AS average_quantity
FROM lineitem GROUP BY 1, 2
""")
def materialized_view(t):
    """Built over the older rows, refreshed with the newer ones, then rolled up from days to years."""
    keys = [F.col("l_returnflag"), F.to_date("l_shipdate").alias("day")]
    sums = {"quantity": F.col("l_quantity"), "revenue": F.col("l_extendedprice")}
    split = "coalesce(l_shipdate < TIMESTAMP_NTZ'1999-01-01', false)"
    spark = spark_of(t)
    mv = read_table(spark, w.write_table(ch.create_mv(t.lineitem.filter(split), keys, sums), _new(t, "mv")))
    fresh = ch.create_mv(t.lineitem.filter(f"NOT ({split})"), keys, sums)
    view = read_table(spark, w.write_table(ch.refresh_mv(mv, fresh, ["l_returnflag", "day"]), _new(t, "mv")))
    return view.groupBy("l_returnflag", F.year("day").alias("year")).agg(
        F.sum("quantity").alias("quantity"), F.round(F.sum("revenue"), 2).alias("revenue"), F.sum("row_count").alias("row_count"),
        F.round(F.sum("quantity") / F.sum("row_count"), 6).alias("average_quantity"),
    )


@query("snk15_join_view", """
SELECT p_brand, s_nationkey, year(l_shipdate)::INT AS year, SUM(l_quantity) AS quantity, COUNT(*) AS row_count
FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1, 2, 3
""")
def join_view(t):
    """A view over a join: only new lines are joined when it is refreshed."""
    spark, keys, sums = spark_of(t), [F.col("p_brand"), F.col("s_nationkey"), F.year("l_shipdate").alias("year")], {"quantity": F.col("l_quantity")}

    def joined(lines):
        return lines.join(t.part, F.col("p_partkey") == F.col("l_partkey")).join(t.supplier, F.col("s_suppkey") == F.col("l_suppkey"))

    split = F.coalesce(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"), F.lit(False))  # lines without a date are new
    view = read_table(spark, w.write_table(ch.create_mv(joined(t.lineitem.filter(split)), keys, sums), _new(t, "mv")))
    fresh = ch.create_mv(joined(t.lineitem.filter(~split)), keys, sums)
    return read_table(spark, w.write_table(ch.refresh_mv(view, fresh, ["p_brand", "s_nationkey", "year"]), _new(t, "mv")))


@query("snk16_incremental_model", "SELECT event_id, ts, user_id, event_type, value FROM events")
def incremental_model(t):
    """First run loads the first half of the month; the second only what is newer than a two-hour lookback."""
    spark = spark_of(t)
    src = t.events.select("event_id", "ts", "user_id", "event_type", "value")
    checks = {"value_positive": "value >= 0", "user_known": "user_id IS NOT NULL"}
    path = _new(t, "inc")
    w.write_table(ch.run_incremental(src.filter("ts < TIMESTAMP_NTZ'2024-01-15'"), None, ["event_id"], "ts", "2 hours", checks), path)
    more = ch.run_incremental(src, read_table(spark, path), ["event_id"], "ts", "2 hours", checks)
    w.write_table(more, path, mode="append")
    return read_table(spark, path)


@query("snk17_copy_table", "SELECT * FROM supplier")
def copy_table(t):
    return read_table(spark_of(t), w.copy_table(spark_of(t), t.path("supplier"), _new(t, "copy")))


@query("snk18_keyed_upsert", """
SELECT event_id, ts, user_id, event_type, value FROM events QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""")
def keyed_upsert(t):
    df = t.events.select("event_id", "ts", "user_id", "event_type", "value")
    current = ch.keyed_upsert(df.filter("ts < TIMESTAMP_NTZ'2024-01-10'"), df.limit(0), ["user_id"], ["ts", "event_id"])
    return ch.keyed_upsert(current, df.filter("ts >= TIMESTAMP_NTZ'2024-01-10'"), ["user_id"], ["ts", "event_id"])


@query("snk18_partition_upsert", """
SELECT event_id, CASE WHEN event_type = 'error' AND ts >= '2024-01-20' THEN value + 1 ELSE value END AS value, event_type, ts::DATE AS day,
 CASE WHEN event_type = 'error' AND ts >= '2024-01-20' THEN 2 ELSE 1 END AS seq FROM events
""")
def partition_upsert(t):
    """Corrections of the last days go into a table by day; the folders of earlier days stay as they are."""
    df = t.events.select("event_id", "value", "event_type", F.lit(1).alias("seq"), F.to_date("ts").alias("day"))
    path = w.write_table(df, _new(t, "byday"), partition_by=["day"])
    fixes = df.filter("event_type = 'error' AND day >= DATE'2024-01-20'").withColumns({"value": F.col("value") + 1, "seq": F.lit(2)})
    ch.upsert_partitions(path, fixes, ["event_id"], ["seq"], "day")
    return read_table(spark_of(t), path, schema=df.schema)


def order_changes(t):
    """Change log on orders: closes finished ones, raises pending ones, drops the urgent, adds copies of the low."""
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
    o = t.orders
    log = o.filter("o_orderstatus = 'F'").select(*cols, F.lit("U").alias("op"), F.lit(1).alias("seq")).withColumn("o_orderstatus", F.lit("C"))
    log = log.unionByName(o.filter("o_orderstatus = 'P'").select(*cols, F.lit("U").alias("op"), F.lit(2).alias("seq")).withColumn("o_totalprice", F.col("o_totalprice") + 1))
    log = log.unionByName(o.filter("o_orderpriority = '1-URGENT'").select(*cols, F.lit("D").alias("op"), F.lit(3).alias("seq")))
    extra = o.filter("o_orderpriority = '5-LOW'").select(*cols, F.lit("I").alias("op"), F.lit(1).alias("seq"))
    return log.unionByName(extra.withColumn("o_orderkey", -F.col("o_orderkey") - 1)), cols


ORDER_STATE_SQL = """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'F' THEN 'C' ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
FROM orders WHERE o_orderpriority <> '1-URGENT'
UNION ALL SELECT -o_orderkey - 1, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderpriority = '5-LOW'
"""


@query("snk19_apply_changes", ORDER_STATE_SQL)
def apply_changes(t):
    log, cols = order_changes(t)
    return ch.apply_changes(t.orders.select(*cols), log, ["o_orderkey"], "op", ["seq"])
