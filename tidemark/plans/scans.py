"""Scans and sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans.registry import query, spark_of
from tidemark.session import scratch_path
from tidemark.sources import readers as r
from tidemark.sources.discovery import discover_columns
from tidemark.sources.tables import write_table


@query("src01_parquet_scan", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice > 250000
""")
def parquet_scan(t):
    return t.orders.filter("o_totalprice > 250000").select("o_orderkey", "o_custkey", "o_totalprice")


@query("src02_csv_scan", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, NULLIF(c_mktsegment, 'MACHINERY') AS c_mktsegment FROM customer")
def csv_scan(t):
    marked = t.customer.withColumn("c_mktsegment", F.expr("nullif(c_mktsegment, 'MACHINERY')"))
    opts = {"sep": "|", "header": "true", "nullValue": "\\N"}
    path = write_table(marked, scratch_path(spark_of(t), "csv"), "csv", options=opts)
    schema = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    return r.read_table(spark_of(t), path, "csv", schema, opts)


@query("src03_json_scan", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def json_scan(t):
    path = write_table(t.customer, scratch_path(spark_of(t), "json"), "json")
    return r.read_table(spark_of(t), path, "json", t.customer.schema)


@query("src04_avro_scan", """
SELECT o_orderkey, o_totalprice::DECIMAL(15,2) AS price, o_orderdate::DATE AS day, o_orderdate AS at FROM orders
""")
def avro_scan(t):
    """Decimal, date and timestamp columns; parquet stands in where the avro package is not installed."""
    spark = spark_of(t)
    df = t.orders.select(
        "o_orderkey", F.col("o_totalprice").cast("decimal(15,2)").alias("price"),
        F.to_date("o_orderdate").alias("day"), F.col("o_orderdate").alias("at"),
    )
    path = scratch_path(spark, "avro")
    try:
        return r.read_table(spark, write_table(df, path, "avro"), "avro", df.schema)
    except Exception as e:
        if "avro" not in str(e).lower():
            raise
        return r.read_table(spark, write_table(df, path), "parquet", df.schema)


@query("src05_hive_partition_scan", """
SELECT year(o_orderdate)::INT AS year, month(o_orderdate)::INT AS month, COUNT(*) AS orders, ROUND(SUM(o_totalprice), 2) AS total
FROM orders WHERE year(o_orderdate) = 1997 AND month(o_orderdate) BETWEEN 4 AND 9 GROUP BY 1, 2
""")
def hive_partition_scan(t):
    df = t.orders.withColumns({"year": F.year("o_orderdate"), "month": F.month("o_orderdate")})
    path = write_table(df, scratch_path(spark_of(t), "hive"), partition_by=["year", "month"])
    schema = "o_orderkey bigint, o_totalprice double, year int, month int"
    scan = r.read_table(spark_of(t), path, "parquet", schema)
    return (
        scan.filter("year = 1997 AND month BETWEEN 4 AND 9").groupBy("year", "month")
        .agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    )


@query("src06_json_text_scan", """
SELECT event_type, COUNT(*) AS n, ROUND(SUM(value), 2) AS total, MAX(json_extract_string(props, '$.k')::BIGINT) AS max_k
FROM events GROUP BY event_type
""")
def json_text_scan(t):
    text = t.events.select(F.to_json(F.struct("event_type", "value", F.from_json("props", "k bigint").alias("props"))).alias("value"))
    path = write_table(text, scratch_path(spark_of(t), "jsontext"), "text")
    fields = {"event_type": "$.event_type string", "amount": "$.value double", "k": "$.props.k bigint"}
    return r.read_json_lines_as_text(spark_of(t), path, fields).groupBy("event_type").agg(
        F.count("*").alias("n"), F.round(F.sum("amount"), 2).alias("total"), F.max("k").alias("max_k")
    )


@query("src07_union_drifted_files", """
SELECT o_orderkey, o_custkey, o_totalprice::DECIMAL(15,2) AS o_totalprice, o_orderdate::DATE AS o_orderdate,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS o_orderpriority
FROM orders
""")
def union_drifted_files(t):
    spark, root = spark_of(t), scratch_path(spark_of(t), "drift")
    f = t.orders.filter("o_orderstatus = 'F'").selectExpr(
        "CAST(o_orderkey AS INT) o_orderkey", "o_custkey", "CAST(o_totalprice AS DECIMAL(15,2)) o_totalprice", "o_orderdate", "o_orderpriority")
    o = t.orders.filter("o_orderstatus = 'O'").selectExpr(
        "o_orderkey", "CAST(o_custkey AS STRING) o_custkey", "o_totalprice", "CAST(o_orderdate AS STRING) o_orderdate", "o_orderpriority")
    p = t.orders.filter("o_orderstatus = 'P'").selectExpr("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    paths = [write_table(df, f"{root}/{name}") for name, df in (("f", f), ("o", o), ("p", p))]
    casts = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "decimal(15,2)", "o_orderdate": "date", "o_orderpriority": "string"}
    return r.union_files(spark, paths, casts, list(casts))


@query("src08_remote_aggregate_join", """
SELECT n.n_name, s.suppliers, s.balance, c.customers
FROM (SELECT s_nationkey, COUNT(*) AS suppliers, ROUND(SUM(s_acctbal), 2) AS balance FROM supplier GROUP BY 1) s
JOIN nation n ON n.n_nationkey = s.s_nationkey
JOIN (SELECT c_nationkey, COUNT(*) AS customers FROM customer GROUP BY 1) c ON c.c_nationkey = s.s_nationkey
""")
def remote_aggregate_join(t):
    """The remote side runs its own aggregate and only sends that; a second parquet root stands in for it."""
    spark = spark_of(t)
    remote = r.read_table(spark, write_table(t.supplier, scratch_path(spark, "remote")))
    sent = remote.groupBy("s_nationkey").agg(F.count("*").alias("suppliers"), F.round(F.sum("s_acctbal"), 2).alias("balance"))
    local = t.customer.groupBy("c_nationkey").agg(F.count("*").alias("customers"))
    return (
        sent.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(local, F.col("s_nationkey") == F.col("c_nationkey"))
        .select("n_name", "suppliers", "balance", "customers")
    )


@query("src09_manifest_scan", """
SELECT o_orderstatus, COUNT(*) AS orders, ROUND(SUM(o_totalprice), 2) AS total
FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY 1
""")
def manifest_scan(t):
    """Live files are those of two partitions; the manifest was written under another path scheme."""
    spark = spark_of(t)
    path = write_table(t.orders, scratch_path(spark, "live"), partition_by=["o_orderstatus"])
    df = r.read_table(spark, path)
    scheme = df.select("_metadata.file_path").first()[0].split(":", 1)[0]
    listed = df.filter("o_orderstatus IN ('F', 'O')").select(F.col("_metadata.file_path").alias("path")).distinct()
    manifest = listed.withColumn("path", F.replace("path", F.lit(f"{scheme}:"), F.lit("store:")))
    live = r.read_live_files(spark, path, manifest, ("store:", f"{scheme}:"))
    return live.groupBy("o_orderstatus").agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("src11_object_table")
def object_table(t):
    return r.list_objects(spark_of(t), t.path("*"), recursive=False)


@query("src12_period_scan", """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders WHERE year(o_orderdate) = 1998 AND month(o_orderdate) = 12
""")
def period_scan(t):
    return r.read_period(t.orders, "o_orderdate", 1998, 12).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")


@query("src13_inline_values", """
SELECT v.label, COUNT(*) AS orders, ROUND(SUM(o_totalprice), 2) AS total
FROM orders JOIN (VALUES ('F', 'finished'), ('O', 'open'), ('P', 'pending')) v(code, label) ON o_orderstatus = v.code GROUP BY 1
""")
def inline_values(t):
    codes = r.inline_rows(spark_of(t), [("F", "finished"), ("O", "open"), ("P", "pending")], "code string, label string")
    return t.orders.join(codes, F.col("o_orderstatus") == F.col("code")).groupBy("label").agg(
        F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("src14_sequence_table", """
SELECT s.size::BIGINT AS size, COUNT(p.p_partkey) AS parts FROM generate_series(1, 60) s(size) LEFT JOIN part p ON p.p_size = s.size GROUP BY 1
""")
def sequence_table(t):
    sizes = r.sequence_df(spark_of(t), 1, 60, "size")
    return sizes.join(t.part, F.col("size") == F.col("p_size"), "left").groupBy("size").agg(F.count("p_partkey").alias("parts"))


@query("src15_sample_scan")
def sample_scan(t):
    return r.sample_rows(t.orders, 10, "o_orderkey").unionByName(r.sample_rows(t.orders, 1))


@query("src16_discover_tables", """
WITH c AS (SELECT * FROM information_schema.columns WHERE table_name IN ('customer', 'orders')),
m AS (SELECT GREATEST(MAX(c_custkey), MAX(c_nationkey)) < 2147483648 AS small FROM customer),
k AS (SELECT table_name AS name, CASE table_name WHEN 'customer' THEN 'csv' ELSE 'parquet' END AS format, CASE table_name WHEN 'customer' THEN '' ELSE 'o_orderstatus' END AS partition_keys,
  ROW_NUMBER() OVER (PARTITION BY table_name ORDER BY column_name = 'o_orderstatus', ordinal_position)::INT AS ordinal, column_name,
  CASE WHEN data_type IN ('BIGINT', 'INTEGER') AND table_name = 'customer' AND small THEN 'int' WHEN data_type = 'BIGINT' THEN 'bigint' WHEN data_type = 'INTEGER' THEN 'int'
   WHEN data_type = 'DOUBLE' THEN 'double' WHEN data_type LIKE 'TIMESTAMP%' THEN 'timestamp_ntz' ELSE 'string' END AS data_type FROM c, m)
SELECT * FROM k
""")
def discover(t):
    """Two folders are written, found again, and described from footers and samples."""
    spark = spark_of(t)
    root = scratch_path(spark, "lake")
    write_table(t.orders, f"{root}/orders", partition_by=["o_orderstatus"])
    write_table(t.customer, f"{root}/customer", "csv", options={"header": "true"})
    name = F.regexp_extract("location", "([^/]+)$", 1).alias("name")
    keys = r.discover_tables(spark, root).select("location", "partition_keys")
    found = discover_columns(spark, root).join(keys, "location")
    return found.select(name, "format", "partition_keys", "ordinal", "column_name", "data_type")


@query("src17_column_catalog", """
SELECT table_name, COUNT(*) AS columns, MIN(column_name) AS first_name FROM information_schema.columns
WHERE table_name IN ('customer', 'orders', 'lineitem', 'events', 'documents') GROUP BY 1
""")
def column_catalog(t):
    names = ["customer", "orders", "lineitem", "events", "documents"]
    cat = r.column_catalog(spark_of(t), {n: getattr(t, n) for n in names})
    return cat.groupBy("table_name").agg(F.count("*").alias("columns"), F.min("column_name").alias("first_name"))
