"""Readers, writers and change feeds: identities and failure cases."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.session import scratch_path, scratch_root
from tidemark.sources import changes as ch, readers as r, tables as w


def test_scratch_follows_the_session(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_delete_keeps_null_conditions(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "id int, s string")
    assert {x.id for x in w.delete_where(df, F.col("s") == "a").collect()} == {2, 3}


def test_update_from_rejects_ambiguous_source(spark):
    df = spark.createDataFrame([(1, 0), (2, 0)], "k int, a int")
    src = spark.createDataFrame([(1, 5), (1, 6)], "k int, v int")
    with pytest.raises(PySparkException, match="more than one source row"):
        w.update_from(df, src, "k", {"a": "v"}).collect()
    one = w.update_from(df, src.limit(1), "k", {"a": "v"})
    assert {(x.k, x.a) for x in one.collect()} == {(1, 5), (2, 0)}


def test_incremental_run_checks_and_is_idempotent(spark, t):
    src = t.events.select("event_id", "ts", "value")
    first = ch.run_incremental(src, None, ["event_id"], "ts", "1 hour", {"positive": "value >= 0"})
    assert first.count() == src.count()
    assert ch.run_incremental(src, first, ["event_id"], "ts", "1 hour", {}).count() == 0
    half = src.filter("ts < TIMESTAMP_NTZ'2024-01-15'")
    more = ch.run_incremental(src, half, ["event_id"], "ts", "1 hour", {})
    assert half.count() + more.count() == src.count() and more.join(half, "event_id").count() == 0
    with pytest.raises(ValueError, match="small"):
        ch.run_incremental(src, None, ["event_id"], "ts", "1 hour", {"small": "value < 1"})


def test_upsert_and_changes(spark):
    cur = spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "k int, ts int, x string")
    new = spark.createDataFrame([(2, 3, "c"), (2, 2, "old"), (3, 1, "d")], "k int, ts int, x string")
    assert {tuple(x) for x in ch.keyed_upsert(cur, new, ["k"], ["ts"]).collect()} == {(1, 1, "a"), (2, 3, "c"), (3, 1, "d")}
    log = spark.createDataFrame([(1, 2, "z", "U", 1), (1, 2, "z", "D", 2), (4, 1, "n", "I", 1)], "k int, ts int, x string, op string, seq int")
    assert {tuple(x) for x in ch.apply_changes(cur, log, ["k"], "op", ["seq"]).collect()} == {(2, 1, "b"), (4, 1, "n")}


def test_view_equals_base(spark, t):
    keys, sums = [F.col("l_returnflag")], {"q": F.col("l_quantity")}
    half = F.col("l_linestatus") == "O"
    mv = ch.refresh_mv(ch.create_mv(t.lineitem.filter(half), keys, sums), ch.create_mv(t.lineitem.filter(~half), keys, sums), ["l_returnflag"])
    assert {tuple(x) for x in mv.collect()} == {tuple(x) for x in ch.create_mv(t.lineitem, keys, sums).collect()}


def test_compaction_and_partition_pruning(spark, t):
    small, few = scratch_path(spark, "small"), scratch_path(spark, "few")
    w.write_table(t.orders.repartition(20), small)
    w.compact(spark, small, few, 3)
    assert len(spark.read.parquet(few).inputFiles()) == 3
    path = w.write_table(t.orders, scratch_path(spark, "byday"), partition_by=["o_orderstatus"])
    plan = r.read_table(spark, path).filter("o_orderstatus = 'F'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(o_orderstatus" in plan


def test_compaction_moves_no_rows(spark, t):
    """Whole files are dealt to as many tasks as files come out; uneven files are dealt out by rows. Either way every row arrives once."""
    even, uneven, folders = (scratch_path(spark, x) for x in ("even", "uneven", "folders"))
    w.write_table(t.orders.repartition(13), even)
    w.write_table(t.orders.repartition(1), uneven)
    w.write_table(t.orders.limit(5).repartition(5), uneven, mode="append")
    w.write_table(t.orders, folders, partition_by=["o_orderstatus"])
    placed = F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i"))
    for src, files in ((even, 4), (even, 1), (even, 13), (uneven, 4), (folders, 2)):
        few = w.compact(spark, src, scratch_path(spark, "few"), files)
        old, new = spark.read.parquet(src), spark.read.parquet(few)
        assert len(new.inputFiles()) == files and new.schema == old.schema
        assert new.exceptAll(old).count() == old.exceptAll(new).count() == 0
        if src == even:  # rows that lay in one file still follow each other in one file
            was = old.groupBy("o_orderkey").agg(F.min(placed["f"]).alias("was"))
            now = new.select("o_orderkey", placed.alias("now")).join(was, "o_orderkey")
            assert now.groupBy("was").agg(F.count_distinct("now.f").alias("n")).filter("n > 1").count() == 0


def test_sample_is_repeatable(spark, t):
    a, b = r.sample_rows(t.orders, 20, "o_orderkey"), r.sample_rows(t.orders, 20, "o_orderkey")
    assert a.count() == b.count() == a.join(b, "o_orderkey").count()
    assert 0.1 < a.count() / t.orders.count() < 0.3


def test_object_listing(spark, t):
    listed = r.list_objects(spark, t.path("*"), recursive=False)
    assert listed.count() == 14 and listed.filter("size <= 0").count() == 0
    assert "content" not in listed.columns


def test_discovery(spark, t):
    root = scratch_path(spark, "lake")
    w.write_table(t.orders, f"{root}/orders", partition_by=["o_orderstatus"])
    w.write_table(t.nation, f"{root}/nation", "json")
    found = {x.location.rsplit("/", 1)[1]: (x.format, x.partition_keys) for x in r.discover_tables(spark, root).collect()}
    assert found == {"orders": ("parquet", "o_orderstatus"), "nation": ("json", "")}


def test_partition_upsert_leaves_other_folders_alone(spark, t):
    df = t.orders.select("o_orderkey", "o_totalprice", F.lit(1).alias("seq"), "o_orderstatus")
    path = w.write_table(df, scratch_path(spark, "upsert"), partition_by=["o_orderstatus"])
    before = set(spark.read.parquet(path).inputFiles())
    new = df.filter("o_orderstatus = 'F'").limit(5).withColumns({"seq": F.lit(2), "o_totalprice": F.lit(0.0)})
    new = spark.createDataFrame(new.collect(), new.schema)
    ch.upsert_partitions(path, new, ["o_orderkey"], ["seq"], "o_orderstatus")
    after = spark.read.parquet(path)
    assert {f for f in before if "=F/" not in f} == {f for f in after.inputFiles() if "=F/" not in f}
    assert after.count() == df.count() and after.filter("seq = 2 AND o_totalprice = 0").count() == 5


def test_any_clustered_column_skips_row_groups(spark, t):
    """Row-group statistics of the written files, read from their footers."""
    import glob

    import pyarrow.parquet as pq

    cols = {"l_shipdate": 0.1, "l_suppkey": 0.1, "l_extendedprice": 0.1}
    path = w.write_clustered(t.lineitem, scratch_path(spark, "curve"), list(cols), 32, options={"parquet.block.size": "65536"})
    groups = []
    for file in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        names = [meta.schema.column(k).path for k in range(meta.num_columns)]
        for g in range(meta.num_row_groups):
            groups.append({c: meta.row_group(g).column(names.index(c)).statistics for c in cols})
    assert len(groups) >= 32
    back = spark.read.parquet(path)
    assert back.columns == t.lineitem.columns and back.count() == t.lineitem.count()
    assert back.exceptAll(t.lineitem).count() == 0
    for c, share in cols.items():
        bar = t.lineitem.agg(F.percentile_approx(c, share)).first()[0]
        read = sum(g[c].min <= bar for g in groups)
        assert read < 0.6 * len(groups), (c, read, len(groups))


def test_curve_places(spark):
    rows = [(a, b) for a in range(4) for b in range(4)]
    df = spark.createDataFrame(rows, "a long, b long")
    got = {(r.a, r.b): r.p for r in df.withColumn("p", w.curve([F.col("a"), F.col("b")], 2)).collect()}
    assert sorted(got.values()) == list(range(16))
    assert [got[1, 1], got[0, 2], got[2, 0], got[3, 3]] == [3, 8, 4, 15]
    ranked = spark.createDataFrame([(None,), (1.0,), (2.0,), (9.0,)], "x double").select(w.range_rank(F.col("x"), [1.0, 5.0]).alias("r"))
    assert sorted(r.r for r in ranked.collect()) == [0, 0, 1, 2]


def test_clustered_layout_of_awkward_columns(spark):
    rows = [(None, None, [k]) for k in range(20)] + [("same", 1, [k]) for k in range(200)] + [(f"é{k}", k, None) for k in range(30)]
    df = spark.createDataFrame(rows, "name string, n int, list array<int>")
    path = w.write_clustered(df, scratch_path(spark, "odd"), ["name", "n"], 4)
    back = spark.read.parquet(path)
    assert back.count() == 250 and back.filter("name = 'same'").count() == 200
    assert w.file_bounds(back, ["n"]).agg(F.sum("rows")).first()[0] == 250
    empty = w.write_clustered(df.limit(0), scratch_path(spark, "none"), ["name"], 2)
    assert spark.read.schema(df.schema).parquet(empty).count() == 0
    with pytest.raises(ValueError):
        w.write_clustered(df, path, ["name"] * 7, bits=10)


def test_partitioned_writes_give_one_file_a_folder(spark, t):
    path = w.write_table(t.events.withColumn("day", F.to_date("ts")), scratch_path(spark, "days"), partition_by=["day"])
    files = spark.read.parquet(path).select("day", F.input_file_name().alias("f")).distinct()
    assert files.count() == files.select("day").distinct().count()
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled") == "true"


def test_only_live_files_are_opened(spark):
    path = w.write_table(spark.range(100).select("id", (F.col("id") % 4).alias("part")), scratch_path(spark, "live"), partition_by=["part"])
    table = spark.read.parquet(path)
    manifest = table.filter("part IN (1, 3)").select(F.regexp_replace("_metadata.file_path", "^file:", "store:").alias("path"))
    live = r.read_live_files(spark, path, manifest, ("store:", "file:"))
    assert sorted(live.columns) == ["id", "part"] and live.count() == 50
    assert len(live.inputFiles()) == 2 < len(table.inputFiles())
    assert r.read_live_files(spark, path, manifest.limit(0)).count() == 0
    nulls = spark.createDataFrame([(None,)], "path string")
    assert r.read_live_files(spark, path, manifest.unionByName(nulls), ("store:", "file:")).count() == 50


def test_rows_without_a_time_are_loaded_once(spark):
    schema = "id int, ts timestamp_ntz"
    import datetime as dt

    old, new = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 9)
    target = spark.createDataFrame([(1, old), (2, None)], schema)
    src = spark.createDataFrame([(1, old), (2, None), (3, None), (4, new)], schema)
    assert sorted(x.id for x in ch.run_incremental(src, target, ["id"], "ts", "1 DAY", {}).collect()) == [3, 4]
    assert ch.run_incremental(src, None, ["id"], "ts", "1 DAY", {}).count() == 4
