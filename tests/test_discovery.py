"""Discovery of tables from footers and samples."""

import pytest
from pyspark.sql import functions as F

from tidemark.session import scratch_path
from tidemark.sources import discovery as d


@pytest.mark.parametrize("values, kind", [
    (["1", "-20"], "int"), (["1", "3000000000"], "bigint"), (["1", "2.5", "3000000000"], "double"), (["1", "x"], "string"), (["", ""], None), (["", "7"], "int"),
    (["2024-01-31", "2024-02-01"], "date"), (["2024-01-31", "2024-01-31T10:00:00"], "timestamp"), (["2024-13-45"], "string"), (["true", "FALSE"], "boolean"), (["true", "1"], "string"),
    (["1e5"], "double"), (["9" * 30], "double"), (["."], "string"),
])
def test_types_of_texts_meet_in_the_narrowest(spark, values, kind):
    types = [d.type_of_text(v) for v in values]
    assert d.wider(types) == kind
    known = sorted({t for t in types if t})
    assert spark.range(1).select(d.merged_type(F.array(*map(F.lit, known)) if known else F.array().cast("array<string>"))).first()[0] == (kind or "string")


def test_tables_of_several_formats(spark):
    root = scratch_path(spark, "lake")
    spark.range(100).select("id", F.col("id").cast("string").alias("name"), (F.col("id") % 3).alias("day"), F.lit("x").alias("kind")).write.partitionBy("day", "kind").parquet(f"{root}/a/events")
    spark.range(50).select("id", (F.col("id") / 4).alias("amount"), F.lit(None).cast("string").alias("note")).write.option("header", "true").csv(f"{root}/b")
    spark.range(5).select("id", F.lit(True).alias("flag"), F.array("id").alias("list")).write.json(f"{root}/c")
    spark.range(5).select(F.col("id").cast("int"), F.lit(1.5).alias("extra")).write.mode("append").json(f"{root}/c")
    spark.range(3).select(F.col("id").cast("string")).write.text(f"{root}/d")
    got = {}
    for r in d.discover_columns(spark, root).orderBy("location", "ordinal").collect():
        got.setdefault((r.location.split(root.split(":")[-1])[-1], r.format), []).append((r.column_name, r.data_type, r.is_key))
    assert got["/a/events", "parquet"] == [("id", "bigint", False), ("name", "string", False), ("day", "int", True), ("kind", "string", True)]
    assert got["/b", "csv"] == [("id", "int", False), ("amount", "double", False), ("note", "string", False)]
    assert sorted(got["/c", "json"]) == [("extra", "double", False), ("flag", "boolean", False), ("id", "bigint", False), ("list", "array", False)]
    assert got["/d", "txt"] == [("value", "string", False)]


def test_only_the_head_of_a_text_is_read(spark, monkeypatch):
    root = scratch_path(spark, "big")
    spark.range(20_000, numPartitions=1).select(F.when(F.col("id") < 19_000, F.col("id").cast("string")).otherwise("late").alias("x")).write.option("header", "true").csv(root)
    found = d.discover_columns(spark, root).first()
    assert (found.column_name, found.data_type, found.files) == ("x", "int", 1)


def test_a_broken_file_does_not_stop_the_others(spark):
    root = scratch_path(spark, "broken")
    spark.range(3).write.parquet(f"{root}/t")
    spark.createDataFrame([("no footer",)], "value string").coalesce(1).write.text(f"{root}/u")
    import glob
    import os

    part = glob.glob(f"{root}/u/*.txt")[0]
    os.rename(part, f"{root}/t/bad.parquet")
    assert [(r.column_name, r.files) for r in d.discover_columns(spark, f"{root}/t").collect()] == [("id", spark.read.format("binaryFile").load(f"{root}/t/part*").count())]
