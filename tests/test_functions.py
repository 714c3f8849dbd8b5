"""Date, number, JSON and search semantics."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.functions import jsons, search, semantics as sem
from tidemark.operators import aggregates as ag, relational as rel
from tidemark.operators.joins import count_in_intervals, interval_load, pair_events


def one(spark, *cols, data=None, schema=None):
    df = spark.createDataFrame(data, schema) if data else spark.range(1)
    return tuple(df.select(*cols).first())


def test_rounding(spark):
    assert one(spark, sem.round_to_long(F.lit(2.7)), sem.round_to_long(F.lit(2.5)), sem.round_to_long(F.lit(-2.5))) == (3, 3, -3)
    assert one(spark, sem.half_even(F.lit(0.125), 2), sem.half_even(F.lit(0.135), 2)) == (0.12, 0.14)


@pytest.mark.parametrize("x,want", [(1.0, 1.0), (1.01, 1.25), (1.25, 1.25), (1.26, 1.5), (1.75, 1.75), (1.76, 2.0)])
def test_round_up_step(spark, x, want):
    assert one(spark, sem.round_up_step(F.lit(x), 0.25)) == (want,)


@pytest.mark.parametrize("day,week", [("2023-01-01", 1), ("2022-01-01", 0), ("2022-01-02", 1), ("2023-12-31", 53), ("2024-01-06", 0), ("2024-01-07", 1)])
def test_week_number_starts_on_sunday(spark, day, week):
    assert one(spark, sem.week_number(F.lit(day).cast("timestamp_ntz"))) == (week,)
    assert int(dt.date.fromisoformat(day).strftime("%U")) == week


def test_sunday_week(spark):
    assert one(spark, sem.sunday_week(F.lit("2024-01-10").cast("timestamp_ntz"))) == (dt.date(2024, 1, 7),)


def test_units_and_boundaries(spark):
    a, b = F.lit("2024-01-01 10:59:50").cast("timestamp_ntz"), F.lit("2024-01-01 11:00:10").cast("timestamp_ntz")
    assert one(spark, sem.whole_units(a, b, "HOUR"), sem.boundaries(a, b, "HOUR")) == (0, 1)


def test_tumble_in_local_time(spark):
    at = F.lit("2022-09-05 16:02:59").cast("timestamp_ntz")
    assert one(spark, sem.tumble(at, 180, "America/New_York")) == (dt.datetime(2022, 9, 5, 12, 0),)


def test_strict_json_numbers(spark):
    doc = F.lit('{"i": 3, "f": 2.5, "s": "3", "n": null}')
    got = one(spark, jsons.strict_number(doc, "$.i", "bigint"), jsons.strict_number(doc, "$.f", "double"),
              jsons.strict_number(doc, "$.s", "bigint"), jsons.strict_number(doc, "$.n", "bigint"),
              jsons.strict_number(doc, "$.x", "bigint"), jsons.strict_number(F.lit("{bad"), "$.i", "bigint"))
    assert got == (3, 2.5, None, None, None, None)


@pytest.mark.parametrize("term,want", [("service281", True), ("SERVICE281", True), ("service28", False), ("pool service281", True),
                                       ("`gpu-pool service281`", True), ("`pool gpu`", False), ("", False)])
def test_search(spark, term, want):
    text = F.lit("gke gpu-pool, Service281 up")
    assert one(spark, search.matches(text, term)) == (want,)


def test_exact_search(spark):
    assert one(spark, search.matches(F.lit("a b"), "a b", "no_op"), search.matches(F.lit("a b"), "a", "no_op")) == (True, False)


@pytest.mark.parametrize("fn", ["max", "min", "collect_list", "first", "any_value"])
def test_private_aggregates_refuse_what_gives_rows_back(t, fn):
    with pytest.raises(ValueError):
        ag.private_agg(t.events, [F.col("event_type")], "user_id", {"x": (fn, "value")}, 2)


def test_small_groups_stay_private(spark, t):
    assert ag.private_agg(t.events, [F.col("event_id")], "user_id", {}, 2).count() == 0
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 2, 4.0), ("b", 3, 1.0), ("b", None, 1.0), (None, 1, 1.0), (None, 2, None)], "g string, u int, x double")
    got = {r.g: (r.entities, r.x) for r in ag.private_agg(df, [F.col("g")], "u", {"x": ("avg", "x")}, 2).collect()}
    assert got == {"a": (2, 3.0), None: (2, 1.0)}


def test_intervals_without_a_bound(spark):
    spans = spark.createDataFrame([(1, 1, 3), (2, 2, None), (3, None, 5)], "k int, lo long, hi long")
    points = spark.createDataFrame([(1,), (2,), (3,), (4,)], "p long")
    assert {(r.k, r.points) for r in count_in_intervals(spans, "k", "lo", "hi", points, "p").collect()} == {(1, 3), (2, 0), (3, 0)}
    load = interval_load(spans.withColumn("g", F.lit("x")), ["g"], "lo", "hi", "k").collect()
    assert sorted((r.point, float(r.total), r.active) for r in load) == [(1, 1.0, 1), (2, 1.0, 1), (3, 1.0, 1)]


def test_pairs_need_both_ends(spark):
    rows = [(5, 5, "a"), (5, 2, "b"), (1, 1, "a"), (1, 5, "b"), (1, 3, "b"), (2, 1, "a"), (3, 2, "b"), (4, 9, "a"), (4, 2, "a"), (4, 3, "b")]
    df = spark.createDataFrame(rows, "k int, ts int, s string")
    assert {tuple(r) for r in pair_events(df, ["k"], "ts", "s", "a", "b", []).collect()} == {(1, 1, 5), (4, 2, 3)}


def test_clean_typed_parts_the_rows(spark):
    df = spark.createDataFrame([("21.5° Celsius", "90%"), ("x", "5"), (None, "7%")], "temp string, hum string")
    good, bad = rel.clean_typed(df, {"temp": ("° Celsius$", "double"), "hum": ("%$", "int")})
    assert {tuple(r) for r in good.collect()} == {(21.5, 90), (None, 7)}
    assert [r.temp for r in bad.collect()] == ["x"]


def test_rank_keeps_ties(spark):
    df = spark.createDataFrame([(1, 5), (1, 5), (1, 4)], "k int, v int")
    assert ag.top_per_group(df, ["k"], [F.desc("v")], 1, ties=True).count() == 2
    assert ag.top_per_group(df, ["k"], [F.desc("v")], 1).count() == 1
