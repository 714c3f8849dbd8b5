"""Table functions from SQL, and chunks of nested JSON."""

import json

import pytest
from pyspark.errors import PySparkException

from tidemark.operators import models as m, table_functions as tf, text as tx


@pytest.fixture(scope="module")
def sql(spark):
    tf.register(spark)
    rows = [("a", 1, 5.0), ("a", 2, 7.5), ("a", 3, 11.0), ("b", 1, 2.0), (None, 4, 3.0), (None, 5, None), ("c", 2, 1.0), ("c", 2, 3.0)]
    spark.createDataFrame(rows, "k string, step int, x double").createOrReplaceTempView("rows_of_test")
    return lambda text: spark.sql(text).collect()


def test_top_rows(sql):
    got = sql("SELECT * FROM top_rows(TABLE(rows_of_test) PARTITION BY (k) ORDER BY (x DESC NULLS LAST), 2)")
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [
        ("a", 3, 11.0, 1), ("a", 2, 7.5, 2), ("b", 1, 2.0, 1), (None, 4, 3.0, 1), (None, 5, None, 2), ("c", 2, 3.0, 1), ("c", 2, 1.0, 2)]))


def test_predict_takes_its_schema_from_the_table(sql):
    model = json.dumps({"intercept": 1.5, "weights": {"x": 2, "step": -1}})
    got = sql(f"SELECT k, step, prediction FROM predict_linear(TABLE(rows_of_test), '{model}') WHERE k IS NULL OR k = 'a'")
    assert sorted((str(r.k), r.step, r.prediction) for r in got) == [("None", 4, 3.5), ("None", 5, None), ("a", 1, 10.5), ("a", 2, 14.5), ("a", 3, 20.5)]


def test_forecast_equals_the_set_based_one(spark, sql):
    got = {(r.k, r.forecast_step): (r.forecast_value, r.interval_lower) for r in sql("SELECT * FROM forecast_linear(TABLE(rows_of_test) PARTITION BY (k), 'step', 'x', 3, 'k')")}
    want = m.forecast(spark.table("rows_of_test").filter("k = 'a'"), "x", "step", 3, id_cols=["k"]).collect()
    assert set(got) == {("a", s) for s in (4, 5, 6)}
    for r in want:
        assert got["a", r.forecast_step] == pytest.approx((r.forecast_value, r.interval_lower))


@pytest.mark.parametrize("call", [
    "top_rows(TABLE(rows_of_test), 0)", "top_rows(1, 2)", "top_rows(TABLE(SELECT 1 AS rank), 2)", "predict_linear(TABLE(rows_of_test), '{\"intercept\": 0, \"weights\": {\"k\": 1}}')",
    "forecast_linear(TABLE(rows_of_test) PARTITION BY (k), 'nothing', 'x', 3, 'k')", "forecast_linear(TABLE(rows_of_test) PARTITION BY (k), 'step', 'x', 0, 'k')",
])
def test_wrong_calls_fail_when_analysed(sql, call):
    with pytest.raises(PySparkException):
        sql(f"SELECT * FROM {call}")


DOCS = [
    (1, json.dumps({"text": "one two three", "parts": [{"text": "four five"}, {"deep": [[{"text": "six"}], {"text": ["seven", "eight nine"]}]}], "n": 5, "none": None})),
    (2, "[1, [2, [3, {\"text\": \"x\"}]]]"), (3, "not json"), (4, None), (5, "{}"), (6, "\"alone\""), (None, "{\"text\": \"a b c d\"}"),
]


def test_leaves_of_any_depth(spark):
    got = {(r.id, r.path): (r.name, r.value) for r in tx.json_leaves(spark.createDataFrame(DOCS, "id int, doc string"), "id", "doc").collect()}
    assert got == {
        (1, "$.text"): ("text", "one two three"), (1, "$.parts[0].text"): ("text", "four five"), (1, "$.parts[1].deep[0][0].text"): ("text", "six"),
        (1, "$.parts[1].deep[1].text[0]"): (None, "seven"), (1, "$.parts[1].deep[1].text[1]"): (None, "eight nine"), (1, "$.n"): ("n", "5"),
        (2, "$[0]"): (None, "1"), (2, "$[1][0]"): (None, "2"), (2, "$[1][1][0]"): (None, "3"), (2, "$[1][1][1].text"): ("text", "x"), (6, "$"): (None, "alone"),
        (None, "$.text"): ("text", "a b c d"),
    }


def test_chunks_carry_their_path(spark):
    got = tx.chunk_json(spark.createDataFrame(DOCS, "id int, doc string"), "id", "doc", ["text"], 2).collect()
    assert sorted((str(r.id), r.path, r.chunk_id, r.content) for r in got) == [
        ("1", "$.parts[0].text", 0, "four five"), ("1", "$.parts[1].deep[0][0].text", 0, "six"), ("1", "$.text", 0, "one two"), ("1", "$.text", 1, "three"),
        ("2", "$[1][1][1].text", 0, "x"), ("None", "$.text", 0, "a b"), ("None", "$.text", 1, "c d"),
    ]
