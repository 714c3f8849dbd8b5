"""Models, vector search, text operators and forecasts."""

import math

import pandas as pd
import pytest
import numpy as np
from pyspark.sql import functions as F

from tidemark.operators import models as m, text as tx, vectors as v
from tidemark.plans.learning import COPIES, LISTS, PROBED, hundredth_queries, label_queries, priced_lines, until_done, vector_index
from tidemark.session import Tables


def test_linear_regression_recovers_a_line(spark):
    df = spark.range(500).select((F.col("id") % 17).cast("double").alias("x"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("c"))
    df = df.withColumn("y", 3 * F.col("x") + F.when(F.col("c") == "a", 10.0).otherwise(0.0))
    report = m.regression_report(m.predict(m.train_linear(df, "y", ["c"], ["x"]), df), "y", "predicted").first()
    assert report.rmse < 0.05 and report.r2 > 0.999


def test_logistic_beats_chance(spark):
    df = spark.range(400).select((F.col("id") % 20).cast("double").alias("x")).withColumn("label", (F.col("x") > 9).cast("int"))
    scored = m.predict(m.train_logistic(df, "label", [], ["x"], reg=0.01), df)
    report = m.evaluate(scored, "label", "probability").first()
    assert report.accuracy > 0.95 and report.f1_score > 0.95
    assert m.roc_auc(scored, "label", "probability").first().roc_auc > 0.99


def test_explanation_adds_up(spark, t):
    lines = priced_lines(t)
    model = m.train_linear(lines, "l_extendedprice", ["l_returnflag"], ["l_quantity", "p_retailprice"])
    keyed = lines.withColumn("id", F.monotonically_increasing_id())
    parts = m.explain(model, keyed, "id", 99).groupBy("id").agg(F.sum("attribution").alias("s"))
    row = m.predict(model, keyed).join(parts, "id").select((F.col("s") + model.stages[-1].intercept - F.col("predicted")).alias("d")).agg(F.max(F.abs("d"))).first()
    assert row[0] < 1e-4


def test_explanation_plan_does_not_grow_with_categories(spark):
    def plan(n):
        df = spark.range(400).select("id", F.concat(F.lit("c"), (F.col("id") % n).cast("string")).alias("c"), F.rand(1).alias("x")).withColumn("y", F.col("id") * 1.0)
        out = m.explain(m.train_linear(df, "y", ["c"], ["x"]), df, "id", 2)
        assert out.groupBy("id").count().filter("count > 2").count() == 0
        return out._jdf.queryExecution().optimizedPlan().toString().count("named_struct") + out._jdf.queryExecution().optimizedPlan().toString().count("struct(")

    assert plan(5) == plan(100)


def test_anomaly_share(spark, t):
    rows = t.orders.select("o_orderkey", (F.col("o_totalprice") / 1000).alias("x"))
    out = m.detect_anomalies(rows, [[100.0], [300.0]], ["x"], 0.1, "o_orderkey")
    assert out.filter("is_anomaly").count() == math.floor(rows.count() * 0.1)
    least, most = out.groupBy("is_anomaly").agg(F.min("normalized_distance").alias("lo"), F.max("normalized_distance").alias("hi")).orderBy("is_anomaly").collect()
    assert least.hi <= most.lo


def test_forecast_of_a_straight_line(spark):
    df = spark.range(10).select(F.lit("s").alias("id2"), F.col("id").alias("step"), (100 - 5 * F.col("id")).cast("double").alias("y"))
    fc = m.forecast(df, "y", "step", 20, id_cols=["id2"])
    assert abs(fc.filter("forecast_step = 12").first().forecast_value - 40) < 1e-9
    assert m.first_crossing(fc, ["id2"], 20.0).first().crossing_step == 16


def test_horizon_rounds_up(spark):
    assert spark.range(1).select(m.horizon_steps(F.lit(3600), F.lit(700))).first()[0] == 6


def _found(df):
    return {(r.query_id, r["rank"]): (r.base_id, round(r.distance, 6)) for r in df.collect()}


@pytest.mark.parametrize("kind", ["cosine", "euclidean", "dot"])
def test_block_size_does_not_matter(spark, t, kind, monkeypatch):
    args = dict(b_id="vec_id", q_vec="q")
    direct = _found(v.vector_search(t.embeddings, label_queries(t), 7, kind, **args))
    monkeypatch.setattr(v, "BLOCK_BYTES", 120 * 64 * 8)
    queries = t.embeddings.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q"))
    blocks = v.vector_search(t.embeddings, label_queries(t), 7, kind, **args)
    assert _found(blocks) == direct
    every = v.vector_search(t.embeddings, queries, 1, "cosine", **args)
    assert every.count() == t.embeddings.count() and every.filter("query_id <> base_id AND distance > 1e-6").count() == 0


def test_vectors_without_a_distance_are_no_match(spark):
    zero, one = [0.0, 0.0], [1.0, 0.5]
    base = spark.createDataFrame([(k, zero) for k in range(8)] + [(9, one), (10, [1.0]), (11, None)], "base_id long, embedding array<double>")
    query = spark.createDataFrame([(0, [1.0, 0.5]), (1, None)], "query_id long, embedding array<double>")
    assert [r.base_id for r in v.vector_search(base, query, 3, "cosine").collect()] == [9]
    assert v.vector_search(base.limit(0), query, 3).count() == v.vector_search(base, query.limit(0), 3).count() == 0


@pytest.mark.parametrize("kind", ["cosine", "euclidean"])
def test_vectors_meet_those_of_their_length(spark, kind):
    base = spark.createDataFrame([(1, [1.0, 0.5]), (2, [0.5, 1.0]), (3, [1.0, 2.0, 3.0])], "base_id long, embedding array<double>")
    query = spark.createDataFrame([(0, [1.0, 0.5]), (1, [1.0, 2.0, 3.0]), (2, [1.0] * 9)], "query_id long, embedding array<double>")
    got = v.vector_search(base, query, 2, kind).collect()
    assert sorted((r.query_id, r.base_id, r["rank"]) for r in got) == [(0, 1, 1), (0, 2, 2), (1, 3, 1)]


def test_scoring_keeps_rows_with_missing_numbers(spark):
    rows = [(float(k), "a" if k % 2 else None, 2.0 * k) for k in range(20)] + [(None, "b", 7.0)]
    df = spark.createDataFrame(rows, "x double, c string, y double")
    assert m.predict(m.train_linear(df, "y", ["c"], ["x"]), df).filter("predicted IS NOT NULL").count() == 21


def test_numpy_and_column_distances_agree(spark, t):
    near = v.vector_search(t.embeddings, label_queries(t), 3, "euclidean", b_id="vec_id", q_vec="q").select("query_id", "base_id", "distance")
    j = near.join(label_queries(t), "query_id").join(t.embeddings.withColumnRenamed("vec_id", "base_id"), "base_id")
    worst = j.agg(F.max(F.abs(F.col("distance") - v.distance(F.col("q"), F.col("embedding"), "euclidean")))).first()[0]
    assert worst < 1e-6


def _pairs(near):
    return {(r.query_id, r.base_id) for r in near.collect()}


def test_index_search_is_exact_with_all_lists(spark, t, monkeypatch):
    monkeypatch.setattr(v, "BLOCK_BYTES", 20 * 64 * 8)
    codebook = v.train_codebook(t.embeddings, "embedding", 8, sample=300)
    index = v.build_index(t.embeddings, codebook, "vec_id", copies=2)
    assert index.groupBy("list_id").count().agg(F.max("count")).first()[0] > 1  # several blocks a list
    assert index.agg(F.sum(F.size("ids"))).first()[0] == 2 * t.embeddings.count()
    exact = v.vector_search(t.embeddings, label_queries(t), 5, "euclidean", b_id="vec_id", q_vec="q")
    got = v.search_index(index, codebook, label_queries(t), 5, 1.0, rerank=10**6, q_vec="q")
    assert _found(got) == _found(exact)
    share = v.recall(v.search_index(index, codebook, label_queries(t), 5, 0.5, q_vec="q"), exact).first()
    assert share.queries == 10 and 0.5 <= share.recall <= 1


def test_index_ignores_vectors_of_other_lengths(spark):
    rows = [(k, [float(k), 1.0, -float(k), 0.5]) for k in range(40)] + [(90, None), (91, [1.0, 2.0]), (92, [])]
    base = spark.createDataFrame(rows, "base_id long, embedding array<double>")
    codebook = v.train_codebook(base, "embedding", 4)
    queries = spark.createDataFrame([("a", [3.0, 1.0, -3.0, 0.5]), ("b", [1.0]), ("c", None)], "query_id string, embedding array<double>")
    index = v.build_index(base, codebook)
    assert [(r.query_id, r.base_id, r.distance) for r in v.search_index(index, codebook, queries, 1, 1.0).collect()] == [("a", 3, 0.0)]
    with pytest.raises(ValueError):
        v.train_codebook(base.filter("base_id = 91"), "embedding", 4)


@pytest.mark.parametrize("scale", ["0.001", "0.1"])
def test_registered_index_recall(spark, scale):
    t = Tables(spark, f"/root/testdata/sf{scale}")
    queries = hundredth_queries(t)
    assert PROBED <= 0.25 and queries.count() == t.embeddings.filter("vec_id % 100 = 0").count() > 0
    codebook, index = vector_index(t)
    exact = v.vector_search(t.embeddings, queries, 5, "euclidean", b_id="vec_id", q_vec="q")
    assert v.recall(v.search_index(index, codebook, queries, 5, PROBED, q_vec="q"), exact).first().recall >= 0.9
    assert len(codebook.lists) == LISTS and index.agg(F.sum(F.size("ids"))).first()[0] == COPIES * t.embeddings.count()


def test_rows_out_of_blocks_do_not_grow_with_partitions(spark, t, monkeypatch):
    monkeypatch.setattr(v, "top_per_group", lambda near, *_: near)
    monkeypatch.setattr(v, "BLOCK_BYTES", 50 * 64 * 8)
    every = t.embeddings.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q"))
    try:
        for partitions in ("8", "40"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            assert v.vector_search(t.embeddings, every, 3, "euclidean", b_id="vec_id", q_vec="q").count() == 3 * every.count()
            assert v.vector_search(t.embeddings, label_queries(t), 3, "euclidean", b_id="vec_id", q_vec="q").count() == 3 * 10 * -(-t.embeddings.count() // 50)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_equal_distances_do_not_pile_up():
    """Of many base rows at one distance a block keeps ``k`` a query, those of the smallest ids, and its matrices stay small."""
    q, b, ids = np.ones((300, 4)), np.zeros((5_000, 4)), np.arange(5_000)[::-1].copy()
    near = v._nearest(np.arange(300), q, ids, b, 3, "euclidean")
    assert len(near) == 900 and sorted(near.base_id.unique()) == [0, 1, 2]
    assert near.groupby("place").base_id.apply(sorted).tolist() == [[0, 1, 2]] * 300
    assert 8 * v.MATRIX_CELLS <= 16 << 20


def test_one_text_does_not_cut_the_values_into_tiny_tasks(spark, monkeypatch):
    monkeypatch.setattr(v, "BLOCK_BYTES", 64)  # four vectors of two numbers
    meta = spark.createDataFrame([("t", "c", f"{k:03}", [float(k), 1.0]) for k in range(160)], "table_name string, column_name string, text_content string, embedding array<double>")
    probe = spark.createDataFrame([([3.2, 1.0],)], "embedding array<double>")
    near = v.best_column(meta, probe, "embedding", 2)
    plan = near._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [block" in plan and "], 5" in plan  # 40 blocks, eight a task
    assert sum(line.count("LocalRelation") + line.count("LogicalRDD") for line in plan.splitlines()) == 1  # the probe; the values were written
    assert [r.text_content for r in near.orderBy("rank").collect()] == ["003", "004"]


def test_embedding_finds_the_right_column(spark, t):
    values = v.distinct_values({"customer": t.customer, "part": t.part})
    model = v.fit_embedder(values, "text_content")
    probe = v.embed(spark.createDataFrame([("machinery",)], "text string"), "text", model)
    assert v.best_column(v.embed(values, "text_content", model), probe, "embedding").first().column_name == "c_mktsegment"


def test_embedder_may_be_any_function(spark, t):
    fn = F.pandas_udf(lambda s: s.map(lambda x: [float(len(x)), 1.0]), "array<float>")
    assert v.embed(t.part, "p_name", fn).filter(v.has_length(F.col("embedding"), 2)).count() == t.part.count()


def test_inference_is_idempotent(spark, t):
    scorer = tx.lexicon_scorer(["the"], ["not"])
    done = tx.infer_text(t.documents, "doc_id", "text", scorer)
    assert done.count() == t.documents.count()
    assert tx.infer_text(t.documents, "doc_id", "text", scorer, done=done).count() == 0


def test_loop_until_done_scores_every_row_once(spark, t):
    got = until_done(t)
    assert got.count() == got.select("doc_id").distinct().count() == t.documents.count()
    assert got.join(t.documents, "doc_id").filter("raw <> length(text)").count() == 0


def test_native_and_batch_sentiment_agree(spark, t):
    scorer = tx.lexicon_scorer(["the", "with"], ["not", "to"])
    raw = tx.infer_text(t.documents, "doc_id", "text", scorer).withColumn("a", F.get_json_object("raw", "$.sentiment"))
    native = t.documents.select("doc_id", tx.sentiment(F.col("text"), ["the", "with"], ["not", "to"]).alias("b"))
    assert raw.join(native, "doc_id").filter("a <> b").count() == 0


def test_batches_are_bounded(spark):
    seen = tx.batch_fn("sizes", lambda s: pd.Series([str(len(s))] * len(s), index=s.index), 7)
    sizes = {int(r[0]) for r in spark.range(50, numPartitions=1).select(seen(F.col("id").cast("string"))).collect()}
    assert sizes == {7, 1}


def test_chunks_hold_the_whole_text(spark, t):
    chunks = tx.chunk(t.documents, "doc_id", "text", 50)
    words = chunks.select(F.size(F.split("content", " ")).alias("n"))
    assert words.agg(F.max("n")).first()[0] <= 50
    total = t.documents.select(F.size(F.filter(F.split("text", r"\s+"), lambda w: w != "")).alias("n")).agg(F.sum("n")).first()[0]
    assert words.agg(F.sum("n")).first()[0] == total
