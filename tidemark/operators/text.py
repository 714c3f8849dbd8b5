"""Batch text operators: inference with a pluggable scorer, classification, prompts, chunks, roll-ups."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.search import _terms, tokens
from tidemark.operators.aggregates import top_per_group
from tidemark.session import materialize
from tidemark.sources.readers import latest_by

#: A scorer maps a text column to an answer column; ``batch_fn`` makes one of code that is no column expression.
Scorer = Callable[[Column], Column]


def _count(words: Column, listed: list[str]) -> Column:
    return F.size(F.filter(words, lambda w: w.isin(sorted(listed))))


def lexicon_scorer(positive: list[str], negative: list[str]) -> Scorer:
    """Sentiment by counting listed words; the answer is the JSON text a remote model would send."""

    def answer(text: Column) -> Column:
        words = tokens(F.coalesce(text, F.lit("")))
        score = _count(words, positive) - _count(words, negative)
        label = F.when(score > 0, "positive").when(score < 0, "negative").otherwise("neutral")
        return F.to_json(F.struct(label.alias("sentiment"), score.alias("score")))

    return answer


def keyword_scorer(table: dict[str, list[str]], default: str) -> Scorer:
    """Category with the most listed words; the first one wins a tie."""

    def answer(text: Column) -> Column:
        words = tokens(F.coalesce(text, F.lit("")))
        hits = F.array(*[F.struct(_count(words, w).alias("n"), F.lit(-i).alias("first"), F.lit(c).alias("name")) for i, (c, w) in enumerate(table.items())])
        best = F.array_max(hits)
        return F.when(best["n"] > 0, best["name"]).otherwise(default)

    return answer


def batch_fn(name: str, fn: Callable[[pd.Series], pd.Series], max_rows: int = 1000, returns: str = "string"):
    """Column function over Arrow batches, calling ``fn`` with at most ``max_rows`` texts at a time."""

    def call(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            parts = [fn(s.iloc[i:i + max_rows]) for i in range(0, len(s), max_rows)]
            yield pd.concat(parts) if parts else s

    call.__name__ = name
    call.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(call, returns)


def infer_text(df: DataFrame, key: str, col: str, scorer: Scorer, done: DataFrame | None = None) -> DataFrame:
    """Raw answer for each row not scored yet. Running it again over its own output adds nothing."""
    todo = df if done is None else df.join(done.select(key), key, "left_anti")
    return todo.select(key, scorer(F.col(col)).alias("raw"))


def filter_by_question(df: DataFrame, col: str, question: str, scorer: Callable[[Column, str], Column]) -> DataFrame:
    """Rows for which the scorer answers the question with yes."""
    return df.filter(scorer(F.col(col), question))


def keyword_answer(text: Column, question: str) -> Column:
    """Offline scorer: every word of six letters or more of the question must occur."""
    asked = sorted({w for w in _terms(question) if len(w) >= 6})
    words = tokens(F.coalesce(text, F.lit("")))
    return reduce(lambda a, b: a & b, [F.array_contains(words, w) for w in asked]) if asked else F.lit(False)


def classify(df: DataFrame, col: str, scorer: Scorer, name: str = "category") -> DataFrame:
    """Zero-shot label per text."""
    return df.withColumn(name, scorer(F.col(col)))


def build_prompt(rows: DataFrame, keys: list[str], template: str, token: str, order_by: str, most: int | None = None) -> DataFrame:
    """Template with its token replaced by the group's rows as JSON lines, in order; only the first ``most``, where the caller says so."""
    few = top_per_group(rows, keys, [F.asc(order_by)], most if most is not None else (1 << 31) - 1)
    body = F.to_json(F.struct(*[c for c in rows.columns if c not in keys]))
    lines = F.array_sort(F.collect_list(F.struct("rank", body.alias("j"))))
    text = F.array_join(F.transform(lines, lambda x: x["j"]), "\n")
    return few.groupBy(*keys).agg(text.alias("__ctx")).select(
        *keys, F.replace(F.lit(template), F.lit(token), F.col("__ctx")).alias("prompt")
    )


def chunk(df: DataFrame, key: str, col: str, words: int) -> DataFrame:
    """Chunks of ``words`` words; together they hold the whole text."""
    all_words = F.filter(F.split(F.col(col), r"\s+"), lambda w: w != "")
    starts = F.sequence(F.lit(1), F.size("__w"), F.lit(words))
    rows = df.select(key, all_words.alias("__w")).filter(F.size("__w") > 0).select(
        key, "__w", F.posexplode(starts).alias("chunk_id", "__at"))
    return rows.select(key, "chunk_id", F.array_join(F.slice("__w", F.col("__at"), F.lit(words)), " ").alias("content"))


def label_rollup(df: DataFrame, keys: list[str], col: str, labels: list[str]) -> DataFrame:
    """Count per label, matched anywhere in the lower-cased answer."""
    return df.groupBy(*keys).agg(*[F.count_if(F.lower(col).like(f"%{x}%")).alias(f"{x}_count") for x in labels])


def rank_attributes(df: DataFrame, entity: str, group: str, attribute: str, min_support: int) -> DataFrame:
    """Most frequent attribute per entity and group, if it is frequent enough; the smaller name wins a tie."""
    counts = df.groupBy(entity, group, attribute).agg(F.count("*").alias("cnt"))
    best = latest_by(counts, [entity, group], [F.desc("cnt"), F.asc(attribute)])
    return best.filter(F.col("cnt") > min_support)


def sentiment(col: Column, positive: list[str], negative: list[str]) -> Column:
    """Native form of :func:`lexicon_scorer` for labels only."""
    words = tokens(col)
    up, down = _count(words, positive), _count(words, negative)
    return F.when(up > down, "positive").when(down > up, "negative").otherwise("neutral")


def json_leaves(df: DataFrame, key: str, col: str) -> DataFrame:
    """Every scalar of nested JSON documents, at any depth: ``key``, its ``path`` (``$.a[0].b``), its last ``name`` and its ``value``.

    Each round opens the objects and arrays of one level with a lateral table function and keeps the rest, so there are as many
    rounds as levels. JSON nulls are no leaves; a text that is not JSON has none; a name is null for the elements of arrays.
    """
    spark = df.sparkSession
    front = df.select(F.col(key).alias("__key"), F.lit("$").alias("path"), F.lit(None).cast("string").alias("name"), F.try_parse_json(col).alias("v")).filter("v IS NOT NULL")
    found = []
    while True:
        front = materialize(front.withColumn("opens", F.schema_of_variant("v").rlike("^(OBJECT|ARRAY)<")), "json-level")
        found.append(front.filter(~F.col("opens") & ~F.is_variant_null("v")).select(F.col("__key").alias(key), "path", "name", F.col("v").cast("string").alias("value")))
        opened = front.filter("opens")
        if opened.isEmpty():
            return reduce(DataFrame.unionByName, found)
        inside = opened.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()).select(F.col("pos"), F.col("key").alias("name1"), F.col("value").alias("v1")))
        step = F.when(F.col("name1").isNull(), F.concat(F.lit("["), F.col("pos"), F.lit("]"))).otherwise(F.concat(F.lit("."), F.col("name1")))
        front = inside.select("__key", F.concat("path", step).alias("path"), F.col("name1").alias("name"), F.col("v1").alias("v"))


def chunk_json(df: DataFrame, key: str, col: str, fields: list[str], size: int) -> DataFrame:
    """Chunks of at most ``size`` words of the texts in nested JSON documents, each with the path it comes from.

    ``fields`` names the members that hold text, at whatever depth.
    """
    texts = json_leaves(df, key, col).filter(F.col("name").isin(fields)).withColumn("__leaf", F.struct(key, "path"))
    return chunk(texts, "__leaf", "value", size).select(f"__leaf.{key}", "__leaf.path", "chunk_id", "content")
