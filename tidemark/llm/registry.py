"""Queries of this subpackage, each next to its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import Tables, prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def bounded_batches(spark: SparkSession) -> SparkSession:
    """Session settings of these operators: rows may hold long texts, so few of them go to a Python worker at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return prepare(spark)


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``."""

    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(bounded_batches(spark), folder))

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def session_of(t: Tables) -> SparkSession:
    return t._spark


def task_count(spark: SparkSession) -> int:
    """Pieces to deal work into: the session's shuffle partitions, which a cluster sets by its data."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
