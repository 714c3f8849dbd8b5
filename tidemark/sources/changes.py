"""Keyed writes, change feeds, materialised views and incremental models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.session import materialize
from tidemark.sources.readers import latest_by
from tidemark.sources.tables import write_table


def keyed_upsert(current: DataFrame, new: DataFrame, keys: list[str], precombine: list[str]) -> DataFrame:
    """Latest row per key of both inputs by the precombine columns."""
    both = current.unionByName(new)
    return latest_by(both, keys, [F.desc(c) for c in precombine])


def upsert_partitions(path: str, new: DataFrame, keys: list[str], precombine: list[str], partition: str) -> None:
    """Keyed upsert into a hive-partitioned table that rewrites only the partitions ``new`` touches.

    A key stays in its partition. The merged rows are written aside first, as a table cannot be
    read while its folders are replaced.
    """
    spark = new.sparkSession
    current = spark.read.schema(new.schema).parquet(path)
    touched = current.join(new.select(partition).distinct(), partition, "left_semi").select(*new.columns)
    merged = materialize(keyed_upsert(touched, new, keys, precombine), "upsert")
    write_table(merged, path, partition_by=[partition], options={"partitionOverwriteMode": "dynamic"})


def last_change(log: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Last entry per key of a change log."""
    return latest_by(log, keys, [F.desc(c) for c in order])


def apply_changes(base: DataFrame, log: DataFrame, keys: list[str], op: str, order: list[str]) -> DataFrame:
    """Latest state after a log of ``I``, ``U`` and ``D`` entries."""
    last = last_change(log, keys, order)
    untouched = base.join(last.select(*keys), keys, "left_anti")
    written = last.filter(F.col(op) != "D").select(*base.columns)
    return untouched.unionByName(written)


def create_mv(df: DataFrame, keys: list[Column], sums: dict[str, Column]) -> DataFrame:
    """Partial aggregates a view can be merged and rolled up from: sums and a row count, never averages."""
    return df.groupBy(*keys).agg(*[F.sum(c).alias(n) for n, c in sums.items()], F.count("*").alias("row_count"))


def refresh_mv(mv: DataFrame, fresh: DataFrame, keys: list[str]) -> DataFrame:
    """Merge the partial aggregates of new rows into a view; base rows are not read again."""
    measures = [c for c in mv.columns if c not in keys]
    return mv.unionByName(fresh).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in measures])


def new_rows(src: DataFrame, target: DataFrame | None, ts: str, lookback: str = "0 seconds") -> DataFrame:
    """Rows an incremental run must load: all on the first run, later those past the loaded high mark, and those without a time."""
    if target is None:
        return src
    mark = target.agg(F.max(ts)).first()[0]
    if mark is None:
        return src
    return src.filter((F.col(ts) > F.lit(mark).cast(dict(src.dtypes)[ts]) - F.expr(f"INTERVAL {lookback}")) | F.col(ts).isNull())


def run_incremental(
    src: DataFrame, target: DataFrame | None, keys: list[str], ts: str, lookback: str, checks: dict[str, str]
) -> DataFrame:
    """Rows to append in one incremental run.

    Only the stretch of the target inside the lookback is compared with the source, so a run
    costs as much as its new rows, not as the whole table. A key keeps its time: a row loaded
    before is not loaded again. A row without a time lies in every stretch, so it is loaded once. ``checks`` maps an assertion name to a predicate every row must
    meet.
    """
    fresh = new_rows(src, target, ts, lookback)
    if target is not None:
        loaded = new_rows(target, target, ts, lookback)
        fresh = fresh.join(loaded.select(*keys), keys, "left_anti")
    if checks:
        broken = fresh.agg(*[F.count_if(~F.coalesce(F.expr(p), F.lit(False))).alias(n) for n, p in checks.items()]).first()
        failed = {n: broken[n] for n in checks if broken[n]}
        if failed:
            raise ValueError(f"assertions failed: {failed}")
    return fresh
