"""Order-dependent operators that never put one key, or the whole table, into one task.

Rows are cut into range blocks of the sort order, so a key with many rows spreads over many
blocks. Each block works alone, and a block summary corrects it. The summary has at most one row
per block boundary, so broadcasting it is bounded by the number of blocks, not by the data.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import materialize

_BLOCK = "__block"


def _blocks(df: DataFrame, order_by: list[Column], label: str) -> DataFrame:
    """Range partition id stored with each row; written, so that later passes see the same cut.

    No count is given: AQE joins neighbouring small ranges, so blocks fit the data, and there are
    never more of them than shuffle partitions.
    """
    ranged = df.repartitionByRange(*order_by)
    return materialize(ranged.withColumn(_BLOCK, F.spark_partition_id()), label)


def number_rows(df: DataFrame, order_by: list[Column], name: str, start: Column | int = 1) -> DataFrame:
    """Global 1..n numbering in ``order_by`` order (give a unique tie-breaker)."""
    cut = _blocks(df, order_by, "numbered")
    sizes = cut.groupBy(_BLOCK).agg(F.count("*").alias("__n"))
    before = Window.orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(_BLOCK, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    first = start if isinstance(start, Column) else F.lit(start)
    inside = F.row_number().over(Window.partitionBy(_BLOCK).orderBy(*order_by))
    return (
        cut.withColumn("__rn", inside)
        .join(F.broadcast(offsets), _BLOCK)
        .withColumn(name, (F.col("__rn") + F.col("__offset") + first - 1).cast("long"))
        .drop(_BLOCK, "__rn", "__offset")
    )


def _same(left: DataFrame, right: DataFrame, cols: list[str]) -> Column:
    """Null-safe equality on several columns."""
    return reduce(lambda a, b: a & b, (left[c].eqNullSafe(right[c]) for c in cols))


def running_sum(df: DataFrame, keys: list[str], order_by: list[str], measures: dict[str, str], next_name: str | None = None) -> DataFrame:
    """Running totals per key with peers tied (the default RANGE frame).

    Rows of the same key and order value are summed first, so the result has one row per
    ``keys + order_by``: the sum of the peers under its own name and each total under the name
    given in ``measures`` (column to total name). ``next_name`` adds the next value of the one
    order column, from the same blocks.
    """
    peers = df.groupBy(*keys, *order_by).agg(*[F.sum(c).alias(c) for c in measures])
    cut = _blocks(peers, [F.col(c) for c in keys + order_by], "running")
    parts = cut.groupBy(_BLOCK, *keys).agg(*[F.sum(c).alias(f"__p_{c}") for c in measures], F.min(order_by[0]).alias("__least"))
    # a key holds one row per block here; only keys that span blocks keep a row after the filter
    by_key = Window.partitionBy(*keys).orderBy(_BLOCK)
    before = by_key.rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select(
        _BLOCK, *keys, F.count("*").over(before).alias("__seen"), F.lead("__least").over(by_key).alias("__ahead"),
        *[F.sum(f"__p_{c}").over(before).alias(f"__b_{c}") for c in measures],
    ).filter("__seen > 0 OR __ahead IS NOT NULL" if next_name else "__seen > 0")
    inside = Window.partitionBy(_BLOCK, *keys).orderBy(*order_by)
    follows = [F.lead(order_by[0]).over(inside).alias("__follows")] if next_name else []
    totals = cut.select("*", *[F.sum(c).over(inside).alias(f"__r_{c}") for c in measures], *follows)
    joined = totals.join(F.broadcast(carried), _same(totals, carried, [_BLOCK, *keys]), "left")
    return joined.select(
        *[totals[c] for c in [*keys, *order_by, *measures]],
        *[(F.col(f"__r_{c}") + F.coalesce(F.col(f"__b_{c}"), F.lit(0))).alias(n) for c, n in measures.items()],
        *([F.coalesce("__follows", "__ahead").alias(next_name)] if next_name else []),
    )


def previous_value(df: DataFrame, keys: list[str], order_by: str, name: str) -> DataFrame:
    """Previous ``order_by`` value of the same key (LAG by one) as column ``name``."""
    cut = _blocks(df, [F.col(c) for c in [*keys, order_by]], "lagged")
    last = cut.groupBy(_BLOCK, *keys).agg(F.max(order_by).alias("__last"))
    by_key = Window.partitionBy(*keys).orderBy(_BLOCK)
    carried = last.select(_BLOCK, *keys, F.lag("__last").over(by_key).alias("__carry")).filter("__carry IS NOT NULL")
    inside = Window.partitionBy(_BLOCK, *keys).orderBy(order_by)
    lagged = cut.withColumn(name, F.lag(order_by).over(inside))
    joined = lagged.join(F.broadcast(carried), _same(lagged, carried, [_BLOCK, *keys]), "left")
    return joined.select(
        *[lagged[c] for c in df.columns], F.coalesce(lagged[name], F.col("__carry")).alias(name)
    )


def batch_slice(df: DataFrame, order_by: list[Column], lo: int, hi: int, name: str = "row_number") -> DataFrame:
    """Rows ``lo`` to ``hi`` of the global order, numbered.

    Rows are numbered in blocks of the order, so a page far down costs no more than the first, and no task holds all before it.
    """
    return number_rows(df, order_by, name).filter(F.col(name).between(lo, hi))
