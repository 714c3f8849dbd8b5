"""Aggregation and ranking operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.semantics import round_to_long
from tidemark.sources.readers import latest_by


def time_histogram(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """Row count per weekday (1 = Sunday) and hour as columns, in one pass."""
    day, hour = F.dayofweek(ts), F.hour(ts)
    return df.groupBy(*keys).agg(
        F.count("*").alias("total"),
        *[F.count_if(day == d).alias(f"dow_{d}") for d in range(1, 8)],
        *[F.count_if(hour == h).alias(f"hour_{h}") for h in range(24)],
    )


def _sum(cols: list[str]) -> Column:
    return reduce(lambda a, b: a + b, (F.col(c) for c in cols))


def leading_group(groups: dict[str, list[str]], total: Column, share: float, otherwise: str) -> Column:
    """Name of the first group of count columns that holds more than ``share`` of the total (rounded to whole rows)."""
    bar = round_to_long(total * F.lit(share))
    picked = F.lit(otherwise)
    for name, cols in reversed(groups.items()):
        picked = F.when(_sum(cols) > bar, name).otherwise(picked)
    return picked


def band_label(value: Column, bands: list[tuple[float, str]], above: str) -> Column:
    """Name of the first band (upper bound included, ascending) that holds the value."""
    picked = F.lit(above)
    for bound, name in reversed(bands):
        picked = F.when(value <= bound, name).otherwise(picked)
    return picked


def daily_spread(df: DataFrame, key: str, day: Column, amount: Column) -> DataFrame:
    """Mean and sample deviation of each key's daily totals."""
    daily = df.groupBy(F.col(key), day.alias("day")).agg(F.sum(amount).alias("daily"))
    return daily.groupBy(key).agg(F.avg("daily").alias("average_daily"), F.stddev_samp("daily").alias("stddev_daily"))


def steady_entities(df: DataFrame, key: str, day: Column, amount: Column, max_std: float) -> DataFrame:
    """Keys whose daily totals vary little."""
    return daily_spread(df, key, day, amount).filter(F.col("stddev_daily") < max_std)


def pivot(df: DataFrame, keys: list[str], col: str, values: list, aggs: list[Column]) -> DataFrame:
    """PIVOT with a fixed value list, so no extra pass looks the values up."""
    return df.groupBy(*keys).pivot(col, values).agg(*aggs)


def trend_label(current: Column, prior: Column, bands: list[tuple[float, str]], above: str) -> Column:
    """Band of the relative change from the prior value; no prior value falls into the last band."""
    return band_label(F.try_divide(current - prior, prior), bands, above)


def compare_windows(
    df: DataFrame, keys: list[str], ts: str, measures: list[str], current: str, history: str,
    bands: list[tuple[float, str]], above: str, as_of: Column | None = None
) -> DataFrame:
    """Averages of each measure in the newest window against the history before it, with the band of its change."""
    ref = as_of if as_of is not None else df.agg(F.max(ts)).scalar()
    kept = df.filter(F.col(ts) > ref - F.expr(f"INTERVAL {history}")).withColumn(
        "__w", F.when(F.col(ts) > ref - F.expr(f"INTERVAL {current}"), "current").otherwise("prior")
    )
    aggs = [F.avg(m).alias(f"avg_{m}") for m in measures] + [F.count(F.lit(1)).alias("rows")]
    # a window without rows counts zero, not NULL
    wide = pivot(kept, keys, "__w", ["current", "prior"], aggs).fillna(0, ["current_rows", "prior_rows"])
    return wide.withColumns({f"{m}_trend": trend_label(F.col(f"current_avg_{m}"), F.col(f"prior_avg_{m}"), bands, above) for m in measures})


def top_per_group(df: DataFrame, keys: list[str], order_by: list[Column], n: int, ties: bool = False) -> DataFrame:
    """First ``n`` rows per key; with ``ties`` equal rows share a rank and all stay.

    Catalyst prunes to ``n`` per key inside each task before it shuffles.
    """
    w = Window.partitionBy(*keys).orderBy(*order_by)
    rank = F.rank() if ties else F.row_number()
    return df.withColumn("rank", rank.over(w)).filter(F.col("rank") <= n)


def mode_per_key(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Most frequent value per key; the smaller value wins a tie."""
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("n"))
    return latest_by(counts, keys, [F.desc("n"), F.asc(value)])


# Aggregates of which no result is a value of one row.
PRIVATE_AGGREGATES = {"avg": F.avg, "sum": F.sum, "count": F.count, "count_distinct": F.count_distinct, "stddev": F.stddev_samp, "variance": F.var_samp}


def private_agg(df: DataFrame, keys: list[Column], entity: str, measures: dict[str, tuple[str, str]], min_entities: int) -> DataFrame:
    """Aggregates of groups that hold at least ``min_entities`` distinct entities.

    ``measures`` names a function of ``PRIVATE_AGGREGATES`` and a column for each result. Others are refused: a minimum, a maximum
    or a list would hand rows back. A missing entity counts as none.
    """
    refused = sorted({fn for fn, _ in measures.values()} - set(PRIVATE_AGGREGATES))
    if refused:
        raise ValueError(f"not allowed on private rows: {', '.join(refused)}")
    aggs = [PRIVATE_AGGREGATES[fn](F.col(c)).alias(name) for name, (fn, c) in measures.items()]
    grouped = df.groupBy(*keys).agg(F.count_distinct(entity).alias("entities"), *aggs)
    return grouped.filter(F.col("entities") >= min_entities)


def first_by(df: DataFrame, keys: list[str], order_by: str, cols: dict[str, str]) -> DataFrame:
    """Value of each column in the first row per key."""
    return df.groupBy(*keys).agg(*[F.min_by(c, order_by).alias(n) for c, n in cols.items()])


def envelope(df: DataFrame, keys: list[str], ts: str, maxes: list[str]) -> DataFrame:
    """First and last time per key, whole minutes between them, and maxima."""
    spans = df.groupBy(*keys).agg(
        F.min(ts).alias("started"), F.max(ts).alias("ended"), *[F.max(c).alias(f"max_{c}") for c in maxes]
    )
    return spans.withColumn("minutes", F.timestamp_diff("MINUTE", "started", "ended"))


def customer_profile(lines: DataFrame, customer: str, amount: Column, product: str, category: str, digits: int = 2) -> DataFrame:
    """Spend, average ticket, count, and favourite product and category per customer.

    Lines are read once into customer and product counts; the three answers roll up from those.
    """
    base = lines.groupBy(customer, product, category).agg(F.sum(amount).alias("spend"), F.count("*").alias("n"))
    spend = base.groupBy(customer).agg(
        F.round(F.sum("spend"), 2).alias("total_spend"),
        F.round(F.sum("spend") / F.sum("n"), digits).alias("average_ticket"),
        F.sum("n").alias("transactions"),
    )

    def favourite(col: str, name: str) -> DataFrame:
        counts = base.groupBy(customer, col).agg(F.sum("n").alias("n"))
        return latest_by(counts, [customer], [F.desc("n"), F.asc(col)]).select(customer, F.col(col).alias(name))

    return spend.join(favourite(product, "favorite_product"), customer, "left").join(
        favourite(category, "favorite_category"), customer, "left"
    )


def period_change(df: DataFrame, keys: list[str], order_by: list[str], measures: list[str]) -> DataFrame:
    """Previous period's value and relative change of each measure; NULL on a zero base.

    Input is one row per key and period, so a key's window is as long as its calendar.
    """
    w = Window.partitionBy(*keys).orderBy(*order_by)
    prior = df.withColumns({f"prior_{m}": F.lag(m).over(w) for m in measures})
    return prior.withColumns({
        f"change_{m}": F.try_divide((F.col(m) - F.col(f"prior_{m}")).cast("double"), F.col(f"prior_{m}").cast("double"))
        for m in measures
    })


def keep_top(df: DataFrame, key: str, score: str, mark: int, keep: int, flag: str) -> DataFrame:
    """Mark the ``mark`` best rows and keep only the ``keep`` best flagged ones."""
    order = [F.desc(score), F.asc(key)]
    best = df.orderBy(*order).limit(mark).select(key, F.lit(True).alias("__best"))
    marked = df.join(best, key, "left").withColumn(flag, F.col(flag) | F.coalesce("__best", F.lit(False))).drop("__best")
    kept = marked.filter(F.col(flag)).orderBy(*order).limit(keep).select(key)
    return marked.join(kept, key, "left_semi")


# Fixed value: price of one byte read, at 6.25 per 2^40 bytes.
PRICE_PER_BYTE = "0.00000000000568434188608080"


def job_cost(jobs: DataFrame, stages: str, timeline: str, duration_ms: str) -> DataFrame:
    """Cost, average slots, highest slots of a stage and most runnable units of each job.

    ``stages`` holds (slot_ms, start_ms, end_ms) structs and ``timeline`` (runnable_units)
    structs. Both lists belong to one job, so maxima are taken inside the row: exploding both, as
    a cross product, would multiply rows and change nothing.
    """
    stage_slots = F.transform(stages, lambda s: F.try_divide(s["slot_ms"], s["end_ms"] - s["start_ms"]))
    return jobs.withColumns({
        "cost": F.when(F.col("reservation_id").isNull(), F.col("bytes_billed").cast("decimal(20,0)") * F.lit(PRICE_PER_BYTE).cast("decimal(30,26)"))
        .otherwise(F.lit(0)).cast("double"),
        "avg_slots": F.try_divide(F.col("slot_ms").cast("double"), F.col(duration_ms).cast("double")),
        "max_stage_slots": F.array_max(stage_slots),
        "runnable_units": F.array_max(F.transform(timeline, lambda u: u["runnable_units"])),
    })
