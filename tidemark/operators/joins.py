"""Join operators. Plain equi-joins are left to Catalyst, which broadcasts a side only below its size limit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.geo import distance_m
from tidemark.operators.ordered import running_sum
from tidemark.sources.readers import latest_by

_KM_PER_DEGREE = 111.19


def pair_events(
    df: DataFrame, keys: list[str], ts: str, status: str, start: str, end: str, carry: list[str]
) -> DataFrame:
    """First ``start`` event and last ``end`` event per key, side by side.

    One pass of min/max aggregates with map-side combine: no self-join, and a key with many
    events costs no more than its partial aggregates. Keys without both events drop out, and so
    do keys whose last end lies before their first start.
    """
    at_start = F.struct(ts, *carry)
    first = F.min(F.when(F.col(status) == start, at_start))
    last = F.max(F.when(F.col(status) == end, at_start))
    paired = df.filter(F.col(status).isin(start, end)).groupBy(*keys).agg(first.alias("__a"), last.alias("__b"))
    return paired.filter(F.col("__b")[ts] >= F.col("__a")[ts]).select(
        *keys,
        *[F.col("__a")[c].alias(f"start_{c}") for c in [ts, *carry]],
        *[F.col("__b")[c].alias(f"end_{c}") for c in [ts, *carry]],
    )


def interval_join(left: DataFrame, lo: str, hi: str, points: DataFrame, p: str, bucket: int, on: list[str] = ()) -> DataFrame:
    """Points inside closed intervals, as an equi-join on buckets of ``bucket`` units.

    An interval is repeated once per bucket it touches, so pick a bucket near the usual length.
    """
    spans = left.withColumn("__b", F.explode(F.sequence(F.floor(F.col(lo) / bucket), F.floor(F.col(hi) / bucket))))
    marks = points.withColumn("__b", F.floor(F.col(p) / bucket))
    return spans.join(marks, ["__b", *on]).filter(F.col(p).between(F.col(lo), F.col(hi))).drop("__b")


def interval_load(df: DataFrame, keys: list[str], lo: str, hi: str, weight: str) -> DataFrame:
    """Total ``weight`` of the closed intervals that cover each point, for integer bounds.

    A sweep: each interval adds its weight at ``lo`` and takes it back after ``hi``. Those steps
    are summed per point first, and the running totals and next points are taken in the same blocks of the
    order, so no key has to fit in one task. Intervals without both bounds cover nothing.
    """
    w = F.col(weight).cast("decimal(28,6)")
    steps = df.dropna(subset=[lo, hi]).select(
        *keys,
        F.explode(F.array(
            F.struct(F.col(lo).alias("point"), w.alias("d"), F.lit(1).alias("n")),
            F.struct((F.col(hi) + 1).alias("point"), (-w).alias("d"), F.lit(-1).alias("n")),
        )).alias("s"),
    )
    deltas = steps.groupBy(*keys, "s.point").agg(F.sum("s.d").alias("d"), F.sum("s.n").alias("n"))
    levels = running_sum(deltas, keys, ["point"], {"d": "total", "n": "active"}, "until")
    return levels.filter("active > 0").select(
        *keys, F.explode(F.sequence("point", F.col("until") - 1)).alias("point"), "total", "active"
    )


def count_in_intervals(intervals: DataFrame, key: str, lo: str, hi: str, points: DataFrame, p: str) -> DataFrame:
    """Number of points in each closed interval, without building the matching pairs; 0 if a bound is missing.

    Points and interval ends are put in one order and counted from the left; the answer is the
    count at the right end minus the count before the left end.
    """
    marks = points.select(F.col(p).alias("at"), F.lit(1).alias("step"), F.lit(1).alias("one"))
    starts = intervals.select(F.col(lo).alias("at"), F.lit(0).alias("step"), F.lit(0).alias("one"))
    ends = intervals.select(F.col(hi).alias("at"), F.lit(2).alias("step"), F.lit(0).alias("one"))
    seen = running_sum(marks.union(starts).union(ends), [], ["at", "step"], {"one": "seen"})
    before = seen.filter("step = 0").select(F.col("at").alias(lo), F.col("seen").alias("__before"))
    after = seen.filter("step = 2").select(F.col("at").alias(hi), F.col("seen").alias("__after"))
    return (
        intervals.select(key, lo, hi)
        .join(before, lo, "left")
        .join(after, hi, "left")
        .select(key, lo, hi, F.coalesce(F.col("__after") - F.col("__before"), F.lit(0)).alias("points"))
    )


def match_on(left: DataFrame, right: DataFrame, keys: list[tuple[Column, Column]], how: str = "inner") -> DataFrame:
    """Equi-join on derived keys (dates, texts of amounts)."""
    a = left.withColumns({f"__k{i}": k[0] for i, k in enumerate(keys)})
    b = right.withColumns({f"__k{i}": k[1] for i, k in enumerate(keys)})
    names = [f"__k{i}" for i in range(len(keys))]
    return a.join(b, names, how).drop(*names)


def not_in(df: DataFrame, key: str, other: DataFrame, other_key: str) -> DataFrame:
    """``key NOT IN (SELECT other_key ...)`` with its NULL rules, as a plain anti-join.

    The SQL form always broadcasts the subquery, whatever its size. Here two scalar facts settle
    the NULL cases and the rest is an equi-join that can shuffle.
    """
    facts = other.agg((F.count("*") == 0).alias("empty"), (F.count_if(F.col(other_key).isNull()) > 0).alias("has_null"))
    empty, has_null = facts.select("empty").scalar(), facts.select("has_null").scalar()
    known = other.select(F.col(other_key).alias(key)).filter(F.col(key).isNotNull())
    return df.join(known, key, "left_anti").filter(empty | (F.col(key).isNotNull() & ~has_null))


def supply_gap(moves: DataFrame, needed: Column, keys: list[str], day: str, qty: str, max_gap: float) -> DataFrame:
    """Days with demand and supply on which running supply exceeds running demand by at most ``max_gap``.

    ``needed`` tells demand from supply; other values than true and false are neither. One pass over the
    rows feeds one running sum with both as measures.
    """
    zero = F.lit(0).cast(dict(moves.dtypes)[qty])
    sides = moves.filter(needed.isNotNull()).dropna(subset=keys).select(
        *keys, day, F.when(needed, F.col(qty)).otherwise(zero).alias("__need"), F.when(~needed, F.col(qty)).otherwise(zero).alias("__have"),
        needed.cast("int").alias("__needs"), (~needed).cast("int").alias("__haves"))
    measures = {"__need": "required", "__have": "available", "__needs": "__n", "__haves": "__h"}
    totals = running_sum(sides, keys, [day], measures)
    gap = F.col("available") - F.col("required")
    both = totals.filter("__needs > 0 AND __haves > 0").filter(gap <= max_gap)
    return both.select(*keys, day, "required", "available", gap.alias("in_stock"))


def nearest(
    left: DataFrame, right: DataFrame, key: str, lat: str, lon: str, max_km: float, cell_deg: float = 1.0
) -> DataFrame:
    """Nearest ``right`` point within ``max_km`` of each ``left`` point, by grid cells.

    ``right`` has columns ``key``, ``lat`` and ``lon``. Equal left points are looked up once, and
    the running minimum sits right after the join, so candidate pairs are never shuffled. Cells
    wrap at the date line and widen towards the poles, so no neighbour is missed.
    """
    cells = int(round(360 / cell_deg))
    reach_lat = int(-(-max_km // (_KM_PER_DEGREE * cell_deg)))
    row = F.floor((F.col(lat) + 90) / cell_deg).cast("int")
    col = F.floor((F.col(lon) + 180) / cell_deg).cast("int")
    widest = F.least(F.abs(F.col(lat)) + F.lit(max_km / _KM_PER_DEGREE), F.lit(90.0))
    reach_lon = F.least(
        F.ceil(F.lit(max_km) / (F.lit(_KM_PER_DEGREE * cell_deg) * F.greatest(F.cos(F.radians(widest)), F.lit(1e-6)))),
        F.lit(cells // 2),
    ).cast("int")

    points = left.select(lat, lon).distinct().withColumns({"__row": row, "__col": F.pmod(col, F.lit(cells))})
    spread = (
        right.select(F.col(key).alias("__key"), F.col(lat).alias("__lat"), F.col(lon).alias("__lon"), row.alias("__r"),
                     col.alias("__c"), reach_lon.alias("__w"))
        .withColumn("__row", F.explode(F.sequence(F.col("__r") - reach_lat, F.col("__r") + reach_lat)))
        .withColumn("__col", F.explode(F.array_distinct(F.transform(
            F.sequence(F.col("__c") - F.col("__w"), F.col("__c") + F.col("__w")), lambda c: F.pmod(c, F.lit(cells))))))
    )
    gap = distance_m(F.col(lat), F.col(lon), F.col("__lat"), F.col("__lon"))
    best = (
        points.join(spread, ["__row", "__col"])
        .withColumn("__m", gap)
        .filter(F.col("__m") <= max_km * 1000)
        .groupBy(lat, lon)
        .agg(F.min(F.struct("__m", "__key")).alias("__best"))
    )
    return left.join(best, [lat, lon]).select(
        left["*"], F.col("__best.__key").alias(key), F.col("__best.__m").alias("distance_m")
    )


def left_join_ranked(left: DataFrame, right: DataFrame, keys: list[str], order_by: list[Column]) -> DataFrame:
    """Left join to the first row per key of the other side."""
    return left.join(latest_by(right, keys, order_by), keys, "left")


def lookup(df: DataFrame, dim: DataFrame, key: str, value: str, default: str = "(unknown)") -> DataFrame:
    """Dictionary lookup with a default for unknown keys."""
    return df.join(dim.select(key, value), key, "left").withColumn(value, F.coalesce(F.col(value), F.lit(default)))
