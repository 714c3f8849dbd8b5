"""Projection, filter and set operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.search import search_columns
from tidemark.operators.ordered import number_rows


def categorize(col: Column, rules: list[tuple[str, str]], default: str) -> Column:
    """First label whose lower-case LIKE pattern fits."""
    text = F.lower(col)
    start = F.when(text.like(rules[0][0]), rules[0][1])
    return reduce(lambda c, r: c.when(text.like(r[0]), r[1]), rules[1:], start).otherwise(default)


def score_rules(rules: list[tuple[Column, object]], default: object) -> Column:
    """Value of the first rule that holds."""
    start = F.when(*rules[0])
    return reduce(lambda c, r: c.when(*r), rules[1:], start).otherwise(default)


def wind_speed_mph(u: Column, v: Column) -> Column:
    """Magnitude of a wind vector given in metres per second."""
    return F.sqrt(F.pow(u, 2) + F.pow(v, 2)) * 2.23694


def fahrenheit(celsius: Column) -> Column:
    return celsius * 9 / 5 + 32


# The public wind-chill and heat-index coefficients of the US weather service.
WIND_CHILL = (35.74, 0.6215, -35.75, 0.4275, 0.16)
HEAT_INDEX = (
    -42.379, 2.04901523, 10.14333127, -0.22475541, -0.00683783, -0.05481717, 0.00122874, 0.00085282, -0.00000199,
)


def feels_like(temp_f: Column, wind_mph: Column, humidity: Column) -> Column:
    """Wind chill below 50 F with wind, heat index above 80 F with humidity, otherwise the temperature."""
    c0, c_t, c_w, c_tw, power = WIND_CHILL
    gust = F.pow(wind_mph, F.lit(power))
    chill = c0 + c_t * temp_f + c_w * gust + c_tw * temp_f * gust
    t2, h2 = F.pow(temp_f, 2), F.pow(humidity, 2)
    terms = (F.lit(1.0), temp_f, humidity, temp_f * humidity, t2, h2, t2 * humidity, temp_f * h2, t2 * h2)
    heat = reduce(lambda a, b: a + b, (k * x for k, x in zip(HEAT_INDEX, terms)))
    return (
        F.when((temp_f < 50) & (wind_mph > 3), chill)
        .when((temp_f > 80) & (humidity > 40), heat)
        .otherwise(temp_f)
    )


def shorten(col: Column, size: int) -> Column:
    """Cut long display text and mark the cut."""
    return F.when(F.length(col) > size, F.concat(F.substring(col, 1, size), F.lit("..."))).otherwise(col)


def add_surrogate_key(df: DataFrame, order_by: list[Column], name: str, after: DataFrame | None = None) -> DataFrame:
    """Dense key in sort order, starting at 1 or, given the existing table, after its highest key."""
    start: Column | int = 1
    if after is not None:
        start = F.lit((after.agg(F.max(name)).first()[0] or 0) + 1)
    return number_rows(df, order_by, name, start)


def clean_typed(df: DataFrame, spec: dict[str, tuple[str, str]]) -> tuple[DataFrame, DataFrame]:
    """Text columns to typed ones; rows with a text that does not convert go to the rejects.

    ``spec`` maps a column to ``(regex to strip, target type)``.
    """
    tried = {c: F.trim(F.regexp_replace(c, strip, "")).try_cast(kind) for c, (strip, kind) in spec.items()}
    bad = reduce(lambda a, b: a | b, (F.col(c).isNotNull() & v.isNull() for c, v in tried.items()))
    return df.filter(~bad).withColumns(tried), df.filter(bad)


def recent(df: DataFrame, ts: str, interval: str, as_of: Column | None = None) -> DataFrame:
    """Rows newer than ``interval`` before ``as_of`` (default: the newest row)."""
    ref = as_of if as_of is not None else df.agg(F.max(ts)).scalar()
    return df.filter(F.col(ts) > ref - F.expr(f"INTERVAL {interval}"))


def latest_period(df: DataFrame, ts: str, unit: str) -> DataFrame:
    """Rows of the last calendar period (month, quarter, year) that holds data."""
    kind = dict(df.dtypes)[ts]
    start = df.agg(F.date_trunc(unit, F.max(ts)).cast(kind)).scalar()
    return df.filter(F.col(ts) >= start)


def search(df: DataFrame, cols: list[str] | None, term: str, analyzer: str = "log") -> DataFrame:
    """Rows whose text columns hold ``term`` (see :mod:`tidemark.functions.search`)."""
    return df.filter(search_columns(df, cols, term, analyzer))


def union_padded(parts: dict[str, DataFrame], tag: str) -> DataFrame:
    """UNION ALL of differing schemas; missing columns become NULL and ``tag`` names the source."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def union_detections(df: DataFrame, keep: list[str], specs: list[tuple[str, str, str]]) -> DataFrame:
    """Stack JSON detection arrays into one long table.

    Each spec is ``(detection type, JSON column, name field)``; each array item has a score.
    """

    def one(kind: str, col: str, field: str) -> DataFrame:
        items = F.from_json(col, f"array<struct<{field} string, score double>>")
        rows = df.select(*keep, F.explode(items).alias("item"))
        return rows.select(
            *keep,
            F.lit(kind).alias("detection_type"),
            F.replace(F.col(f"item.{field}"), F.lit('"'), F.lit("")).alias("name"),
            F.col("item.score").alias("score"),
        )

    return reduce(DataFrame.unionByName, (one(*s) for s in specs))


def bin_label(col: Column, edges: list[float]) -> Column:
    """Half-open bins ``lo-hi`` and an open last bin ``hi+``."""
    names = [f"{lo:g}-{hi:g}" for lo, hi in zip(edges, edges[1:])] + [f"{edges[-1]:g}+"]
    start = F.when(col < edges[1], names[0])
    inner = reduce(lambda c, i: c.when(col < edges[i + 1], names[i]), range(1, len(edges) - 1), start)
    return inner.otherwise(names[-1])


def bin_counts(df: DataFrame, col: str, edges: list[float]) -> DataFrame:
    return df.groupBy(bin_label(F.col(col), edges).alias("bin")).agg(F.count("*").alias("n"))
