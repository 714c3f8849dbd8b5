"""Seasonal forecasts against the plain recursion, however the series is cut."""

import datetime as dt
import math
import random

import pytest

from tidemark.operators.seasonal import GRID, seasonal_forecast, seasonal_forecast_by_time

SCHEMA = "name string, step long, y double"


def plain(points, season, horizon, grid=GRID):
    """Value, error and weights of one series, step by step."""
    at = {s - min(p[0] for p in points): y for s, y in points}
    last = max(at)
    head, second = [at[i] for i in range(season) if i in at], [at[i] for i in range(season, 2 * season) if i in at]
    tried = []
    for a, b, c in grid:
        level = sum(head) / len(head)
        trend = (sum(second) / len(second) - level) / season if second else 0.0
        shape = [at[i] - sum(head) / len(head) if i in at else 0.0 for i in range(season)]
        sse = n = 0
        for i in range(season, last + 1):
            e = at[i] - (level + trend + shape[i % season]) if i in at else 0.0
            sse, n = sse + e * e, n + (i in at)
            level, trend, shape[i % season] = level + trend + a * e, trend + a * b * e, shape[i % season] + c * (1 - a) * e
        if n:
            tried.append((sse, (a, b, c), n, [level + h * trend + shape[(last + h) % season] for h in range(1, horizon + 1)]))
    return min(tried, key=lambda r: r[0]) if tried else None


def series(seed, n, season, missing=0.0):
    r = random.Random(seed)
    return [(k, 50 + 0.3 * k + 20 * math.sin(2 * math.pi * k / season) + r.gauss(0, 3)) for k in range(n) if k in (0, n - 1) or r.random() >= missing]


@pytest.mark.parametrize("block", [1, 7, 100, 1 << 16])
def test_blocks_compose_to_the_recursion(spark, block):
    known = {"whole": series(1, 400, 12), "gaps": series(2, 300, 12, 0.4), "short": series(3, 15, 12), "hole": [p for p in series(4, 500, 12) if p[0] < 40 or p[0] > 390]}
    rows = [(name, s + 1000, y) for name, points in known.items() for s, y in points] + [("single", 5, 1.0), ("whole", None, 1.0), ("whole", 1003, None), ("one season", 1, 1.0), ("one season", 9, 2.0)]
    if block == 1:
        rows = [r for r in rows if r[0] in ("short", "single")]
    got = seasonal_forecast(spark.createDataFrame(rows, SCHEMA), "y", "step", 12, 5, id_cols=["name"], block_steps=block).collect()
    names = {r[0] for r in rows} & set(known)
    assert {r["name"] for r in got} == names
    for name in names:
        sse, weights, n, values = plain(known[name], 12, 5)
        mine = sorted((r for r in got if r["name"] == name), key=lambda r: r["forecast_step"])
        assert [r["forecast_step"] for r in mine] == [1000 + known[name][-1][0] + h for h in range(1, 6)]
        assert [r["forecast_value"] for r in mine] == pytest.approx(values, rel=1e-9)
        assert (mine[0]["level_weight"], mine[0]["trend_weight"], mine[0]["season_weight"]) == weights
        assert mine[0]["backtest_rmse"] == pytest.approx(math.sqrt(sse / n), rel=1e-9)
        widths = [r["interval_upper"] - r["interval_lower"] for r in mine]
        assert widths == sorted(widths)


def test_season_beats_the_straight_line(spark):
    from tidemark.operators.models import forecast

    points = series(9, 240, 24)
    df = spark.createDataFrame([("s", k, y) for k, y in points[:-24]], SCHEMA)
    truth = dict(points[-24:])
    mine = {r["forecast_step"]: r["forecast_value"] for r in seasonal_forecast(df, "y", "step", 24, 24, id_cols=["name"]).collect()}
    line = {r["forecast_step"]: r["forecast_value"] for r in forecast(df, "y", "step", 24, id_cols=["name"]).collect()}
    off = lambda found: sum(abs(found[k] - truth[k]) for k in truth)
    assert off(mine) < 0.5 * off(line)


def test_times_nulls_and_repeated_rows(spark):
    began = dt.datetime(2024, 2, 27)
    points = [(None, began + dt.timedelta(days=k), 10.0 * (k % 7) + k, k) for k in range(35)]
    df = spark.createDataFrame(points + points[3:6] + [("x", None, 1.0, 0), (None, began, None, 0)], "name string, ts timestamp_ntz, y double, forecast_value long")
    got = seasonal_forecast_by_time(df, "y", "ts", "3 DAYS", "7 DAYS", id_cols=["name"]).orderBy("forecast_timestamp").collect()
    assert [(r["name"], r["forecast_timestamp"]) for r in got] == [(None, began + dt.timedelta(days=k)) for k in (35, 36, 37)]
    assert [r["forecast_value"] for r in got] == pytest.approx([35, 46, 57], abs=0.5)
    alone = seasonal_forecast_by_time(df.filter("name IS NULL").drop("name"), "y", "ts", "3 DAYS", "7 DAYS").orderBy("forecast_timestamp").collect()
    assert [r["forecast_value"] for r in alone] == [r["forecast_value"] for r in got]


def test_empty_series(spark):
    assert seasonal_forecast(spark.createDataFrame([], SCHEMA), "y", "step", 7, 3, id_cols=["name"]).count() == 0
    with pytest.raises(ValueError):
        seasonal_forecast_by_time(spark.createDataFrame([], "ts timestamp_ntz, y double"), "y", "ts", "1 DAY", "7 DAYS")
    with pytest.raises(ValueError):
        seasonal_forecast(spark.createDataFrame([], SCHEMA), "y", "step", 0, 3)
