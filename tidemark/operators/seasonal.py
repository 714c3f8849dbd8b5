"""Seasonal forecasts by additive triple smoothing, for series of any length.

Level, trend and the values of one season are a state that each observation changes by an affine map. Maps compose, so a long
series is cut into blocks of steps: each block is reduced to its map, a scan over the blocks of a series gives the state in which
each begins, and the blocks then measure their one-step errors side by side. No task holds more than one block of observations,
or the maps of the blocks of one series. Steps without an observation only carry the trend on.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import product
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.operators.models import horizon_steps, infer_granularity
from tidemark.session import materialize

BLOCK_STEPS = 1 << 16
# Weights of level, trend and season that are tried for each series; the least backtest error decides.
GRID = tuple(product((0.2, 0.5, 0.8), (0.05, 0.2), (0.1, 0.4)))


class _Maps:
    """States as columns: combinations by (level, trend, season values) by columns, moved through the observations."""

    def __init__(self, grid: Sequence[tuple[float, float, float]], states: np.ndarray, season: int):
        a, b, c = (np.array([g[k] for g in grid])[:, None] for k in range(3))
        self.gain = a, a * b, c * (1 - a)
        self.x, self.season = states, season

    def skip(self, steps: int) -> None:
        """Steps without an observation."""
        if steps > 0:
            self.x[:, 0] += self.x[:, 1] * steps

    def step(self, at: int, y: np.ndarray) -> np.ndarray:
        """One step; ``y`` is what each column observes. The errors of the step."""
        slot = 2 + at % self.season
        e = y - (self.x[:, 0] + self.x[:, 1] + self.x[:, slot])
        self.x[:, 0] += self.x[:, 1] + self.gain[0] * e
        self.x[:, 1] += self.gain[1] * e
        self.x[:, slot] += self.gain[2] * e
        return e


def _block_map(at: np.ndarray, y: np.ndarray, start: int, season: int, grid) -> np.ndarray:
    """The affine map of a block, from the state before step ``start`` to that after its last observation."""
    size = season + 2
    maps = _Maps(grid, np.repeat(np.eye(size, size + 1)[None], len(grid), 0), season)
    seen, last = np.zeros(size + 1), start - 1
    for k, v in zip(at.tolist(), y.tolist()):
        maps.skip(k - 1 - last)
        seen[-1] = v
        maps.step(k, seen)
        last = k
    return maps.x


def _block_errors(at: np.ndarray, y: np.ndarray, start: int, states: np.ndarray, season: int, grid) -> np.ndarray:
    """Sum of the squared one-step errors of each combination."""
    maps = _Maps(grid, states[:, :, None].copy(), season)
    total, last = np.zeros(len(grid)), start - 1
    for k, v in zip(at.tolist(), y.tolist()):
        maps.skip(k - 1 - last)
        total += maps.step(k, np.array([v]))[:, 0] ** 2
        last = k
    return total


def seasonal_forecast(
    df: DataFrame, data_col: str, step_col: str, season: int, horizon: int, confidence_level: float = 0.95, id_cols: Sequence[str] = (),
    grid: Sequence[tuple[float, float, float]] = GRID, block_steps: int = BLOCK_STEPS,
) -> DataFrame:
    """Forecast of each series over integer steps, with a prediction interval and the backtest error of the weights used.

    The first season gives the level and the season's shape, the difference to the second one the trend. All later steps are
    forecast one step ahead under each combination of weights in ``grid``; the least root of the mean squared error wins, the
    earlier of equal ones. Several rows of a step are averaged; rows without a step or value are not used. A series without
    an observation after its first season gets no forecast.
    """
    keys, z = list(id_cols), NormalDist().inv_cdf(0.5 + confidence_level / 2)
    if season < 1:
        raise ValueError("a season has one step at least")
    step, y = F.col(step_col).cast("long"), F.col(data_col).cast("double")
    points = df.filter(step.isNotNull() & y.isNotNull()).groupBy(*keys, step.alias("__step")).agg(F.avg(y).alias("__y"))
    points = materialize(points.withColumn("__id", F.struct(*keys) if keys else F.struct(F.lit(0).alias("all"))), "series")
    spans = points.groupBy("__id").agg(F.min("__step").alias("__first"), F.max("__step").alias("__last"))
    # joins on the id, null-safe: a null in an id column is a value of its own
    ids = [f.name for f in points.schema["__id"].dataType.fields]
    code = F.to_json("__id", {"ignoreNullFields": "false"})
    spans = spans.withColumn("__series", code).drop("__id")
    rows = points.withColumn("__series", code).join(spans, "__series").withColumn("__at", F.col("__step") - F.col("__first"))

    early = rows.filter(F.col("__at") < 2 * season)
    first, second = F.avg(F.when(F.col("__at") < season, F.col("__y"))), F.avg(F.when(F.col("__at") >= season, F.col("__y")))
    shape = F.array_sort(F.collect_list(F.when(F.col("__at") < season, F.struct("__at", "__y"))))  # one season
    begin = early.groupBy("__series").agg(
        first.alias("__level"), F.coalesce((second - first) / season, F.lit(0.0)).alias("__trend"), shape.alias("__shape"),
        F.any_value("__last").alias("__last"), F.any_value("__first").alias("__first"), F.any_value("__id").alias("__id"))

    block = F.floor((F.col("__at") - season) / block_steps)
    later = rows.filter(F.col("__at") >= season).select("__series", block.cast("long").alias("__block"), "__at", "__y")

    def reduced(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("__at").to_numpy())
        at, seen = table.column("__at").to_numpy()[order], table.column("__y").to_numpy()[order]
        start = season + int(table.column("__block")[0].as_py()) * block_steps
        moved = _block_map(at, seen, start, season, grid)
        return pa.table({"__series": table.column("__series")[:1], "__block": table.column("__block")[:1], "__end": pa.array([int(at[-1])]), "__map": pa.array([moved.tobytes()], pa.binary())})

    maps = later.groupBy("__series", "__block").applyInArrow(reduced, "__series string, __block long, __end long, __map binary")

    def scanned(_key, init: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(init) and len(blocks):
            x = np.zeros((len(grid), season + 2))
            x[:, 0], x[:, 1] = init["__level"][0], init["__trend"][0]
            for r in init["__shape"][0]:
                if r is not None:
                    x[:, 2 + int(r["__at"]) % season] = r["__y"] - init["__level"][0]
            now = season - 1
            for r in blocks.sort_values("__block").itertuples():
                series, number, end, raw = r[1], int(r[2]), int(r[3]), r[4]
                start = season + number * block_steps
                x[:, 0] += x[:, 1] * (start - 1 - now)
                out.append((series, number, x.tobytes(), None))
                m = np.frombuffer(raw).reshape(len(grid), season + 2, season + 3)
                x = np.einsum("gij,gj->gi", m[:, :, :-1], x) + m[:, :, -1]
                now = end
            out.append((series, -1, None, x.tobytes()))
        return pd.DataFrame(out, columns=["__series", "__block", "__start", "__final"])

    states = materialize(
        begin.groupBy("__series").cogroup(maps.groupBy("__series")).applyInPandas(scanned, "__series string, __block long, __start binary, __final binary"), "states")

    def measured(_key, rows: pa.Table, state: pa.Table) -> pa.Table:
        order = np.argsort(rows.column("__at").to_numpy())
        at, seen = rows.column("__at").to_numpy()[order], rows.column("__y").to_numpy()[order]
        begin = np.frombuffer(state.column("__start")[0].as_py()).reshape(len(grid), season + 2)
        start = season + int(state.column("__block")[0].as_py()) * block_steps
        errors = _block_errors(at, seen, start, begin, season, grid)
        return pa.table({"__series": pa.array([state.column("__series")[0].as_py()] * len(grid)), "__choice": pa.array(range(len(grid)), pa.int32()), "__sse": pa.array(errors), "__n": pa.array([len(at)] * len(grid))})

    errors = (
        later.groupBy("__series", "__block").cogroup(states.filter("__start IS NOT NULL").groupBy("__series", "__block"))
        .applyInArrow(measured, "__series string, __choice int, __sse double, __n long")
        .groupBy("__series", "__choice").agg(F.sum("__sse").alias("__sse"), F.sum("__n").alias("__n"))
    )
    best = errors.groupBy("__series").agg(F.min(F.struct("__sse", "__choice", "__n")).alias("__best")).select("__series", "__best.*")
    ends = begin.drop("__shape", "__level", "__trend").join(states.filter("__final IS NOT NULL").select("__series", "__final"), "__series").join(best, "__series")

    def ahead(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                x = np.frombuffer(r["__final"]).reshape(len(grid), season + 2)[r["__choice"]]
                a, b, c = grid[r["__choice"]]
                at, sigma, spread = r["__last"] - r["__first"], np.sqrt(r["__sse"] / r["__n"]), 1.0
                for h in range(1, horizon + 1):
                    value, margin = x[0] + h * x[1] + x[2 + (at + h) % season], z * sigma * np.sqrt(spread)
                    out.append({
                        "__id": r["__id"], "forecast_step": r["__last"] + h, "forecast_value": value, "interval_lower": value - margin,
                        "interval_upper": value + margin, "backtest_rmse": sigma, "level_weight": a, "trend_weight": b, "season_weight": c,
                    })
                    spread += (a + a * b * h + (c * (1 - a) if h % season == 0 else 0.0)) ** 2
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("__id", batch.schema.field("__id").type), ("forecast_step", pa.int64()), *((n, pa.float64()) for n in NUMBERS)]))

    kind = points.schema["__id"].dataType.simpleString()
    result = ends.select("__id", "__first", "__last", "__final", "__choice", "__sse", "__n").mapInArrow(
        ahead, f"__id {kind}, forecast_step long, " + ", ".join(f"{n} double" for n in NUMBERS))
    return result.select(*([f"__id.{k}" for k in ids] if keys else []), "forecast_step", *NUMBERS, F.lit(confidence_level).alias("confidence_level"))


NUMBERS = ["forecast_value", "interval_lower", "interval_upper", "backtest_rmse", "level_weight", "trend_weight", "season_weight"]


def seasonal_forecast_by_time(
    df: DataFrame, data_col: str, timestamp_col: str, horizon: str, season: str, confidence_level: float = 0.95, id_cols: Sequence[str] = (), **options
) -> DataFrame:
    """Seasonal forecast over a timestamp column, ``horizon`` and ``season`` being spans such as ``7 DAYS``.

    The most common gap between times is the step of all series; steps are counted from the earliest time of each series. A season
    and a horizon have as many steps as it takes to cover their spans.
    """
    keys = list(id_cols)
    known = df.filter(F.col(timestamp_col).isNotNull() & F.col(data_col).isNotNull())
    gap = infer_granularity(known, timestamp_col, keys).groupBy("gap_seconds").agg(F.sum("gaps").alias("n")).orderBy(F.desc("n"), "gap_seconds")
    zero = "timestamp'1970-01-01 00:00:00'"
    steps = [horizon_steps(F.expr(f"unix_seconds({zero} + INTERVAL {span}) - unix_seconds({zero})"), F.col("gap_seconds")).alias(n) for n, span in (("h", horizon), ("m", season))]
    found = gap.select("gap_seconds", *steps).first()  # one row
    if found is None:
        raise ValueError("no series has two different times")
    first = known.groupBy(*[F.col(k).alias(f"__k_{k}") for k in keys]).agg(F.min(timestamp_col).alias("__begin"))

    def begun(rows: DataFrame) -> DataFrame:
        """Rows with the first time of their series; a null id is an id of its own."""
        if not keys:
            return rows.withColumn("__begin", first.select("__begin").scalar())
        return rows.join(first, reduce(lambda x, y: x & y, (F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys))).drop(*[f"__k_{k}" for k in keys])

    step = F.round(F.timestamp_diff("SECOND", "__begin", timestamp_col) / found["gap_seconds"]).cast("long")
    rows = begun(known.select(*keys, timestamp_col, data_col)).withColumn("__step", step)
    timed = begun(seasonal_forecast(rows, data_col, "__step", found["m"], found["h"], confidence_level, keys, **options))
    at = F.timestamp_add("SECOND", F.col("forecast_step") * found["gap_seconds"], "__begin")
    return timed.select(*keys, at.alias("forecast_timestamp"), *NUMBERS, "confidence_level")
