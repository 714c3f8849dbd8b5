"""Table functions for SQL: rows in, rows out, with a schema that follows from the arguments.

``register`` makes them callable: ``SELECT * FROM top_rows(TABLE(t) PARTITION BY k ORDER BY x DESC, 5)``. A partition is worked on
by one task, row by row, and holds a few numbers, never its rows. Where one key may hold much of a table, call ``top_rows`` twice:
first per key and a spread of its rows, then per key on what is left.
"""

from __future__ import annotations

import json
from statistics import NormalDist

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import DoubleType, IntegerType, LongType, NumericType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult


def _table(argument: AnalyzeArgument, function: str) -> StructType:
    if not argument.isTable:
        raise ValueError(f"{function} takes a table first")
    return argument.dataType


def _constant(argument: AnalyzeArgument, what: str):
    if not argument.isConstantExpression or argument.value is None:
        raise ValueError(f"{what} has to be a constant")
    return argument.value


def _with(schema: StructType, fields: dict) -> AnalyzeResult:
    taken = sorted(set(schema.names) & set(fields))
    if taken:
        raise ValueError(f"the table has a column of the name {', '.join(taken)} already")
    out = StructType(list(schema.fields))
    for name, kind in fields.items():
        out.add(name, kind)
    return AnalyzeResult(schema=out)


def _number(schema: StructType, column: str) -> str:
    if column not in schema.names or not isinstance(schema[column].dataType, NumericType):
        raise ValueError(f"there is no number column {column}")
    return column


class TopRows:
    """The first ``k`` rows of each partition in the order of the call, with their ``rank``."""

    @staticmethod
    def analyze(rows: AnalyzeArgument, k: AnalyzeArgument) -> AnalyzeResult:
        if int(_constant(k, "the number of rows")) < 1:
            raise ValueError("top_rows gives one row at least")
        return _with(_table(rows, "top_rows"), {"rank": IntegerType()})

    def __init__(self):
        self.seen = 0

    def eval(self, rows, k):
        self.seen += 1
        if self.seen <= k:
            yield (*rows, self.seen)


class PredictLinear:
    """Each row with the ``prediction`` of a linear model: JSON of ``intercept`` and ``weights`` by column.

    A row that lacks one of the numbers has no prediction.
    """

    @staticmethod
    def analyze(rows: AnalyzeArgument, model: AnalyzeArgument) -> AnalyzeResult:
        schema = _table(rows, "predict_linear")
        for column in json.loads(_constant(model, "the model"))["weights"]:
            _number(schema, column)
        return _with(schema, {"prediction": DoubleType()})

    def __init__(self):
        self.model = None

    def eval(self, rows, model):
        if self.model is None:
            read = json.loads(model)
            self.model = float(read["intercept"]), [(c, float(w)) for c, w in read["weights"].items()]
        total, weights = self.model
        for column, weight in weights:
            if rows[column] is None:
                total = None
                break
            total += weight * float(rows[column])
        yield (*rows, total)


class ForecastLinear:
    """For each partition the steps after its last one, on the least-squares line, with a normal prediction interval.

    A partition becomes six sums. One with fewer than two different steps has no forecast, one with fewer than three values no interval.
    """

    @staticmethod
    def analyze(rows: AnalyzeArgument, step: AnalyzeArgument, value: AnalyzeArgument, horizon: AnalyzeArgument, key: AnalyzeArgument) -> AnalyzeResult:
        schema = _table(rows, "forecast_linear")
        for column in (step, value):
            _number(schema, _constant(column, "the column name"))
        if int(_constant(horizon, "the horizon")) < 1:
            raise ValueError("the horizon has one step at least")
        name = _constant(key, "the key column")
        if name not in schema.names:
            raise ValueError(f"there is no column {name}")
        out = StructType([schema[name]])
        return _with(out, {"forecast_step": LongType(), "forecast_value": DoubleType(), "interval_lower": DoubleType(), "interval_upper": DoubleType()})

    def __init__(self):
        self.n, self.mx, self.my, self.sxx, self.sxy, self.syy = 0, 0.0, 0.0, 0.0, 0.0, 0.0
        self.last = self.key = self.horizon = None

    def eval(self, rows, step, value, horizon, key):
        self.key, self.horizon = rows[key], horizon
        x, y = rows[step], rows[value]
        if x is not None and y is not None:
            x, y = float(x), float(y)
            self.n += 1
            dx, dy = x - self.mx, y - self.my
            self.mx += dx / self.n
            self.my += dy / self.n
            self.sxx += dx * (x - self.mx)
            self.sxy += dx * (y - self.my)
            self.syy += dy * (y - self.my)
            self.last = x if self.last is None else max(self.last, x)
        return iter(())

    def terminate(self):
        if self.n > 1 and self.sxx > 0:
            slope = self.sxy / self.sxx
            spread = (max(self.syy - slope * self.sxy, 0.0) / (self.n - 2)) ** 0.5 if self.n > 2 else None
            for h in range(1, self.horizon + 1):
                x = self.last + h
                y = self.my + slope * (x - self.mx)
                off = None if spread is None else NormalDist().inv_cdf(0.975) * spread * (1 + 1 / self.n + (x - self.mx) ** 2 / self.sxx) ** 0.5
                yield (self.key, int(x), y, None if off is None else y - off, None if off is None else y + off)


FUNCTIONS = {"top_rows": TopRows, "predict_linear": PredictLinear, "forecast_linear": ForecastLinear}


def register(spark: SparkSession) -> None:
    """Make the table functions callable from SQL in this session."""
    for name, cls in FUNCTIONS.items():
        spark.udtf.register(name, udtf(cls))
