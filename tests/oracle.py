"""Compare a query with its SQL on the same tables: columns, types, row count and values."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _cell(v):
    if v is None:
        return "null"
    if isinstance(v, bool):
        return f"b:{v}"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"f:{v:.9g}" if v else "f:0"
    if isinstance(v, decimal.Decimal):
        return f"d:{v.normalize():f}"
    if isinstance(v, dt.datetime):
        return "t:" + v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_cell(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}={_cell(x)}" for k, x in v.items()) + "}"
    return f"{type(v).__name__}:{v}"


def _rows(table):
    names = sorted(table.schema.names)
    cols = [table.column(n).to_pylist() for n in names]
    return sorted("|".join(_cell(v) for v in row) for row in zip(*cols))


def _types(table):
    def simple(t):
        s = str(t).replace("large_string", "string").replace("large_list", "list")
        return "timestamp" if s.startswith("timestamp") else s.replace("element", "item").replace("child", "item").replace("l: ", "item: ").replace(" not null", "")

    return {f.name: simple(f.type) for f in table.schema}


def compare(df, con, sql: str) -> list[str]:
    """Problems found, empty if both sides agree."""
    got = df.toArrow()
    want = con.sql(sql).to_arrow_table()
    out = []
    a, b = _types(got), _types(want)
    if a != b:
        out.append(f"types: spark-only {set(a.items()) - set(b.items())} sql-only {set(b.items()) - set(a.items())}")
        if set(a) != set(b):
            return out
    if got.num_rows != want.num_rows:
        out.append(f"rows: spark {got.num_rows} sql {want.num_rows}")
    x, y = _rows(got), _rows(want)
    if x != y:
        sx, sy = set(x) - set(y), set(y) - set(x)
        out.append(f"values: {len(sx)} differ, spark {sorted(sx)[:3]} sql {sorted(sy)[:3]}")
    if got.num_rows == 0:
        out.append("empty result")
    return out
