"""Table discovery: what lies under a folder, and with which columns, from footers and samples that tasks read.

Each file is looked at by itself, by whichever task has it: the footer of a parquet file, or the first ``SAMPLE_BYTES`` of a text. What
they say is merged by an aggregate over a small order of types, so neither the driver nor any task sees more than names and types.
Files are opened with ``pyarrow.fs``.
"""

from __future__ import annotations

import csv
import datetime as dt
import json
import re
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import from_arrow_type

from tidemark.sources.readers import list_objects

SAMPLE_BYTES = 1 << 16
# Text types from narrow to wide in their chain; types of different chains meet in string.
NUMBERS, TIMES = ["int", "bigint", "double"], ["date", "timestamp"]
READ = ("parquet", "csv", "json", "txt")


def type_of_text(value: str) -> str | None:
    """The narrowest type that holds a text; none for an empty one."""
    if value == "":
        return None
    if re.fullmatch(r"[+-]?\d+", value):
        n = int(value)
        return "int" if -(1 << 31) <= n < 1 << 31 else "bigint" if -(1 << 63) <= n < 1 << 63 else "double"
    if re.fullmatch(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?", value):
        return "double"
    if value.lower() in ("true", "false"):
        return "boolean"
    for kind, read in (("date", dt.date.fromisoformat), ("timestamp", dt.datetime.fromisoformat)):
        if re.match(r"\d{4}-\d{2}-\d{2}", value):
            try:
                read(value)
                return kind
            except ValueError:
                pass
    return "string"


def type_of_json(value) -> str | None:
    """The type of a JSON value; none for null."""
    if value is None:
        return None
    if isinstance(value, bool):
        return "boolean"
    if isinstance(value, int):
        return "bigint" if -(1 << 63) <= value < 1 << 63 else "double"
    return "double" if isinstance(value, float) else "string" if isinstance(value, str) else "array" if isinstance(value, list) else "struct"


def wider(types: Iterable[str | None]) -> str | None:
    """The narrowest type that holds all of them."""
    known = set(types) - {None}
    for chain in (NUMBERS, TIMES):
        if known and known <= set(chain):
            return max(known, key=chain.index)
    return known.pop() if len(known) == 1 else "string" if known else None


def _columns(path: str, fmt: str, store: pyarrow.fs.FileSystem) -> list[tuple[str, str | None]]:
    """Names and types of one file; an unreadable file has none."""
    if fmt == "txt":
        return [("value", "string")]
    if fmt == "parquet":
        with store.open_input_file(path) as f:
            return [(c.name, from_arrow_type(c.type, prefer_timestamp_ntz=True).simpleString()) for c in pq.ParquetFile(f).schema_arrow]
    with store.open_input_stream(path) as f:  # compressed files are opened by their suffix
        head = f.read(SAMPLE_BYTES).decode("utf-8", "replace")
    lines = head.split("\n")[:-1] if len(head) >= SAMPLE_BYTES // 2 and "\n" in head else head.split("\n")  # the last line may be cut
    if fmt == "json":
        seen: dict[str, list] = {}
        for line in filter(str.strip, lines):
            try:
                row = json.loads(line)
            except ValueError:
                continue
            for name, value in row.items() if isinstance(row, dict) else ():
                seen.setdefault(name, []).append(type_of_json(value))
        return [(name, wider(types)) for name, types in seen.items()]
    rows = list(csv.reader(lines))
    names = rows[0] if rows else []
    return [(name, wider(type_of_text(r[k]) for r in rows[1:] if k < len(r))) for k, name in enumerate(names)]


def _looked_at(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        out = []
        for file in pdf.itertuples():
            store, path = pyarrow.fs.FileSystem.from_uri(file.uri)
            keys = re.findall(r"/([^/=]+)=([^/]*)(?=/)", file.uri[len(file.location):])
            try:
                found = _columns(path, file.format, store)
            except (OSError, ValueError):  # neither format nor store allows a look; the file counts without columns
                found = []
            parts = [(k, type_of_text(v) if v != "__HIVE_DEFAULT_PARTITION__" else None) for k, v in keys]
            out += [(file.location, file.format, file.uri, k, name, kind, False) for k, (name, kind) in enumerate(found)]
            out += [(file.location, file.format, file.uri, k, name, kind, True) for k, (name, kind) in enumerate(parts)]
        yield pd.DataFrame(out, columns=["location", "format", "uri", "at", "column_name", "kind", "is_key"])


def merged_type(kinds: Column) -> Column:
    """What :func:`wider` says of an array of distinct types, as a column."""
    def chain(names: list[str]) -> Column:
        inside = F.size(F.array_except(kinds, F.array(*map(F.lit, names)))) == 0
        widest = F.element_at(F.filter(F.array(*[F.lit(n) for n in names]), lambda n: F.array_contains(kinds, n)), -1)
        return F.when(inside, widest)

    return F.when(F.size(kinds) == 0, "string").when(F.size(kinds) == 1, kinds[0]).otherwise(F.coalesce(chain(NUMBERS), chain(TIMES), F.lit("string")))


def discover_columns(spark: SparkSession, root: str) -> DataFrame:
    """Columns of every table under ``root``: ``location, format, ordinal, column_name, data_type, is_key, files``.

    A table is a folder above its ``key=value`` folders; its keys follow its columns. Columns that only some files have are listed with
    the number of files that have them. A column without a value is a string.
    """
    files = list_objects(spark, root).filter(F.col("format").isin(*READ))
    location = F.regexp_replace(F.regexp_replace("uri", r"/[^/]*$", ""), r"(/[^/=]+=[^/]*)+$", "")
    listed = files.select("uri", "format", location.alias("location")).hint("rebalance")
    seen = listed.mapInPandas(_looked_at, "location string, format string, uri string, at int, column_name string, kind string, is_key boolean")
    columns = seen.groupBy("location", "format", "is_key", "column_name").agg(
        merged_type(F.collect_set("kind")).alias("data_type"), F.min("at").alias("at"), F.count_distinct("uri").alias("files"))
    every = F.array_sort(F.collect_list(F.struct("is_key", "at", "column_name", "data_type", "files")))  # the columns of one table
    tables = columns.groupBy("location", "format").agg(every.alias("c"))
    return tables.select("location", "format", F.posexplode("c").alias("k", "c")).select(
        "location", "format", (F.col("k") + 1).alias("ordinal"), "c.column_name", "c.data_type", "c.is_key", "c.files")
