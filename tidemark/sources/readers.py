"""Readers: files, remote queries, logs of live files, object listings and catalogs."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: StructType | str | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Scan files; a given schema also types the hive partition columns it names."""
    reader = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.load(path)
    except AnalysisException as e:
        if fmt == "avro":
            raise RuntimeError("reading avro needs the public spark-avro package on the session's classpath") from e
        raise


def read_json_lines_as_text(spark: SparkSession, path: str, fields: dict[str, str]) -> DataFrame:
    """One JSON document per line, kept as ``json`` and read once into typed columns.

    ``fields`` maps a column to ``"<json path> <type>"``.
    """
    lines = spark.read.text(path).withColumnRenamed("value", "json")
    parsed = lines.withColumn("__v", F.try_parse_json("json"))
    picked = [F.try_variant_get("__v", *spec.split(" ", 1)).alias(name) for name, spec in fields.items()]
    return parsed.select("json", *picked)


def union_files(spark: SparkSession, paths: list[str], casts: dict[str, str], order: list[str]) -> DataFrame:
    """Read files whose schemas drifted apart, cast each to the common types, and stack them.

    A column a file lacks is NULL for its rows.
    """

    def one(path: str) -> DataFrame:
        df = spark.read.option("mergeSchema", "true").parquet(path)
        return df.select(*[
            (F.col(c) if c in df.columns else F.lit(None)).cast(casts[c]).alias(c) for c in order
        ])

    return reduce(DataFrame.unionByName, (one(p) for p in paths))


def read_remote_query(spark: SparkSession, url: str, query: str, props: dict[str, str] | None = None) -> DataFrame:
    """Push ``query`` into an external database; only its result crosses the wire."""
    return spark.read.format("jdbc").option("url", url).option("query", query).options(**(props or {})).load()


def read_live_files(
    spark: SparkSession, root: str, manifest: DataFrame, rewrite: tuple[str, str] | None = None, fmt: str = "parquet", schema: StructType | str | None = None
) -> DataFrame:
    """Rows of the files in the manifest's ``path`` column; no other file of the table is opened.

    ``rewrite`` replaces a scheme or prefix in the manifest, e.g. when it was written elsewhere. The driver sees the names of the live
    files, as it does of every file of a scan. Partition columns below ``root`` are kept; without any live file there are no rows.
    """
    path = F.col("path")
    if rewrite:
        path = F.replace(path, F.lit(rewrite[0]), F.lit(rewrite[1]))
    live = [x["path"] for x in manifest.select(path.alias("path")).filter("path IS NOT NULL").distinct().collect()]
    reader = spark.read.format(fmt).option("basePath", root)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(live) if live else reader.load(root).limit(0)


# Media types by file suffix.
CONTENT_TYPES = {
    "parquet": "application/vnd.apache.parquet", "json": "application/json", "csv": "text/csv", "txt": "text/plain", "html": "text/html",
    "pdf": "application/pdf", "jpg": "image/jpeg", "jpeg": "image/jpeg", "png": "image/png", "avro": "application/avro", "orc": "application/orc",
}


def list_objects(spark: SparkSession, glob: str, recursive: bool = True) -> DataFrame:
    """One row per file: uri, size, format, content type, metadata and update time. File bodies are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(glob)
    suffix = F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1)
    return files.select(
        F.col("path").alias("uri"),
        F.col("length").alias("size"),
        F.lower(suffix).alias("format"),
        F.coalesce(F.create_map(*[F.lit(x) for pair in CONTENT_TYPES.items() for x in pair])[F.lower(suffix)], F.lit("application/octet-stream")).alias("content_type"),
        F.array(
            F.struct(F.lit("name").alias("name"), F.regexp_extract("path", r"([^/]*)$", 1).alias("value")),
            F.struct(F.lit("folder").alias("name"), F.regexp_extract("path", r"([^/]*)/[^/]*$", 1).alias("value")),
        ).alias("metadata"),
        F.col("modificationTime").alias("updated"),
    )


def discover_tables(spark: SparkSession, root: str) -> DataFrame:
    """Group the files under ``root`` by folder: format, file count, bytes and partition keys."""
    files = list_objects(spark, root)
    folder = F.regexp_replace("uri", r"/[^/]*$", "")
    table = F.regexp_replace(folder, r"(/[^/=]+=[^/]*)+$", "")
    keys = F.array_join(F.transform(F.regexp_extract_all(folder, F.lit(r"/([^/=]+)=[^/]*"), F.lit(1)), lambda k: k), ",")
    return (
        files.filter("format IN ('parquet', 'csv', 'json', 'avro', 'orc', 'txt')")
        .groupBy(table.alias("location"), "format", keys.alias("partition_keys"))
        .agg(F.count("*").alias("files"), F.sum("size").alias("bytes"))
    )


def read_period(df: DataFrame, ts: str, year: int, month: int | None = None) -> DataFrame:
    """Rows of one year or month, as a range predicate that reaches the scan."""
    lo = f"{year}-{month or 1:02d}-01"
    hi = f"{year + 1}-01-01" if month in (None, 12) else f"{year}-{month + 1:02d}-01"
    kind = dict(df.dtypes)[ts]
    return df.filter((F.col(ts) >= F.lit(lo).cast(kind)) & (F.col(ts) < F.lit(hi).cast(kind)))


def inline_rows(spark: SparkSession, rows: list[tuple], schema: StructType | str) -> DataFrame:
    """A relation of literals."""
    return spark.createDataFrame(rows, schema)


def sequence_df(spark: SparkSession, lo: int, hi: int, name: str = "element") -> DataFrame:
    """Integers ``lo`` to ``hi``, both included."""
    return spark.range(lo, hi + 1).withColumnRenamed("id", name)


def sample_rows(df: DataFrame, pct: float, key: str | None = None, seed: int = 42) -> DataFrame:
    """About ``pct`` percent of rows; with a key the same rows are taken every time."""
    if key is None:
        return df.sample(fraction=pct / 100, seed=seed)
    return df.filter(F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(10000)) < F.lit(int(pct * 100)))


def column_catalog(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Schema of several tables as data."""
    rows = [
        (name, f.name, i + 1, f.dataType.simpleString())
        for name, df in tables.items()
        for i, f in enumerate(df.schema.fields)
    ]
    return inline_rows(spark, rows, "table_name string, column_name string, ordinal_position int, data_type string")


def latest_by(df: DataFrame, keys: list[str], order_by: list[Column]) -> DataFrame:
    """First row per key in ``order_by`` order; the rank filter prunes inside each task before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")
