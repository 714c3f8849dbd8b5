"""Writers and row-level maintenance. Changes are new DataFrames; the caller writes them to a new version."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
    options: dict[str, str] | None = None,
) -> str:
    """Write and return ``path``; partitioned writes gather each partition's rows before writing.

    AQE splits a hot partition value into several tasks, each writing its own file. It does not join small partitions here: the
    cost of a folder is its file, not its bytes, so folders are dealt to as many tasks as the session shuffles to.
    """
    conf, key = df.sparkSession.conf, "spark.sql.adaptive.coalescePartitions.enabled"
    before = conf.get(key)
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
        conf.set(key, "false")
    try:
        writer = df.write.format(fmt).mode(mode).options(**(options or {}))
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.save(path)
    finally:
        conf.set(key, before)
    return path


def copy_table(spark: SparkSession, src: str, dst: str) -> str:
    return write_table(spark.read.parquet(src), dst)


def compact(spark: SparkSession, src: str, dst: str, files: int) -> str:
    """Rewrite many small files as ``files`` larger ones.

    Whole files are dealt out, largest first, and each task reads its share as it is stored, which is less than its rows take in a
    shuffle. Where that leaves the shares uneven, as with few files or a very large one, the rows are dealt out instead.
    """
    table = spark.read.parquet(src)
    names = table.inputFiles()
    if files > 1 and len(names) >= files:
        listed = spark.read.format("binaryFile").load(names).select("path", "length").collect()  # names and sizes of files
        shares = [[0, i, []] for i in range(files)]
        for path, length in sorted(map(tuple, listed), key=lambda x: (-x[1], x[0])):
            least = min(shares)
            least[0] += length
            least[2].append(path)
        if 4 * files * max(s[0] for s in shares) <= 5 * sum(s[0] for s in shares):
            reader = spark.read.schema(table.schema).option("basePath", src)
            key = "spark.sql.unionOutputPartitioning"
            before = spark.conf.get(key, "true")
            spark.conf.set(key, "false")  # one partition a share, not one for all
            try:
                return write_table(reduce(DataFrame.unionByName, [reader.parquet(*paths).coalesce(1) for _, _, paths in shares]), dst)
            finally:
                spark.conf.set(key, before)
    return write_table(table.repartition(files), dst)


SAMPLE_ROWS = 20_000


def range_rank(col: Column, bounds: list) -> Column:
    """Number of the ascending ``bounds`` that lie below the value; 0 for a missing one."""
    if not bounds:
        return F.lit(0).cast("long")
    below = F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b < col)
    return F.when(col.isNull(), 0).otherwise(F.size(below)).cast("long")


def curve(ranks: list[Column], bits: int) -> Column:
    """Place on the Z-order curve: the bits of the ranks, interleaved."""
    place = F.lit(0).cast("long")
    for bit in range(bits):
        for j, rank in enumerate(ranks):
            place = place.bitwiseOR(F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1)), bit * len(ranks) + j))
    return place


def write_clustered(
    df: DataFrame, path: str, cols: list[str], files: int | None = None, bits: int = 6, options: dict[str, str] | None = None
) -> str:
    """Write in ranges of a space-filling curve over ``cols``, so that statistics skip files and row groups for a filter on any of them.

    Each column is ranked against quantiles of at most ``SAMPLE_ROWS`` sampled rows (``2 ** bits`` ranges); only the layout rests
    on the sample. Without a file count AQE sizes the ranges by the data. Equal rows of a frequent value spread over files.
    """
    if bits * len(cols) > 62:
        raise ValueError("the bits of all columns have to fit in 62")
    sample = df.select(*cols).orderBy(F.rand(42)).limit(SAMPLE_ROWS).toPandas()
    ranks = []
    for c in cols:
        values = sorted(sample[c].dropna().tolist())
        cuts = [values[len(values) * k // (1 << bits)] for k in range(1, 1 << bits)] if values else []
        few = sorted(set(cuts))
        rank = range_rank(F.col(c), [F.lit(v).cast(df.schema[c].dataType) for v in few])
        ranks.append(F.shiftleft(rank, bits - len(few).bit_length()))  # few values, too, begin at the highest bit
    plain = [f.name for f in df.schema.fields if f.dataType.simpleString() not in ("variant", "void") and "map<" not in f.dataType.simpleString()]
    placed = df.withColumns({"__place": curve(ranks, bits), "__spread": F.xxhash64(*[F.col(c) for c in plain])})
    order = ["__place", *cols, "__spread"]
    ranged = placed.repartitionByRange(files, *order) if files else placed.repartitionByRange(*order)
    return write_table(ranged.sortWithinPartitions(*order).drop("__place", "__spread"), path, options=options)


def file_bounds(df: DataFrame, cols: list[str]) -> DataFrame:
    """Least and greatest value of each column in each file of a table: what a scan can skip by."""
    bounds = [f(c).alias(f"{name}_{c}") for c in cols for name, f in (("min", F.min), ("max", F.max))]
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("rows"), *bounds)


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows left after a DELETE; a NULL condition keeps the row."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def update_where(df: DataFrame, condition: Column, assigns: dict[str, Column]) -> DataFrame:
    hit = F.coalesce(condition, F.lit(False))
    return df.withColumns({c: F.when(hit, v.cast(dict(df.dtypes)[c])).otherwise(F.col(c)) for c, v in assigns.items()})


def update_from(df: DataFrame, src: DataFrame, key: str, assigns: dict[str, str]) -> DataFrame:
    """UPDATE ... FROM: set ``column`` to the source's column where the key matches.

    A source with two rows for one key makes the update ambiguous, and the job fails on it.
    """
    single = F.when(F.count("*") > 1, F.raise_error(F.lit("more than one source row for a key")).cast("long"))
    picked = src.groupBy(F.col(key).alias("__k")).agg(
        single.alias("__dup"), *[F.first(v).alias(f"__v_{c}") for c, v in assigns.items()]
    )
    joined = df.join(picked, F.col(key) == F.col("__k"), "left")
    # reading __dup keeps the check from being pruned
    hit = F.col("__k").isNotNull() & F.col("__dup").isNull()
    return joined.select(*[
        F.when(hit, F.col(f"__v_{c}")).otherwise(F.col(c)).alias(c) if c in assigns else F.col(c) for c in df.columns
    ])


def add_columns(df: DataFrame, cols: dict[str, str]) -> DataFrame:
    """Add NULL columns that are not there yet."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in cols.items() if c not in df.columns})
