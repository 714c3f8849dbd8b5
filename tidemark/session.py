"""Session helpers: table access and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"
_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: str = "8", app: str = "tidemark") -> SparkSession:
    """Session for tests and the benchmark; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def prepare(spark: SparkSession) -> SparkSession:
    """Runtime settings the operators count on: joins split hot keys even where the aggregate after
    them would reuse their partitioning and keep such a key in one task."""
    for key in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled", "spark.sql.adaptive.forceOptimizeSkewedJoin"):
        spark.conf.set(key, "true")
    return spark


class Tables:
    """Attribute access to the parquet tables of one folder: ``Tables(spark, d).orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder, self._read = spark, folder.rstrip("/"), {}

    def path(self, name: str) -> str:
        return f"{self._folder}/{name}.parquet"

    def stream_path(self, name: str) -> str:
        """The same path as a pattern: a stream source takes a folder or a pattern, not one file."""
        return f"{self._folder}/{name}.parque[t]"

    def __getattr__(self, name: str) -> DataFrame:
        # one file listing per table and query
        if name not in self._read:
            self._read[name] = self._spark.read.parquet(self.path(name))
        return self._read[name]


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for tables and checkpoints the jobs write.

    A cluster names it in ``spark.checkpoint.dir``. Only a local-mode session, as in tests, gets
    a temporary folder of its own: executors of a cluster could not read it back.
    """
    root = spark.conf.get(_CHECKPOINT_DIR, None)
    if not root:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise RuntimeError(f"set {_CHECKPOINT_DIR} to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set(_CHECKPOINT_DIR, root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


_written: list[str] = []


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back, which cuts lineage and survives lost executors.

    Shuffle files of the write go when it ends: else they stay until the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path, before = scratch_path(spark, label), spark.conf.get(_SHUFFLE_CLEANUP, None)
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_SHUFFLE_CLEANUP)
        else:
            spark.conf.set(_SHUFFLE_CLEANUP, before)
    _written.append(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def drop_tables(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch tables that nothing reads any more."""
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def drop_materialized(*tables: DataFrame) -> None:
    """Delete what ``materialize`` wrote for these tables; they, and all that reads them, are of no use afterwards."""
    for df in tables:
        drop_tables(df.sparkSession, [df._scratch])


def written_tables() -> list[str]:
    """Paths of all tables this process has materialized, in order."""
    return list(_written)
