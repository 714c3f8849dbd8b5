"""A bitmap of fixed size over hashed values: says which rows cannot matter before they are moved."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BITS, SLICES = 1 << 23, 64  # one megabyte, whatever the number of values


def bitmap(values: DataFrame, column: str) -> np.ndarray:
    """Packed bits of all values of a long column; filled in slices, so that no task holds more than one."""

    def fill(table: pa.Table) -> pa.Table:
        bits = np.zeros(BITS // SLICES, bool)
        bits[table.column("bit").to_numpy() % (BITS // SLICES)] = True
        return pa.table({"slice": table.column("slice")[:1], "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})

    bit = values.select(F.pmod(column, F.lit(BITS)).alias("bit")).distinct()
    cut = bit.withColumn("slice", F.expr(f"CAST(bit div {BITS // SLICES} AS INT)"))
    out = np.zeros((SLICES, BITS // SLICES // 8), np.uint8)
    for r in cut.groupBy("slice").applyInArrow(fill, "slice int, bits binary").collect():
        out[r["slice"]] = np.frombuffer(r["bits"], np.uint8)
    return out.ravel()


def may_hold(packed: np.ndarray, values: np.ndarray) -> np.ndarray:
    """False where a signed 64-bit value is certainly not among those of the bitmap."""
    at = values % BITS
    return packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1 == 1


def in_bitmap(spark: SparkSession, packed: np.ndarray, column: str) -> Column:
    """``may_hold`` of a long column without nulls; the rest of the row stays in the JVM."""
    bits = spark.sparkContext.broadcast(packed)
    return F.arrow_udf(lambda values: pa.array(may_hold(bits.value, values.to_numpy())), "boolean")(column)
