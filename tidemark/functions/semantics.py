"""Number, date and time semantics that differ from Spark's defaults."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_to_long(x: Column) -> Column:
    """Float to integer cast that rounds half away from zero (Spark's own cast truncates)."""
    return F.round(x, 0).cast("long")


def half_even(x: Column, scale: int) -> Column:
    """NUMERIC half-even rounding, returned as double."""
    return F.bround(x.cast("decimal(38,9)"), scale).cast("double")


def week_number(ts: Column) -> Column:
    """Week of year counted from the first Sunday, 0 to 53."""
    return F.floor((F.dayofyear(ts) + 7 - F.dayofweek(ts)) / 7).cast("int")


def sunday_week(ts: Column) -> Column:
    """Date of the Sunday that starts the week of ``ts``."""
    day = ts.cast("date")
    return F.date_sub(day, F.dayofweek(day) - 1)


def whole_units(start: Column, end: Column, unit: str) -> Column:
    """Number of complete ``unit`` steps between two instants."""
    return F.timestamp_diff(unit, start, end)


def boundaries(start: Column, end: Column, unit: str) -> Column:
    """Number of ``unit`` boundaries crossed between two instants."""
    return F.timestamp_diff(unit, F.date_trunc(unit, start), F.date_trunc(unit, end))


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970 of a zone-less timestamp."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def from_epoch_seconds(sec: Column) -> Column:
    """Inverse of :func:`epoch_seconds`."""
    return F.timestamp_add("SECOND", sec, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")).cast("timestamp_ntz")


def tumble(ts: Column, seconds: int, zone: str = "UTC") -> Column:
    """Start of the fixed bucket of ``seconds`` that holds a UTC instant, in local time of ``zone``."""
    start = from_epoch_seconds(F.floor(epoch_seconds(ts) / seconds).cast("long") * seconds)
    return start if zone == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(zone), start)


def round_up_step(x: Column, step: float) -> Column:
    """Round up to the next multiple of ``step``, on exact decimals."""
    per = F.lit(1 / step).cast("decimal(18,6)")
    return (F.ceil(x.cast("decimal(18,6)") * per) / per).cast("double")
