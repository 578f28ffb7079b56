"""Time expressions that do not depend on the session time zone for NTZ input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def micros(df: DataFrame, name: str) -> Column:
    """Microseconds on the column's own time line, monotone in the column's order."""
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(dtype, T.TimestampNTZType):
        # wall-clock arithmetic, so daylight-saving jumps of the session zone play no part
        days = F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("long")
        minutes = (days * 24 + F.hour(c)) * 60 + F.minute(c)
        seconds = F.extract(F.lit("SECOND"), c)  # decimal(8,6): fraction included
        return minutes * F.lit(60_000_000).cast("long") + (seconds * 1_000_000).cast("long")
    if isinstance(dtype, T.DateType):
        return F.datediff(c, F.lit("1970-01-01").cast("date")).cast("long") * 86_400_000_000
    return c.cast("long")


def to_instant(df: DataFrame, name: str) -> Column:
    """A wall-clock column read as UTC, whatever the session zone."""
    return F.timestamp_micros(micros(df, name))


def to_wall_clock(instant: Column) -> Column:
    """The UTC wall clock of an instant, whatever the session zone."""
    us = F.unix_micros(instant)
    seconds = (us / F.lit(1_000_000).cast("decimal(20,0)")).cast("decimal(18,6)")
    zero = F.lit(0)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(zero, zero, zero, seconds)


def within(time: Column, asof: Column, interval: str) -> Column:
    """Strictly newer than ``asof`` minus the interval."""
    return time > asof - F.expr(f"interval {interval}")


def minutes_between(later: Column, earlier: Column) -> Column:
    """Minutes between two times of the same type: exact microseconds, divided once."""
    gap = later - earlier

    def part(name: str) -> Column:
        return F.extract(F.lit(name), gap)

    minutes = (part("DAY").cast("long") * 24 + part("HOUR")) * 60 + part("MINUTE")
    us = minutes * F.lit(60_000_000).cast("long") + (part("SECOND") * 1_000_000).cast("long")
    return us / F.lit(60_000_000.0)


def month_key(time: Column) -> Column:
    return F.date_format(time, "yyyyMM")
