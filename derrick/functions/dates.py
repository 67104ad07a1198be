"""Calendar helpers on zone-free timestamps."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_day(ts: Column | str) -> Column:
    return F.to_date(_col(ts))


def add_hours(day: Column | str, hours: Column | str) -> Column:
    """Date plus whole hours. The date is widened first: ANSI mode rejects
    adding an hour interval to a date."""
    start = _col(day).cast("timestamp_ntz")
    return start + F.make_dt_interval(hours=_col(hours).cast("int"))


def days_until(day: Column | str, ts: Column | str) -> Column:
    """Whole days from midnight of ``day`` to ``ts``, floored (negative after it)."""
    return F.datediff(F.to_date(_col(ts)), _col(day))


def parse_timestamp(c: Column | str, strict: bool = True) -> Column:
    """Text to timestamp; bad text raises if strict, else gives null."""
    text = _col(c)
    return text.cast("timestamp_ntz") if strict else text.try_cast("timestamp_ntz")


def date_parts(c: Column | str) -> dict[str, Column]:
    """Partition keys ``year``, ``month``, ``day``; the last two zero-padded text."""
    day = F.to_date(_col(c))
    return {
        "year": F.year(day),
        "month": F.date_format(day, "MM"),
        "day": F.date_format(day, "dd"),
    }


def micros(df: DataFrame, c: str) -> Column:
    """Microseconds since 1970 of a date or timestamp column; zone-free ones are counted
    on their own clock, without any zone's changes."""
    kind = df.schema[c].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("long") * F.lit(86_400_000_000)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    since = F.col(c).cast("timestamp_ntz") - F.lit(datetime(1970, 1, 1)).cast("timestamp_ntz")
    parts = {"DAY": 86_400_000_000, "HOUR": 3_600_000_000, "MINUTE": 60_000_000, "SECOND": 1_000_000}
    out = F.lit(0).cast("long")
    for part, size in parts.items():  # seconds come with six decimals
        out = out + (F.extract(F.lit(part), since).cast("decimal(18,6)") * F.lit(size)).cast("long")
    return out
