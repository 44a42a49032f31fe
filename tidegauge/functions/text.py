"""Column functions for the text formats of observations and metadata."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fields(line: Column, separator: str = ",") -> Column:
    """Split where trailing empty fields don't count: `a,b,` has two."""
    trimmed = F.regexp_replace(line, f"({separator})+$", "")
    return F.split(trimmed, separator)


def field(parts: Column, position: int) -> Column:
    """By position from 0; null where there is none."""
    return F.try_element_at(parts, F.lit(position + 1))


def as_long(text: Column) -> Column:
    """A plain integer, else null; blanks around it don't pass."""
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("long"))


def as_double(text: Column) -> Column:
    """A number, else null."""
    return F.when(~text.rlike(r"^\s|\s$"), text.try_cast("double"))


def utc(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def hour_key(ms: Column) -> Column:
    """The nearest hour: up to half past it is the one begun."""
    at = utc(ms)
    return F.date_format(F.when(F.minute(at) <= 30, at).otherwise(at + F.expr("INTERVAL 1 HOUR")), "yyyy-MM-dd'T'HH")


def day_key(ms: Column) -> Column:
    return F.date_format(utc(ms), "yyyy-MM-dd")


def month_key(ms: Column) -> Column:
    return F.date_format(utc(ms), "yyyy-MM")


def time_key(resolution: Column, ms: Column) -> Column:
    """The key under which a test keeps its bounds for an instant; null for an unknown resolution."""
    return F.when(resolution == "single", F.lit("")).when(resolution == "hour", hour_key(ms)).when(resolution == "day", day_key(ms)).when(resolution == "month", month_key(ms))
