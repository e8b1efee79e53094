"""Mixed-unit timestamps, date keys and whole-unit differences. Session time zone must be UTC."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DIGITS = r"^[0-9]+$"


def as_instant(frame: DataFrame, name: str) -> Column:
    """Column ``name`` as an instant; typed columns skip the text route of :func:`to_instant`."""
    kind = frame.schema[name].dataType
    if isinstance(kind, T.TimestampType):
        return F.col(name)
    if isinstance(kind, (T.TimestampNTZType, T.DateType)):
        return F.col(name).cast("timestamp")
    return to_instant(F.col(name))


def to_instant(value: Column) -> Column:
    """All-digit text is epoch time whose unit follows from its length (16+ micros, 13+ millis, else
    seconds); anything else is parsed as a timestamp, null when that fails."""
    text = value.cast("string")
    number = text.try_cast("bigint")
    return F.when(
        text.rlike(_DIGITS),
        F.when(F.length(text) >= 16, F.timestamp_micros(number))
        .when(F.length(text) >= 13, F.timestamp_millis(number))
        .otherwise(F.timestamp_seconds(number)),
    ).otherwise(text.try_cast("timestamp"))


def cdc_millis(frame: DataFrame, name: str = "cdc_timestamp") -> Column:
    """Change time in epoch milliseconds: integers as they are, other values through a timestamp."""
    kind = frame.schema[name].dataType
    if isinstance(kind, T.IntegralType):
        return F.when(F.col(name) >= 0, F.col(name).cast("bigint"))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_millis(F.col(name).cast("timestamp"))
    text = F.col(name).cast("string")
    return F.when(text.rlike(_DIGITS), text.try_cast("bigint")).otherwise(F.unix_millis(text.try_cast("timestamp")))


def date_key(instant: Column) -> Column:
    """yyyymmdd as a number, by arithmetic rather than text formatting."""
    day = instant.cast("date")
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("bigint")


def whole_days(start: Column, end: Column) -> Column:
    return F.timestamp_diff("DAY", start, end)


def whole_seconds(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end)


def parse_iso(text: Column) -> Column:
    """ISO-8601 text, ``Z`` or offset honoured, no zone means UTC; null when malformed."""
    return text.try_cast("timestamp")


def iso_text(instant: Column) -> Column:
    """ISO-8601 with a +00:00 offset; fractional seconds only when there are any."""
    fraction = F.unix_micros(instant) % 1000000
    return F.concat(
        F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(fraction != 0, F.date_format(instant, ".SSSSSS")).otherwise(F.lit("")),
        F.lit("+00:00"),
    )
