"""Range and list predicates shared by the dashboard queries."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Day = dt.date | str


def _day(value: Day) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def _midnight(value: dt.date) -> Column:
    return F.lit(f"{value.isoformat()} 00:00:00").cast("timestamp")


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def from_date(instant: Column | str, start: Day) -> Column:
    return _column(instant) >= _midnight(_day(start))


def until_date(instant: Column | str, end: Day) -> Column:
    """Up to and including the day ``end``."""
    return _column(instant) < _midnight(_day(end) + dt.timedelta(days=1))


def between_dates(instant: Column | str, start: Day, end: Day) -> Column:
    """Half-open instant range over whole days: both days included, and the bare column stays
    comparable, so the predicate reaches the Parquet reader."""
    return from_date(instant, start) & until_date(instant, end)


def on_dates(date: Column | str, start: Day, end: Day) -> Column:
    return _column(date).between(F.lit(_day(start)), F.lit(_day(end)))


def in_list(column: Column | str, values: Sequence[str] | None) -> Column:
    """Membership test; no values means no restriction."""
    return _column(column).isin(*values) if values else F.lit(True)


def floor_to_bucket(instant: Column, seconds: int) -> Column:
    """Start of the bucket of ``seconds`` that holds ``instant``."""
    micros, size = F.unix_micros(instant), seconds * 1_000_000
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(size)))
