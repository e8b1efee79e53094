"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Id of the unknown dimension member and the text standing for null in a key.
UNKNOWN_ID = -1
NULL_TEXT = "__null__"


def surrogate_key(*columns: Column | str) -> Column:
    """Hex md5 over ``c0:<value>||c1:<value>…``; nulls count as their own value."""
    pieces: list[Column] = []
    for position, column in enumerate(columns):
        value = F.col(column) if isinstance(column, str) else column
        tag = f"c{position}:" if position == 0 else f"||c{position}:"
        pieces += [F.lit(tag), F.coalesce(value.cast("string"), F.lit(NULL_TEXT))]
    return F.md5(F.concat(*pieces))


def unknown_key() -> Column:
    return surrogate_key(F.lit(UNKNOWN_ID))
