"""Arithmetic and evaluation helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Ratio as a double; null when the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def band(value: Column, edges: Sequence[tuple[float, str]], last: str) -> tuple[Column, Column]:
    """Label and 1-based rank of the first upper edge above ``value`` (nulls fall in the last band)."""
    label, rank = None, None
    for position, (edge, text) in enumerate(edges, start=1):
        below = value < F.lit(edge)
        label = F.when(below, text) if label is None else label.when(below, text)
        rank = F.when(below, F.lit(position)) if rank is None else rank.when(below, F.lit(position))
    return label.otherwise(last), rank.otherwise(F.lit(len(edges) + 1))


def once(value: Column) -> Column:
    """The same value, computed once per row. Catalyst copies an expression into every filter it pushes
    below a projection, which for JSON parsing means parsing again per reference; it does not push
    through a generator."""
    return F.explode(F.array(value))
