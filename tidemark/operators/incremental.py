"""Incremental runs on Parquet tables: what to recompute, and how to put it back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import versioned

EPOCH = "1970-01-01 00:00:00"


def watermark(target: DataFrame, column: str, days: int = 0) -> Column:
    """``max(column)`` of the target minus ``days``, as a scalar subquery; the epoch for an empty target."""
    newest = F.coalesce(F.max(F.col(column).cast("timestamp")), F.lit(EPOCH).cast("timestamp"))
    return target.agg((newest - F.expr(f"INTERVAL {int(days)} DAYS")).alias("from_at")).scalar()


def number_watermark(target: DataFrame, column: str) -> Column:
    return target.agg(F.coalesce(F.max(column), F.lit(0)).alias("from_value")).scalar()


def since(source: DataFrame, column: str, target: DataFrame, target_column: str, days: int = 0) -> DataFrame:
    """Rows changed since the target's newest row, looking back ``days``."""
    return source.where(F.col(column) >= watermark(target, target_column, days))


def impacted_keys(*sides: DataFrame) -> DataFrame:
    """Distinct keys changed on any side."""
    return reduce(lambda a, b: a.union(b), sides).distinct()


def impacted_orders(orders: DataFrame, order_items: DataFrame, target: DataFrame) -> DataFrame:
    """Orders touched since the last run: a changed header, or an item of the last day and later."""
    headers = orders.where(F.col("cdc_timestamp") >= number_watermark(target, "cdc_timestamp")).select("order_id")
    items = since(order_items, "created_at", target, "created_at", days=1).select("order_id")
    return impacted_keys(headers, items)


def impacted_users(users: DataFrame, orders: DataFrame, target: DataFrame, days: int = 3) -> DataFrame:
    """Users whose profile or orders changed since the last run; never the unknown member's own row."""
    profiles = since(users.where("user_id <> -1"), "source_updated_at", target, "source_updated_at", days)
    buyers = since(orders, "source_updated_at", target, "source_updated_at", days)
    return impacted_keys(profiles.select("user_id"), buyers.select("user_id"))


def merged(target: DataFrame, delta: DataFrame, *keys: str) -> DataFrame:
    """Upsert as a frame: the delta's row wins, other target rows stay."""
    kept = target.join(delta.select(*keys), list(keys), "left_anti")
    return kept.select(*delta.columns).unionByName(delta)


def write_table(
    frame: DataFrame, path: str, day: str | None = None, cluster: tuple[str, ...] = (), grain: str = "day"
) -> None:
    """Replace a table in one step. ``day`` names the date or instant column whose date (or first day of its
    ``grain``) partitions it; rows of a file are sorted by ``cluster`` so that row-group statistics can skip."""
    versioned.write(frame, path, None if day is None else versioned.by_day(day, grain), cluster)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return versioned.read(spark, path)


def upsert_table(
    delta: DataFrame, path: str, keys: tuple[str, ...], day: str, fixed_day: bool = False, grain: str = "day"
) -> int:
    """Merge ``delta`` into the table at ``path`` (written by :func:`write_table` with the same ``day`` and
    ``grain``) in one step; returns the number of days rewritten. Only touched days are: those of the delta and,
    unless a key's day never changes (``fixed_day``), those holding an older row of its keys."""
    return versioned.replace(delta, path, keys, versioned.by_day(day, grain), fixed_place=fixed_day)
