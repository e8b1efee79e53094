"""Inventory queries. ``as_of`` is the instant ages are measured at."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import band, between_dates, from_date, safe_divide, until_date, whole_days
from tidemark.operators.shape import top

# Upper edges of the age bands in days.
AGE_BANDS = ((30, "0-29 days"), (60, "30-59 days"), (90, "60-89 days"), (180, "90-179 days"))
OLDEST_BAND = "180+ days"
SLOW = "Slow-Moving"


def _in_stock(inventory: DataFrame, start, end) -> DataFrame:
    """Items that were in stock at some time of the range."""
    unsold_before = F.col("sold_at").isNull() | from_date("sold_at", start)
    return inventory.where(until_date("created_at", end) & unsold_before)


def _age(as_of: Column) -> Column:
    waiting = whole_days(F.col("created_at"), as_of)
    return F.when(F.col("is_sold"), F.col("days_in_inventory")).otherwise(waiting)


def _open_cost() -> Column:
    return F.coalesce(F.sum(F.when(~F.col("is_sold"), F.col("cost")).otherwise(F.lit(0))), F.lit(0))


def inventory_status(inventory, start, end, as_of: Column) -> DataFrame:
    return (
        _in_stock(inventory, start, end)
        .groupBy(F.col("inventory_status").alias("status"))
        .agg(
            F.count("*").alias("item_count"),
            F.coalesce(F.sum("cost"), F.lit(0)).alias("inventory_cost"),
            F.avg(_age(as_of)).alias("avg_days_in_inv"),
        )
    )


def inventory_kpis(inventory, start, end, as_of: Column) -> DataFrame:
    sold = F.col("is_sold")
    waiting = F.when(~sold, whole_days(F.col("created_at"), as_of))
    return _in_stock(inventory, start, end).agg(
        F.count("*").alias("inventory_items"),
        F.count_if(~sold).alias("available_items"),
        F.count_if(F.col("inventory_status") == SLOW).alias("slow_moving_items"),
        F.count_if(sold).alias("sold_items"),
        _open_cost().alias("available_cost"),
        F.coalesce(F.avg(waiting), F.lit(0.0)).alias("avg_available_age_days"),
        F.coalesce(F.avg("days_in_inventory"), F.lit(0.0)).alias("avg_sold_days_in_inventory"),
        F.coalesce(safe_divide(F.count_if(sold), F.count("*")), F.lit(0.0)).alias("sell_through_rate"),
    )


def inventory_age_buckets(inventory, start, end, as_of: Column) -> DataFrame:
    label, rank = band(_age(as_of), AGE_BANDS, OLDEST_BAND)
    return (
        _in_stock(inventory, start, end)
        .groupBy(label.alias("age_bucket"), rank.alias("bucket_order"))
        .agg(F.count("*").alias("item_count"), F.coalesce(F.sum("cost"), F.lit(0)).alias("inventory_cost"))
        .orderBy("bucket_order")
    )


def _counts_by(inventory: DataFrame, start, end, key: str) -> DataFrame:
    return (
        _in_stock(inventory, start, end)
        .groupBy(key)
        .agg(
            F.count("*").alias("item_count"),
            F.count_if(~F.col("is_sold")).alias("available_items"),
            F.count_if(F.col("inventory_status") == SLOW).alias("slow_moving_items"),
            _open_cost().alias("available_cost"),
        )
    )


def _by_labels(counted: DataFrame, dimension: DataFrame, key: str, labels: tuple[str, ...]) -> DataFrame:
    """Counts per dimension key rolled up to the dimension's labels; unknown keys share the null label."""
    measures = ("item_count", "available_items", "slow_moving_items", "available_cost")
    return (
        counted.join(dimension.select(key, *labels), key, "left")
        .groupBy(*labels)
        .agg(*[F.sum(m).alias(m) for m in measures])
    )


def inventory_by_dc(inventory, centers, start, end) -> DataFrame:
    labels = ("distribution_center_name", "latitude", "longitude")
    counted = _counts_by(inventory, start, end, "distribution_center_id")
    grouped = _by_labels(counted, centers, "distribution_center_id", labels)
    return grouped.orderBy(F.col("item_count").desc(), *labels)


def inventory_by_segment(inventory, products, start, end, limit: int = 20) -> DataFrame:
    labels = ("category", "department")
    grouped = _by_labels(_counts_by(inventory, start, end, "product_id"), products, "product_id", labels)
    return top(grouped, limit, F.col("available_items").desc(), *labels)


def inventory_flow(inventory, start, end) -> DataFrame:
    """Items entering and leaving stock per day."""

    def per_day(column: str, name: str) -> DataFrame:
        return (
            inventory.where(between_dates(column, start, end))
            .groupBy(F.to_date(column).alias("date"))
            .agg(F.count("*").alias(name))
        )

    joined = per_day("created_at", "created_items").join(per_day("sold_at", "sold_items"), "date", "full")
    zero = F.lit(0)
    return joined.select(
        "date", *[F.coalesce(F.col(c), zero).alias(c) for c in ("created_items", "sold_items")]
    ).orderBy("date")
