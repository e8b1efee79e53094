"""Dimension tables. ``as_of`` stands in for the current time and becomes ``dwh_updated_at``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import UNKNOWN_ID, date_key, surrogate_key, unknown_key
from tidemark.operators.shape import latest_by, with_unknown_member
from tidemark.plans.staging import MONEY

# Default calendar.
CALENDAR_START = "2019-01-01"
CALENDAR_END = "2027-12-31"
EPOCH = "1970-01-01"


def _epoch() -> Column:
    return F.lit(f"{EPOCH} 00:00:00").cast("timestamp")


def date_bounds(*instants: tuple[DataFrame, str]) -> DataFrame:
    """One row (start, end) spanning the days of the given columns, for a calendar that follows the data."""
    ends = None
    for frame, column in instants:
        day = F.to_date(column)
        part = frame.agg(F.min(day).alias("start"), F.max(day).alias("end"))
        ends = part if ends is None else ends.unionByName(part)
    return ends.agg(F.min("start").alias("start"), F.max("end").alias("end"))


def fixed_bounds(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    return spark.range(1).select(F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end"))


def dim_date(bounds: DataFrame, as_of: Column) -> DataFrame:
    """One row per day, plus key 0 when the calendar starts after the epoch."""
    day, dow = F.col("full_date"), F.dayofweek("full_date")
    days = bounds.select(F.explode(F.sequence("start", "end")).alias("full_date")).select(
        date_key(day).alias("date_key"),
        day,
        F.dayofmonth(day).alias("day_of_month"),
        dow.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        # Weeks start on Sunday; days before the first Sunday are week 0.
        F.expr("(dayofyear(full_date) + 7 - dayofweek(full_date)) div 7").cast("int").alias("week_of_year"),
        F.weekofyear(day).alias("iso_week_of_year"),
        F.month(day).alias("month_of_year"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter_of_year"),
        F.year(day).alias("year_number"),
        F.extract(F.lit("YEAROFWEEK"), day).alias("iso_year_number"),
        F.lit(None).cast("timestamp").alias("source_updated_at"),
        as_of.alias("dwh_updated_at"),
        dow.isin(1, 7).alias("is_weekend"),
    )
    zero = {name: F.lit(0) for name in days.columns if name not in ("full_date", "day_name", "month_name")}
    zero |= {
        "full_date": F.lit(EPOCH).cast("date"),
        "day_name": F.lit("Unknown"),
        "month_name": F.lit("Unknown"),
        "source_updated_at": F.lit(None),
        "dwh_updated_at": as_of,
        "is_weekend": F.lit(False),
    }
    sentinel = bounds.where(F.col("start") > F.lit(EPOCH).cast("date")).select(
        *[zero[f.name].cast(f.dataType).alias(f.name) for f in days.schema.fields]
    )
    return days.unionByName(sentinel)


def dim_distribution_centers(centers: DataFrame, as_of: Column) -> DataFrame:
    frame = centers.select(
        surrogate_key("distribution_center_id").alias("dc_key"),
        "distribution_center_id",
        "distribution_center_name",
        "latitude",
        "longitude",
        F.lit(None).cast("timestamp").alias("source_updated_at"),
        as_of.alias("dwh_updated_at"),
    )
    # Fixed values of the unknown member.
    unknown = {
        "dc_key": unknown_key(), "distribution_center_id": UNKNOWN_ID,
        "distribution_center_name": "Unknown Distribution Center", "latitude": 0.0, "longitude": 0.0,
        "source_updated_at": None, "dwh_updated_at": as_of,
    }
    return with_unknown_member(frame, "distribution_center_id", unknown)


def dim_products(products: DataFrame, as_of: Column) -> DataFrame:
    frame = products.select(
        surrogate_key("product_id").alias("product_key"),
        "product_id", "product_name", "category", "brand", "department", "sku", "retail_price", "cost",
        (F.col("retail_price") - F.col("cost")).cast(MONEY).alias("margin_value"),
        "distribution_center_id",
        "source_updated_at",
        as_of.alias("dwh_updated_at"),
    )
    # Fixed values of the unknown member.
    unknown = {
        "product_key": unknown_key(), "product_id": UNKNOWN_ID, "product_name": "Unknown Product",
        "category": "Unknown", "brand": "Unknown", "department": "Unknown", "sku": "N/A", "retail_price": 0,
        "cost": 0, "margin_value": 0, "distribution_center_id": UNKNOWN_ID, "source_updated_at": _epoch(),
        "dwh_updated_at": as_of,
    }
    return with_unknown_member(frame, "product_id", unknown)


def age_group(age: Column) -> Column:
    return (
        F.when(age.isNull(), "Unknown").when(age < 18, "Under 18").when(age < 60, "Adult").otherwise("Senior")
    )


def dim_users(users: DataFrame, as_of: Column, unique_input: bool = True) -> DataFrame:
    """``unique_input=False`` keeps the most recently updated row per user first; staging output is
    already unique, so the default saves that sort."""
    if not unique_input:
        users = latest_by(users, ["user_id"], ["updated_at"])
    frame = users.select(
        surrogate_key("user_id").alias("user_key"),
        "user_id", "first_name", "last_name", "email", "age",
        age_group(F.col("age")).alias("age_group"),
        "gender", "street_address", "postal_code", "city", "state", "country", "latitude", "longitude",
        "traffic_source", "created_at",
        F.col("updated_at").alias("source_updated_at"),
        as_of.alias("dwh_updated_at"),
    )
    # Fixed values of the unknown member.
    unknown = {name: "Unknown" for name in frame.columns} | {
        "user_key": unknown_key(), "user_id": UNKNOWN_ID, "email": "unknown@example.com", "age": None,
        "postal_code": "N/A", "latitude": 0.0, "longitude": 0.0, "created_at": _epoch(),
        "source_updated_at": _epoch(), "dwh_updated_at": as_of,
    }
    return with_unknown_member(frame, "user_id", unknown)


def default_as_of() -> Column:
    return F.lit(dt.datetime.now(dt.timezone.utc).replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp")
