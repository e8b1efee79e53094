"""Daily and per-user aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import UNKNOWN_ID, safe_divide
from tidemark.plans.staging import MONEY


def daily_orders(orders: DataFrame) -> DataFrame:
    """Order money per day."""
    zero = F.lit(0).cast(MONEY)
    return orders.groupBy(F.to_date("created_at").alias("date")).agg(
        *[
            F.coalesce(F.sum(source), zero).alias(name)
            for name, source in (("revenue", "total_revenue"), ("cost", "total_cost"), ("margin", "gross_margin"))
        ],
        F.count("order_id").alias("orders"),  # the fact has one row per order
        F.max("source_updated_at").alias("orders_changed"),
    )


def daily_audience(events: DataFrame) -> DataFrame:
    """Visitors and sessions per day; distinct counts run over one row per visitor and session."""
    visits = events.groupBy(F.to_date("created_at").alias("date"), "user_id", "session_id").agg(
        F.bool_or("is_checkout_event").alias("bought"), F.max("source_updated_at").alias("changed")
    )
    return visits.groupBy("date").agg(
        F.count_distinct("user_id").alias("total_users"),
        F.count_distinct("session_id").alias("total_sessions"),
        F.count_distinct(F.when(F.col("bought"), F.col("session_id"))).alias("purchase_sessions"),
        F.max("changed").alias("events_changed"),
    )


def agg_dashboard_daily(orders: DataFrame, events: DataFrame, as_of: Column) -> DataFrame:
    """Order money and event audience per day, days of either side kept."""
    zero, epoch = F.lit(0).cast(MONEY), F.timestamp_seconds(F.lit(0))
    counts = ("orders", "total_users", "total_sessions", "purchase_sessions")
    return daily_orders(orders).join(daily_audience(events), "date", "full").select(
        "date",
        *[F.coalesce(F.col(c), zero).alias(c) for c in ("revenue", "cost", "margin")],
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in counts],
        F.greatest(F.coalesce("orders_changed", epoch), F.coalesce("events_changed", epoch)).alias("source_updated_at"),
        as_of.alias("dwh_updated_at"),
        F.coalesce(safe_divide(F.col("purchase_sessions"), F.col("total_sessions")), F.lit(0.0)).alias("purchase_cvr"),
    )


def agg_user_stats(
    users: DataFrame, orders: DataFrame, as_of: Column, impacted: DataFrame | None = None
) -> DataFrame:
    """Purchase history per known user; ``impacted`` (user_id) restricts an incremental run.

    Without it every user of the dimension but the unknown member is impacted, unless an order carries
    the unknown id itself.
    """
    people = users.select("user_id", F.col("source_updated_at").alias("user_changed"))
    if impacted is not None:
        people = people.join(impacted, "user_id", "left_semi")
        orders = orders.join(impacted, "user_id", "left_semi")
    history = orders.groupBy("user_id").agg(
        F.min("created_at").alias("first_purchase_date"),
        F.max("created_at").alias("latest_purchase_date"),
        F.count("order_id").alias("total_orders"),  # the fact has one row per order
        F.sum("total_revenue").alias("lifetime_value"),
        F.max("source_updated_at").alias("orders_changed"),
    )
    joined = people.join(history, "user_id", "left")
    if impacted is None:
        joined = joined.where((F.col("user_id") != UNKNOWN_ID) | F.col("total_orders").isNotNull())
    total = F.coalesce(F.col("total_orders"), F.lit(0))
    return joined.select(
        "user_id",
        "first_purchase_date",
        "latest_purchase_date",
        total.alias("total_orders"),
        F.coalesce(F.col("lifetime_value"), F.lit(0).cast(MONEY)).alias("lifetime_value"),
        F.when(total == 0, "Potential").when(total == 1, "New").otherwise("Returning").alias("customer_status"),
        F.coalesce("orders_changed", "user_changed").alias("source_updated_at"),
        as_of.alias("dwh_updated_at"),
    )
