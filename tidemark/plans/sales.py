"""Sales, product and audience queries over the star schema.

Facts are reduced per product before they meet the product dimension wherever the measures add up, so a
best-seller costs one row in the join. Reports with a limit order by every group column after the
measure, which makes them repeatable.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import between_dates, in_list, on_dates, safe_divide
from tidemark.operators.shape import one_row, top
from tidemark.plans.staging import MONEY

PRODUCT_LABELS = ("product_name", "category", "brand", "department")
Brands = Sequence[str] | None


def _sum(column: str | Column) -> Column:
    return F.coalesce(F.sum(column), F.lit(0))


def _named(column: str) -> Column:
    """Trimmed label; blank or missing becomes ``Unknown``."""
    return F.coalesce(F.nullif(F.trim(column), F.lit("")), F.lit("Unknown"))


def _rate(part: Column, whole: Column) -> Column:
    return F.coalesce(safe_divide(part, whole), F.lit(0.0))


def _of_brands(products: DataFrame, brands: Brands) -> DataFrame:
    return products.where(in_list("brand", brands))


def _items(order_items: DataFrame, start, end) -> DataFrame:
    return order_items.where(between_dates("created_at", start, end))


def _by_product(order_items: DataFrame, products: DataFrame, start, end, brands: Brands) -> DataFrame:
    """Revenue, margin and items per product, with the product's attributes."""
    reduced = (
        _items(order_items, start, end)
        .groupBy("product_id")
        .agg(F.sum("sale_price").alias("revenue"), F.sum("profit").alias("margin"), F.count("*").alias("items"))
    )
    return reduced.join(_of_brands(products, brands), "product_id")


def _sold(order_items: DataFrame, products: DataFrame, start, end, brands: Brands) -> DataFrame:
    """Item rows with product attributes, for measures that need the order id."""
    return _items(order_items, start, end).select("product_id", "order_id", "sale_price", "profit").join(
        _of_brands(products, brands).select("product_id", *PRODUCT_LABELS), "product_id"
    )


def latest_date(daily: DataFrame, orders: DataFrame, events: DataFrame) -> DataFrame:
    """Newest day over the daily aggregate, the orders and the clickstream."""
    days = [
        daily.agg(F.max("date").alias("day")),
        orders.agg(F.to_date(F.max("created_at")).alias("day")),
        events.agg(F.max("event_date").alias("day")),
    ]
    return days[0].union(days[1]).union(days[2]).agg(F.max("day").alias("latest_date"))


def default_range(latest: DataFrame, days: int, today: dt.date) -> DataFrame:
    """The last ``days`` days up to the newest one; up to ``today`` when there is no data."""
    end = F.coalesce(F.col("latest_date"), F.lit(today))
    return latest.select(F.date_sub(end, max(int(days), 1) - 1).alias("start_date"), end.alias("end_date"))


def newest(frame: DataFrame, column: str, name: str) -> DataFrame:
    return frame.agg(F.max(column).alias(name))


def sales_kpis(daily: DataFrame, start, end) -> DataFrame:
    return daily.where(on_dates("date", start, end)).agg(
        *[_sum(c).alias(c) for c in ("revenue", "cost", "margin", "orders")],
        _rate(F.sum("margin"), F.sum("revenue")).alias("margin_rate"),
    )


def revenue_trend(daily: DataFrame, start, end) -> DataFrame:
    zero = F.lit(0).cast(MONEY)
    return (
        daily.where(on_dates("date", start, end))
        .select("date", *[F.coalesce(F.col(c), zero).alias(c) for c in ("revenue", "margin")])
        .orderBy("date")
    )


def top_products(order_items, products, start, end, brands: Brands = None, limit: int = 25) -> DataFrame:
    totals = (
        _by_product(order_items, products, start, end, brands)
        .groupBy(*PRODUCT_LABELS)
        .agg(_sum("revenue").alias("revenue"), _sum("margin").alias("margin"), F.sum("items").alias("items_sold"))
    )
    return top(totals, limit, F.col("revenue").desc(), *PRODUCT_LABELS)


def product_brands(order_items, products, start, end) -> DataFrame:
    sold = _items(order_items, start, end).select("product_id").distinct()
    # Both sides are unique by product, so a plain join does; a semi join would be pushed into every part
    # of the dimension and read the items once for each.
    return sold.join(products, "product_id").select(_named("brand").alias("brand")).distinct().orderBy("brand")


def order_value_distribution(orders, start, end, limit: int | None = None) -> DataFrame:
    """All orders with revenue; with a limit, the newest."""
    paid = orders.where(between_dates("created_at", start, end) & (F.col("total_revenue") > 0))
    return top(paid, limit, F.col("created_at").desc(), F.col("order_id").desc()).select(
        "order_id", F.col("total_revenue").alias("order_value"), F.col("gross_margin").alias("margin"), "num_of_item"
    )


def order_values(orders, start, end) -> DataFrame:
    """The order values of :func:`order_value_distribution`, from orders with revenue but no cost."""
    return order_value_distribution(orders.withColumn("gross_margin", F.lit(None).cast(MONEY)), start, end).drop("margin")


def _order_counts(orders, column: str, start, end) -> DataFrame:
    counted = orders.where(between_dates("created_at", start, end)).groupBy(column)
    return counted.agg(F.count("*").alias("order_count")).orderBy(F.col("order_count").desc(), column)


def order_status_stats(orders, start, end) -> DataFrame:
    return _order_counts(orders, "status", start, end)


def order_type_stats(orders, start, end) -> DataFrame:
    return _order_counts(orders, "order_type", start, end)


def orders_by_city(orders, users, start, end, limit: int | None = None) -> DataFrame:
    """Buyers and orders per place; users are unique, so counting one row per buyer is the distinct count."""
    per_user = orders.where(between_dates("created_at", start, end)).groupBy("user_id").agg(
        F.count("order_id").alias("n")
    )
    places = (
        per_user.join(users.select("user_id", "city", "latitude", "longitude"), "user_id")
        .groupBy("city", "latitude", "longitude")
        .agg(F.count("user_id").alias("user_count"), F.sum("n").alias("order_count"))
    )
    return top(places, limit, F.col("order_count").desc(), "city", "latitude", "longitude")


def category_performance(order_items, products, start, end, brands: Brands = None) -> DataFrame:
    return (
        _sold(order_items, products, start, end, brands)
        .groupBy("category")
        .agg(
            _sum("sale_price").alias("revenue"),
            _sum("profit").alias("margin"),
            F.count_distinct("order_id").alias("orders"),
        )
        .orderBy(F.col("revenue").desc(), "category")
    )


def product_scatter(order_items, products, start, end, brands: Brands = None, more_than: int = 5, limit: int | None = None):
    """Products sold more than ``more_than`` times, the most sold first."""
    totals = (
        _by_product(order_items, products, start, end, brands)
        .groupBy(*PRODUCT_LABELS)
        .agg(
            safe_divide(F.sum("revenue"), F.sum("items")).alias("avg_price"),
            F.sum("margin").alias("total_profit"),
            F.sum("items").alias("volume"),
        )
        .where(F.col("volume") > more_than)
    )
    return top(totals, limit, F.col("volume").desc(), *PRODUCT_LABELS)


def _performance(sold: DataFrame, label: str) -> DataFrame:
    return sold.groupBy(_named(label).alias(label)).agg(
        _sum("sale_price").alias("revenue"),
        _sum("profit").alias("margin"),
        F.count("*").alias("items_sold"),
        F.count_distinct("order_id").alias("orders"),
        _rate(F.sum("profit"), F.sum("sale_price")).alias("margin_rate"),
    )


def brand_performance(order_items, products, start, end, brands: Brands = None, limit: int = 20) -> DataFrame:
    ranked = _performance(_sold(order_items, products, start, end, brands), "brand")
    return top(ranked, limit, F.col("revenue").desc(), "brand")


def department_performance(order_items, products, start, end, brands: Brands = None) -> DataFrame:
    ranked = _performance(_sold(order_items, products, start, end, brands), "department")
    return ranked.orderBy(F.col("revenue").desc(), "department")


def _trend(order_items, products, label: Column, name: str, start, end, brands: Brands) -> DataFrame:
    reduced = (
        _items(order_items, start, end)
        .groupBy("product_id", F.to_date("created_at").alias("date"))
        .agg(F.sum("sale_price").alias("revenue"))
    )
    return (
        reduced.join(_of_brands(products, brands), "product_id")
        .groupBy("date", label.alias(name))
        .agg(F.sum("revenue").alias("revenue"))
        .orderBy("date", name)
    )


def brand_trend(order_items, products, start, end, brands: Brands = None) -> DataFrame:
    return _trend(order_items, products, _named("brand"), "brand", start, end, brands)


def category_trend(order_items, products, start, end, brands: Brands = None) -> DataFrame:
    return _trend(order_items, products, F.col("category"), "category", start, end, brands)


def marketing_kpis(daily, start, end) -> DataFrame:
    """Audience totals; the conversion rate is sessions with a purchase over sessions."""
    bought, visited = F.sum("purchase_sessions"), F.sum("total_sessions")
    return daily.where(on_dates("date", start, end)).agg(
        _sum("total_users").alias("total_users"),
        _sum("total_sessions").alias("total_sessions"),
        _sum("purchase_sessions").alias("checkout_events"),
        _rate(bought, visited).alias("cvr"),
    )


def user_segments(users, user_stats) -> DataFrame:
    return (
        users.select("user_id", "age_group")
        .join(user_stats.select("user_id", "customer_status"), "user_id", "left")
        .groupBy("customer_status", "age_group")
        .agg(F.count("*").alias("user_count"))
    )


def _has_source() -> Column:
    return F.coalesce(F.trim("traffic_source"), F.lit("")) != ""


def traffic_cvr(events, start, end) -> DataFrame:
    """Sessions and buying sessions per traffic source; events without a source are left out."""
    visits = (
        events.where(between_dates("created_at", start, end) & _has_source())
        .groupBy("traffic_source", "session_id")
        .agg(F.bool_or("is_checkout_event").alias("bought"))
    )
    sessions, purchases = F.count("session_id"), F.count(F.when(F.col("bought"), F.col("session_id")))
    return (
        visits.groupBy("traffic_source")
        .agg(sessions.alias("sessions"), purchases.alias("purchases"), _rate(purchases, sessions).alias("cvr"))
        .orderBy(F.col("sessions").desc(), "traffic_source")
    )


def traffic_cvr_latest_window(events, end: dt.date | str, days: int = 30) -> DataFrame:
    last = end if isinstance(end, dt.date) else dt.date.fromisoformat(end)
    return traffic_cvr(events, last - dt.timedelta(days=days - 1), last)


def latest_traffic_date(events) -> DataFrame:
    return events.where(_has_source()).agg(F.to_date(F.max("created_at")).alias("latest_traffic_date"))


def ops_kpis(orders, order_items, start, end) -> DataFrame:
    """Delivery time, share of delayed orders and share of returned items."""
    delivered = orders.where(between_dates("created_at", start, end) & (F.col("delivery_duration_days") > 0)).agg(
        F.coalesce(F.avg("delivery_duration_days"), F.lit(0.0)).alias("avg_delivery_days"),
        _rate(F.count_if("is_delayed"), F.count("*")).alias("delayed_rate"),
    )
    returned = _items(order_items, start, end).agg(
        _rate(F.count_if("is_returned"), F.count("*")).alias("return_rate")
    )
    return one_row(delivered, returned)


def delivery_histogram(orders, start, end) -> DataFrame:
    days = F.col("delivery_duration_days")
    return (
        orders.where(between_dates("created_at", start, end) & days.isNotNull())
        .groupBy(F.concat(days.cast("string"), F.lit(" Days")).alias("duration_bucket"), days)
        .agg(F.count("*").alias("orders"))
        .orderBy("delivery_duration_days")
    )
