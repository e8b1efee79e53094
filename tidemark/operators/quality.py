"""Data-quality checks. A check returns its violations; an empty result passes."""

from __future__ import annotations

import dataclasses
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import count_where


def duplicates(frame: DataFrame, column: str) -> DataFrame:
    """Values held by more than one row, with their row count."""
    return (
        frame.where(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("string").alias("value"))
        .agg(F.count("*").alias("rows"))
        .where("rows > 1")
    )


def nulls(frame: DataFrame, *columns: str) -> DataFrame:
    """Null count per column, in one pass; columns without nulls are left out."""
    counted = frame.agg(*[count_where(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], list(columns), "column_name", "rows").where("rows > 0")


def unexpected_values(frame: DataFrame, column: str, accepted: Sequence[str]) -> DataFrame:
    return (
        frame.where(~F.col(column).isin(*accepted))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("rows"))
    )


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child keys without a parent and how many rows carry them. Child rows are counted per key before
    the join, so a frequent key costs one row."""
    keys = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("rows"))
    return keys.join(parent.select(F.col(parent_column).alias("value")), "value", "left_anti").select(
        F.col("value").cast("string").alias("value"), "rows"
    )


# Hours after which a source is late (warn, error); None = not checked.
FRESHNESS_HOURS = {
    "users": (2, 12),
    "products": (24, 72),
    "distribution_centers": None,
    "inventory_items": (2, 12),
    "orders": (6, 24),
    "order_items": (6, 24),
    "events": (12, 24),
}


def freshness(
    bronze: Mapping[str, DataFrame], as_of: Column, limits: Mapping[str, tuple[int, int] | None] = FRESHNESS_HOURS
) -> DataFrame:
    """Newest change and status per source."""
    parts = []
    for name, limit in limits.items():
        if limit is None or name not in bronze:
            continue
        warn, error = limit
        newest = F.timestamp_millis(F.max("cdc_timestamp"))
        age = (F.unix_micros(as_of) - F.unix_micros("latest_change_at")) / F.lit(3_600_000_000.0)
        parts.append(
            bronze[name]
            .agg(newest.alias("latest_change_at"))
            .select(F.lit(name).alias("source_table"), "latest_change_at", age.alias("age_hours"))
            .withColumn(
                "status",
                F.when(F.col("age_hours").isNull() | (F.col("age_hours") > error), "error")
                .when(F.col("age_hours") > warn, "warn")
                .otherwise("pass"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def _records(frame: DataFrame, source: str, key: str, value: str, name: str, bad: Column) -> DataFrame:
    return frame.where(bad).select(
        F.lit(source).alias("source_table"), F.col(key).alias("record_id"), F.col(value).alias(name)
    )


def future_dates(orders: DataFrame, order_items: DataFrame, users: DataFrame, as_of: Column) -> DataFrame:
    late = F.col("created_at") > as_of
    sources = ((orders, "orders", "order_id"), (order_items, "order_items", "order_item_id"), (users, "users", "user_id"))
    return reduce(
        DataFrame.unionByName,
        [_records(frame, name, key, "created_at", "timestamp_value", late) for frame, name, key in sources],
    )


def item_count_mismatches(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    counted = order_items.groupBy("order_id").agg(F.count("*").alias("actual"))
    declared, actual = F.col("num_of_item"), F.coalesce(F.col("actual"), F.lit(0))
    return (
        orders.join(counted, "order_id", "left")
        .where(declared != actual)
        .select(
            "order_id",
            declared.alias("declared_item_count"),
            actual.alias("actual_item_count"),
            (declared - actual).alias("discrepancy"),
        )
    )


def negative_prices(order_items: DataFrame, products: DataFrame) -> DataFrame:
    checks = (
        (order_items, "order_items", "order_item_id", "sale_price"),
        (products, "products", "product_id", "cost"),
        (products, "products", "product_id", "retail_price"),
    )
    return reduce(
        DataFrame.unionByName,
        [_records(frame, name, key, price, "price_value", F.col(price) < 0) for frame, name, key, price in checks],
    )


def revenue_mismatches(order_items: DataFrame, orders: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Orders whose revenue differs from the sum of their items by more than ``tolerance``."""
    summed = order_items.groupBy("order_id").agg(F.sum("sale_price").alias("sales_total_revenue"))
    difference = F.abs(F.col("sales_total_revenue") - F.col("total_revenue"))
    return (
        summed.join(orders.select("order_id", "total_revenue"), "order_id")
        .where(difference > F.lit(tolerance).cast("decimal(10,4)"))
        .withColumn("revenue_diff", difference)
    )


def status_violations(orders: DataFrame) -> DataFrame:
    """Orders whose instants run backwards or whose status lacks its instant."""
    created, shipped, delivered, returned, status = (
        F.col(c) for c in ("created_at", "shipped_at", "delivered_at", "returned_at", "status")
    )
    wrong = [
        shipped < created,
        delivered < shipped,
        returned < delivered,
        (status == "Complete") & delivered.isNull(),
        (status == "Returned") & returned.isNull(),
    ]
    anything = reduce(lambda a, b: a | b, [F.coalesce(w, F.lit(False)) for w in wrong])
    return orders.where(anything).select(
        "order_id", "status", "created_at", "shipped_at", "delivered_at", "returned_at"
    )


def events_profile(events: DataFrame) -> DataFrame:
    """Totals and null checks of the enriched events, one row."""
    shop = F.col("event_type").isin("product", "cart", "purchase")
    return events.agg(
        F.count("*").alias("total_rows"),
        F.count_distinct("event_id").alias("unique_events"),
        F.min("event_timestamp").alias("min_timestamp"),
        F.max("event_timestamp").alias("max_timestamp"),
        F.count_distinct("session_id").alias("unique_sessions"),
        F.count_distinct("user_id").alias("unique_users"),
        count_where(F.col("user_id").isNull()).alias("null_users"),
        count_where(F.col("product_id").isNull() & shop).alias("null_products_in_product_events"),
        count_where(F.col("product_name").isNull() & F.col("product_id").isNotNull()).alias("failed_enrichments"),
        count_where(F.col("city").isNull()).alias("null_city"),
        count_where(F.col("traffic_source").isNull()).alias("null_traffic_source"),
    )


def distribution(frame: DataFrame, column: str) -> DataFrame:
    return frame.groupBy(column).agg(F.count("*").alias("rows"))


def enrichment_samples(events: DataFrame, limit: int = 10) -> DataFrame:
    """Most frequent products with their looked-up attributes."""
    return (
        events.where(F.col("product_id").isNotNull())
        .groupBy("product_id", "product_name", "product_category")
        .agg(F.count("*").alias("rows"))
        .orderBy(F.col("rows").desc(), "product_id", "product_name", "product_category")
        .limit(limit)
    )


@dataclasses.dataclass(frozen=True)
class Check:
    """A column test: ``kind`` is unique, not_null, accepted or foreign."""

    model: str
    column: str
    kind: str
    severity: str = "error"
    accepted: tuple[str, ...] = ()
    parent: str = ""
    parent_column: str = ""

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.model}_{self.column}"


def run_checks(models: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """Report (check_name, model, column_name, severity, violations, status) over all checks.

    All null and value tests of a model share one scan; unique and foreign-key tests aggregate by key.
    """
    parts = []

    def line(check: Check, frame: DataFrame, violations: Column) -> DataFrame:
        return frame.select(
            F.lit(check.name).alias("check_name"),
            F.lit(check.model).alias("model"),
            F.lit(check.column).alias("column_name"),
            F.lit(check.severity).alias("severity"),
            violations.cast("bigint").alias("violations"),
        )

    simple: dict[str, list[Check]] = {}
    for check in checks:
        frame = models[check.model]
        if check.kind == "unique":
            parts.append(line(check, duplicates(frame, check.column).agg(F.count("*").alias("n")), F.col("n")))
        elif check.kind == "foreign":
            found = orphans(frame, check.column, models[check.parent], check.parent_column)
            parts.append(line(check, found.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n")), F.col("n")))
        else:
            simple.setdefault(check.model, []).append(check)
    for model, group in simple.items():
        tests = [
            count_where(
                F.col(c.column).isNull() if c.kind == "not_null" else ~F.col(c.column).isin(*c.accepted)
            ).alias(c.name)
            for c in group
        ]
        counted = models[model].agg(*tests).unpivot([], [c.name for c in group], "check_name", "violations")
        names = {c.name: c for c in group}
        column = F.create_map(*[F.lit(x) for n, c in names.items() for x in (n, c.column)])
        severity = F.create_map(*[F.lit(x) for n, c in names.items() for x in (n, c.severity)])
        parts.append(
            counted.select(
                "check_name",
                F.lit(model).alias("model"),
                column[F.col("check_name")].alias("column_name"),
                severity[F.col("check_name")].alias("severity"),
                F.col("violations").cast("bigint").alias("violations"),
            )
        )
    report = reduce(DataFrame.unionByName, parts)
    return report.withColumn("status", F.when(F.col("violations") > 0, F.col("severity")).otherwise("pass"))
