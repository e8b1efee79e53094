"""Fact tables. All take current (staged) rows and finished dimensions.

Each fact is layered: what follows from the row alone, then measures that need a join, then surrogate
keys. Unique-key left joins neither add nor drop rows, but Catalyst cannot know that, so a query that
needs no key or no cost starts from the thinner layer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import UNKNOWN_ID, date_key, surrogate_key, whole_days
from tidemark.operators.shape import lookup
from tidemark.plans.staging import MONEY

# Fixed values.
SLOW_MOVING_DAYS = 180
DELAY_DAYS = 5
LOST_STATUSES = ("Returned", "Cancelled")


def _member_key(column: str, known: str) -> Column:
    """Surrogate key of a dimension's member, or of its unknown one. It follows from the id, so that rows on their way
    through the lookups carry a mark instead of the key's text."""
    return surrogate_key(F.when(F.col(known).isNotNull(), F.col(column)).otherwise(F.lit(UNKNOWN_ID).cast("bigint")))


def _known(rows: DataFrame, dimension: DataFrame, column: str, key: str, mark: str, spread_by: str | None = None) -> DataFrame:
    """Adds ``mark``: not null where the dimension has the row's id as its ``key``."""
    side = dimension.select(F.col(key).alias("_id"), F.lit(1).cast("tinyint").alias(mark))
    return lookup(rows, side, column, "_id", spread_by)


def _optional_date_key(name: str) -> Column:
    return F.coalesce(date_key(F.col(name)), F.lit(0).cast("bigint"))


def _last_change() -> Column:
    return F.coalesce("returned_at", "delivered_at", "shipped_at", "created_at")


def _ratio(part: Column, whole: Column) -> Column:
    """Share as a double; zero when there is nothing to divide by."""
    return F.when(F.coalesce(whole, F.lit(0)) == 0, F.lit(0.0)).otherwise(part.cast("double") / whole.cast("double"))


def event_visits(events: DataFrame, as_of: Column) -> DataFrame:
    """The event fact without surrogate keys."""
    return events.select(
        "event_id", "user_id", "sequence_number", "session_id",
        date_key(F.col("created_at")).alias("created_date_key"),
        "ip_address", "city", "state", "postal_code", "browser", "traffic_source", "event_type",
        F.coalesce(F.lower(F.trim("event_type")) == "purchase", F.lit(False)).alias("is_checkout_event"),
        "uri",
        F.col("created_at").alias("source_updated_at"),
        as_of.alias("dwh_updated_at"),
        "created_at",
    )


def _with_user_key(rows: DataFrame, users: DataFrame) -> DataFrame:
    marked = _known(rows, users, "user_id", "user_id", "_known_user")
    return marked.withColumn("user_key", _member_key("user_id", "_known_user")).drop("_known_user")


def fact_events(events: DataFrame, users: DataFrame, as_of: Column) -> DataFrame:
    rows = event_visits(events, as_of)
    return _with_user_key(rows, users).select("event_id", "user_key", *rows.columns[1:])


def stock_measures(items: DataFrame, as_of: Column, *more: str) -> DataFrame:
    """The inventory fact without surrogate keys, and ``more`` columns of the items."""
    sold = F.col("sold_at").isNotNull()
    return items.select(
        "inventory_item_id",
        "product_id",
        F.col("product_distribution_center_id").alias("distribution_center_id"),
        date_key(F.col("created_at")).alias("created_date_key"),
        _optional_date_key("sold_at").alias("sold_date_key"),
        "created_at", "sold_at", "cost",
        F.coalesce("sold_at", "created_at").alias("source_updated_at"),
        as_of.alias("dwh_updated_at"),
        F.when(sold, "Sold")
        .when(F.col("created_at") < as_of - F.expr(f"INTERVAL {SLOW_MOVING_DAYS} DAYS"), "Slow-Moving")
        .otherwise("Available")
        .alias("inventory_status"),
        sold.alias("is_sold"),
        whole_days(F.col("created_at"), F.col("sold_at")).alias("days_in_inventory"),
        *more,
    )


def fact_inventory(items: DataFrame, products: DataFrame, centers: DataFrame, as_of: Column) -> DataFrame:
    narrow = items.select(
        "inventory_item_id", "product_id", "product_distribution_center_id", "created_at", "sold_at", "cost"
    )
    marked = _known(narrow, products, "product_id", "product_id", "_known_product", "inventory_item_id")
    marked = _known(
        marked, centers, "product_distribution_center_id", "distribution_center_id", "_known_center", "inventory_item_id"
    )
    rows = stock_measures(marked, as_of, "_known_product", "_known_center")
    first, product, center, *rest = rows.columns[:-2]
    return rows.select(
        first, _member_key(product, "_known_product").alias("product_key"), product,
        _member_key(center, "_known_center").alias("dc_key"), center, *rest,
    )


def item_lines(items: DataFrame, as_of: Column, *more: str) -> DataFrame:
    """The order-item fact as far as it follows from the item alone: no cost, no surrogate keys; and ``more`` columns."""
    return items.select(
        "order_item_id", "order_id", "user_id", "product_id", "inventory_item_id",
        date_key(F.col("created_at")).alias("created_date_key"),
        *[_optional_date_key(f"{c}_at").alias(f"{c}_date_key") for c in ("shipped", "delivered", "returned")],
        "status",
        F.col("status").isin(*LOST_STATUSES).alias("is_returned"),
        "created_at", "shipped_at", "delivered_at", "returned_at",
        "sale_price",
        _last_change().alias("source_updated_at"),
        as_of.alias("dwh_updated_at"),
        *more,
    )


def _stocked(items: DataFrame, inventory: DataFrame, **more: str) -> DataFrame:
    """Adds the cost of the inventory item, and ``more`` of its columns by new names."""
    stock = inventory.select(
        F.col("inventory_item_id").alias("_stock"),
        F.col("cost").alias("_stock_cost"),
        *[F.col(source).alias(name) for name, source in more.items()],
        *[F.col(c) for c in inventory.columns if c == "_place"],
    )
    return lookup(items, stock, "inventory_item_id", "_stock", spread_by="order_item_id")


def _cost() -> Column:
    return F.coalesce(F.col("_stock_cost"), F.col("_product_cost"), F.lit(0).cast(MONEY))


def _priced(items: DataFrame, inventory: DataFrame, products: DataFrame, **more: str) -> DataFrame:
    """Adds cost (of the inventory item, else of the product, else zero), whether the product is known, and ``more``
    columns of the inventory item by new names."""
    joined = _stocked(items, inventory, **more)
    side = products.select(
        F.col("product_id").alias("_product"), F.col("cost").alias("_product_cost"), F.lit(1).cast("tinyint").alias("_known_product")
    )
    return lookup(joined, side, "product_id", "_product").withColumn("cost", _cost()).drop("_stock_cost", "_product_cost")


def _profit() -> Column:
    return (F.col("sale_price") - F.col("cost")).cast(MONEY)


def _with_profit(rows: DataFrame) -> DataFrame:
    return (
        rows.withColumn("profit", _profit())
        .withColumn("margin_percentage", _ratio(F.col("profit"), F.col("sale_price")))
        .withColumn("product_key", _member_key("product_id", "_known_product"))
        .drop("_known_product")
    )


def item_measures(items: DataFrame, inventory: DataFrame, products: DataFrame, as_of: Column) -> DataFrame:
    """Item lines with cost, profit and margin: the cost of the inventory item, else of the product, else zero.
    ``products`` is the dimension."""
    return _with_profit(item_lines(_priced(items, inventory, products), as_of, "cost", "_known_product"))


def item_money(items: DataFrame, inventory: DataFrame, products: DataFrame) -> DataFrame:
    """Order, price, cost and profit of the items, as in :func:`item_measures`, for sums by order. Only items without a
    cost of their own meet the products; the others go by order meanwhile, so that their sums begin before the next shuffle."""
    side = products.select(F.col("product_id").alias("_product"), F.col("cost").alias("_product_cost"))
    stocked = _stocked(items, inventory).withColumn("_unpriced", F.when(F.col("_stock_cost").isNull(), F.col("product_id")))
    priced = lookup(stocked, side, "_unpriced", "_product", spread_by="order_id").withColumn("cost", _cost())
    return priced.select("order_id", "sale_price", "cost", _profit().alias("profit"))


def fact_order_items(
    items: DataFrame, inventory: DataFrame, users: DataFrame, products: DataFrame, centers: DataFrame, as_of: Column
) -> DataFrame:
    """Items have a unique ``order_item_id``. Only their ids go through the lookups, one shuffle each; what was found
    comes back to the whole rows, which lie by that id since the latest version was taken."""
    ids = items.select("order_item_id", "user_id", "product_id", "inventory_item_id")
    priced = _priced(ids, inventory, products, stock_center="product_distribution_center_id")
    found = _known(priced.drop("inventory_item_id", "product_id"), users, "user_id", "user_id", "_known_user")
    found = _known(found.drop("user_id"), centers, "stock_center", "distribution_center_id", "_known_center", "order_item_id")
    marks = ("cost", "stock_center", "_known_product", "_known_user", "_known_center")
    joined = lookup(items, found.select(F.col("order_item_id").alias("_item"), *marks), "order_item_id", "_item")
    keyed = _with_profit(item_lines(joined, as_of, *marks))
    return keyed.select(
        "order_item_id", "order_id", _member_key("user_id", "_known_user").alias("user_key"), "user_id", "product_key", "product_id",
        F.coalesce(F.col("inventory_item_id"), F.lit(UNKNOWN_ID).cast("bigint")).alias("inventory_item_id"),
        _member_key("stock_center", "_known_center").alias("dc_key"),
        "created_date_key", "shipped_date_key", "delivered_date_key", "returned_date_key",
        "status", "is_returned", "created_at", "shipped_at", "delivered_at", "returned_at",
        "sale_price", "cost", "profit", "source_updated_at", "dwh_updated_at", "margin_percentage",
    )


def order_headers(orders: DataFrame, as_of: Column) -> DataFrame:
    """The order fact as far as it follows from the header alone: no money, no surrogate key. Carries
    ``cdc_timestamp`` so that an incremental run has a watermark to read back."""
    delivery_days = whole_days(F.col("shipped_at"), F.col("delivered_at"))
    return orders.select(
        "order_id", "user_id", "status",
        date_key(F.col("created_at")).alias("created_date_key"),
        *[_optional_date_key(f"{c}_at").alias(f"{c}_date_key") for c in ("shipped", "delivered", "returned")],
        "created_at", "shipped_at", "delivered_at", "returned_at", "num_of_item",
        _last_change().alias("source_updated_at"),
        as_of.alias("dwh_updated_at"),
        whole_days(F.col("created_at"), F.col("shipped_at")).alias("shipping_duration_days"),
        delivery_days.alias("delivery_duration_days"),
        whole_days(F.col("created_at"), F.col("delivered_at")).alias("order_duration_days"),
        F.when(F.col("num_of_item") == 1, "Single").otherwise("Multi").alias("order_type"),
        F.coalesce(delivery_days > DELAY_DAYS, F.lit(False)).alias("is_delayed"),
        "cdc_timestamp",
    )


def order_totals(order_items: DataFrame) -> DataFrame:
    return order_items.groupBy("order_id").agg(
        F.sum("sale_price").alias("total_revenue"),
        F.sum("cost").alias("total_cost"),
        F.sum("profit").alias("gross_margin"),
    )


def order_revenue(orders: DataFrame, lines: DataFrame, as_of: Column) -> DataFrame:
    """Order headers with the revenue of their items, which needs no cost: neither stock nor products are read."""
    totals = lines.groupBy(F.col("order_id").alias("_order")).agg(F.sum("sale_price").alias("total_revenue"))
    joined = lookup(order_headers(orders, as_of), totals, "order_id", "_order")
    return joined.withColumn("total_revenue", F.coalesce("total_revenue", F.lit(0).cast(MONEY)))


def order_measures(orders: DataFrame, order_items: DataFrame, as_of: Column) -> DataFrame:
    """Order headers with the money of their items; ``order_items`` has cost and profit."""
    totals = order_totals(order_items).withColumnRenamed("order_id", "_order")
    joined = lookup(order_headers(orders, as_of), totals, "order_id", "_order")
    money = {c: F.coalesce(F.col(c), F.lit(0).cast(MONEY)) for c in ("total_revenue", "total_cost", "gross_margin")}
    return joined.withColumns(money).withColumn(
        "margin_percentage", _ratio(F.col("gross_margin"), F.col("total_revenue"))
    )


def fact_orders(orders: DataFrame, order_items: DataFrame, users: DataFrame, as_of: Column) -> DataFrame:
    return _with_user_key(order_measures(orders, order_items, as_of), users).select(
        "order_id", "user_key", "user_id", "status",
        "created_date_key", "shipped_date_key", "delivered_date_key", "returned_date_key",
        "created_at", "shipped_at", "delivered_at", "returned_at", "num_of_item",
        "source_updated_at", "dwh_updated_at", "total_revenue", "total_cost", "gross_margin", "margin_percentage",
        "shipping_duration_days", "delivery_duration_days", "order_duration_days", "order_type", "is_delayed",
        "cdc_timestamp",
    )
