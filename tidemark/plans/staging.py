"""Change log → current row per key, with typed columns and defaults.

``deletes="ignore"`` (default): in orders, order items and events a delete is discarded before the latest
version is picked, so the key falls back to its last live version; the other tables keep the deleted row's
last image. ``deletes="tombstone"``: a key whose latest change is a delete disappears, in every table.

``wanted`` names the columns that are returned beside the key; the same rows are picked. ``_place`` among them lets
rows lie as a lookup with null keys (:func:`tidemark.operators.shape.lookup`) needs them.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import as_instant, cdc_millis
from tidemark.operators.shape import latest_by, place_of

MONEY = "decimal(38,9)"
DELETE = "d"


def _is_live() -> Column:
    return F.coalesce(F.col("cdc_operation"), F.lit("c")) != DELETE


def _current(
    frame: DataFrame, key: str, deletes: str, drop_deletes_first: bool, newest: tuple[str, ...] = ("cdc_timestamp",),
    wanted: Collection[str] | None = None, moments: tuple[str, ...] = (),
) -> DataFrame:
    """``moments`` follow ``created_at``, which ranks before them: they are carried as microseconds since it, which rank
    alike where it is equal and compress better in the shuffle."""
    if moments:
        asked = None if wanted is None else {*wanted, "created_at"}
        spans = frame.withColumns({c: F.unix_micros(c) - _started() for c in moments})
        current = _current(spans, key, deletes, drop_deletes_first, newest, asked)
        back = {c: F.timestamp_micros(F.col(c) + _started()) for c in moments if c in current.columns}
        current = current.withColumns(back) if back else current
        return current if wanted is None or "created_at" in wanted else current.drop("created_at")
    if deletes not in ("ignore", "tombstone"):
        raise ValueError(f"deletes must be 'ignore' or 'tombstone', not {deletes!r}")
    if deletes == "ignore" and drop_deletes_first:
        frame = frame.where(_is_live())
    keys = [key]
    if wanted is not None and "_place" in wanted:
        frame = frame.withColumn("_place", place_of(F.col(key)))
        keys.append("_place")
    if deletes == "ignore":
        return latest_by(frame, keys, newest, wanted=wanted)
    live = latest_by(frame, keys, newest).where(_is_live())
    return live if wanted is None else live.select(*[c for c in live.columns if c in keys or c in wanted])


def _started() -> Column:
    return F.coalesce(F.unix_micros("created_at"), F.lit(0).cast("bigint"))


def _text(name: str, default: str | None = None) -> Column:
    column = F.col(name).cast("string")
    return (column if default is None else F.coalesce(column, F.lit(default))).alias(name)


def _change(bronze: DataFrame) -> list[Column]:
    return [cdc_millis(bronze).alias("cdc_timestamp"), _text("cdc_operation")]


def _change_instant(bronze: DataFrame) -> Column:
    return F.timestamp_millis(cdc_millis(bronze))


def stg_distribution_centers(bronze: DataFrame, deletes: str = "ignore") -> DataFrame:
    typed = bronze.select(
        F.col("id").cast("bigint").alias("distribution_center_id"),
        F.col("name").cast("string").alias("distribution_center_name"),
        F.col("latitude").cast("double").alias("latitude"),
        F.col("longitude").cast("double").alias("longitude"),
        *_change(bronze),
    )
    return _current(typed, "distribution_center_id", deletes, drop_deletes_first=False)


def stg_events(bronze: DataFrame, deletes: str = "ignore", wanted: Collection[str] | None = None) -> DataFrame:
    typed = bronze.select(
        F.col("id").cast("bigint").alias("event_id"),
        F.col("user_id").cast("bigint").alias("user_id"),
        F.col("sequence_number").cast("bigint").alias("sequence_number"),
        _text("session_id", "N/A"),
        _text("ip_address", "N/A"),
        _text("city", "Unknown"),
        _text("state", "Unknown"),
        _text("postal_code", "N/A"),
        _text("browser", "Unknown"),
        _text("traffic_source", "Unknown"),
        _text("event_type", "Unknown"),
        _text("uri", "N/A"),
        F.coalesce(as_instant(bronze, "created_at"), _change_instant(bronze)).alias("created_at"),
        *_change(bronze),
    ).where("event_id IS NOT NULL AND user_id IS NOT NULL AND sequence_number >= 0")
    return _current(typed, "event_id", deletes, drop_deletes_first=True, wanted=wanted)


def stg_inventory_items(bronze: DataFrame, deletes: str = "ignore", wanted: Collection[str] | None = None) -> DataFrame:
    typed = bronze.select(
        F.col("id").cast("bigint").alias("inventory_item_id"),
        F.col("product_id").cast("bigint").alias("product_id"),
        F.coalesce(as_instant(bronze, "created_at"), _change_instant(bronze)).alias("created_at"),
        as_instant(bronze, "sold_at").alias("sold_at"),
        F.col("cost").cast(MONEY).alias("cost"),
        _text("product_category"),
        _text("product_name"),
        _text("product_brand"),
        F.col("product_retail_price").cast(MONEY).alias("product_retail_price"),
        _text("product_department"),
        _text("product_sku"),
        F.col("product_distribution_center_id").cast("bigint").alias("product_distribution_center_id"),
        *_change(bronze),
    )
    return _current(typed, "inventory_item_id", deletes, drop_deletes_first=False, wanted=wanted, moments=("sold_at",))


def stg_order_items(bronze: DataFrame, deletes: str = "ignore", wanted: Collection[str] | None = None) -> DataFrame:
    typed = bronze.select(
        F.col("id").cast("bigint").alias("order_item_id"),
        *[F.col(c).cast("bigint").alias(c) for c in ("order_id", "user_id", "product_id", "inventory_item_id")],
        _text("status", "Unknown"),
        *[as_instant(bronze, c).alias(c) for c in ("created_at", "shipped_at", "delivered_at", "returned_at")],
        F.col("sale_price").cast(MONEY).alias("sale_price"),
        *_change(bronze),
    ).where(
        "order_item_id IS NOT NULL AND order_id IS NOT NULL AND user_id IS NOT NULL AND product_id IS NOT NULL"
        " AND sale_price >= 0 AND created_at IS NOT NULL"
    )
    return _current(
        typed, "order_item_id", deletes, drop_deletes_first=True, newest=("cdc_timestamp", "created_at"), wanted=wanted,
        moments=("shipped_at", "delivered_at", "returned_at"),
    )


def stg_orders(bronze: DataFrame, deletes: str = "ignore", wanted: Collection[str] | None = None) -> DataFrame:
    typed = bronze.select(
        F.col("order_id").cast("bigint").alias("order_id"),
        F.col("user_id").cast("bigint").alias("user_id"),
        _text("status", "Unknown"),
        _text("gender", "Unknown"),
        F.coalesce(as_instant(bronze, "created_at"), _change_instant(bronze)).alias("created_at"),
        *[as_instant(bronze, c).alias(c) for c in ("shipped_at", "delivered_at", "returned_at")],
        F.col("num_of_item").cast("bigint").alias("num_of_item"),
        *_change(bronze),
    ).where("order_id IS NOT NULL AND user_id IS NOT NULL AND num_of_item >= 0")
    return _current(typed, "order_id", deletes, drop_deletes_first=True, wanted=wanted, moments=("shipped_at", "delivered_at", "returned_at"))


def stg_products(bronze: DataFrame, deletes: str = "ignore") -> DataFrame:
    typed = bronze.select(
        F.col("id").cast("bigint").alias("product_id"),
        F.col("cost").cast(MONEY).alias("cost"),
        _text("category"),
        F.coalesce(F.col("name").cast("string"), F.lit("Unknown Product")).alias("product_name"),
        _text("brand"),
        F.col("retail_price").cast(MONEY).alias("retail_price"),
        _text("department"),
        _text("sku"),
        F.col("distribution_center_id").cast("bigint").alias("distribution_center_id"),
        *_change(bronze),
    ).where("product_id IS NOT NULL")
    current = _current(typed, "product_id", deletes, drop_deletes_first=False)
    return current.withColumn("source_updated_at", F.timestamp_millis("cdc_timestamp"))


def stg_users(bronze: DataFrame, deletes: str = "ignore") -> DataFrame:
    typed = bronze.select(
        F.col("id").cast("bigint").alias("user_id"),
        _text("first_name"),
        _text("last_name"),
        _text("email"),
        F.col("age").cast("bigint").alias("age"),
        *[_text(c) for c in ("gender", "street_address", "postal_code", "city", "state", "country")],
        F.col("latitude").cast("double").alias("latitude"),
        F.col("longitude").cast("double").alias("longitude"),
        _text("traffic_source"),
        as_instant(bronze, "created_at").alias("created_at"),
        F.coalesce(as_instant(bronze, "updated_at"), as_instant(bronze, "created_at")).alias("updated_at"),
        *_change(bronze),
    )
    return _current(typed, "user_id", deletes, drop_deletes_first=False)


# Staging model and the source table it reads.
STAGING = {
    "stg_distribution_centers": (stg_distribution_centers, "distribution_centers"),
    "stg_events": (stg_events, "events"),
    "stg_inventory_items": (stg_inventory_items, "inventory_items"),
    "stg_order_items": (stg_order_items, "order_items"),
    "stg_orders": (stg_orders, "orders"),
    "stg_products": (stg_products, "products"),
    "stg_users": (stg_users, "users"),
}
