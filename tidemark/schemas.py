"""Table schemas and value domains."""

from __future__ import annotations

from pyspark.sql import types as T

# Domains of the source system.
ORDER_STATUSES = ("Processing", "Shipped", "Complete", "Cancelled", "Returned")
STAGED_STATUSES = ORDER_STATUSES + ("Unknown",)
CUSTOMER_STATUSES = ("Potential", "New", "Returning")
EVENT_TYPES = ("home", "department", "category", "product", "cart", "purchase", "cancel", "return")
PAGEVIEW_TYPES = ("home", "department", "category", "product")
HOT_TABLES = ("events",)


_KINDS = {
    "long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType(),
    "ts": T.TimestampType(), "date": T.DateType(), "bool": T.BooleanType(),
}


def schema(spec: str, required: str = "") -> T.StructType:
    """``"id long, name string"`` → StructType; names in ``required`` are not nullable."""
    must = set(required.split())
    pairs = [item.split() for item in spec.split(",")]
    return T.StructType([T.StructField(name, _KINDS[kind], name not in must) for name, kind in pairs])


SOURCE_TABLES: dict[str, T.StructType] = {
    "distribution_centers": schema("id long, name string, latitude double, longitude double"),
    "products": schema(
        "id long, cost double, category string, name string, brand string, retail_price double, "
        "department string, sku string, distribution_center_id long, updated_at ts"
    ),
    "users": schema(
        "id long, first_name string, last_name string, email string, age int, gender string, state string, "
        "street_address string, postal_code string, city string, country string, latitude double, "
        "longitude double, traffic_source string, created_at ts, updated_at ts"
    ),
    "orders": schema(
        "order_id long, user_id long, status string, gender string, created_at ts, updated_at ts, "
        "returned_at ts, shipped_at ts, delivered_at ts, num_of_item int"
    ),
    "inventory_items": schema(
        "id long, product_id long, created_at ts, sold_at ts, cost double, product_category string, "
        "product_name string, product_brand string, product_retail_price double, product_department string, "
        "product_sku string, product_distribution_center_id long"
    ),
    "order_items": schema(
        "id long, order_id long, user_id long, product_id long, inventory_item_id long, status string, "
        "created_at ts, updated_at ts, shipped_at ts, delivered_at ts, returned_at ts, sale_price double"
    ),
    "events": schema(
        "id long, user_id long, sequence_number int, session_id string, created_at ts, ip_address string, "
        "city string, state string, postal_code string, browser string, traffic_source string, uri string, "
        "event_type string"
    ),
}

# Name of a source table in the lake where it differs, its primary key, and the order in
# which foreign keys allow the tables to be loaded.
LAKE_NAMES = {"distribution_centers": "dist_centers"}
PRIMARY_KEYS = {name: "order_id" if name == "orders" else "id" for name in SOURCE_TABLES}
LOAD_ORDER = (
    "distribution_centers", "products", "users", "inventory_items", "orders", "order_items", "events",
)

CDC_FIELDS = [T.StructField("cdc_timestamp", T.LongType()), T.StructField("cdc_operation", T.StringType())]


def bronze_schema(table: str) -> T.StructType:
    """Source columns plus change time and operation."""
    return T.StructType(SOURCE_TABLES[table].fields + CDC_FIELDS)


TRANSPORT = schema("ingested_at string, topic string, partition long, offset long, key_json string, value_json string")

EVENTS_RAW = schema(
    "event_id long, user_id long, sequence_number long, session_id string, ip_address string, city string, "
    "state string, postal_code string, browser string, traffic_source string, uri string, event_type string, "
    "event_timestamp ts, event_date date, ingested_at ts, page_type string, product_id long, "
    "product_category string, product_department string, product_name string, is_conversion bool, "
    "processing_time ts, event_lag_seconds double",
    required="event_id event_timestamp event_date ingested_at is_conversion processing_time",
)
EVENTS_DEADLETTER = schema(
    "raw_message string, error_message string, failed_at ts", required="error_message failed_at"
)
EVENTS_5M = schema(
    "aggregate_id string, window_start ts, window_end ts, event_date date, traffic_source string, "
    "browser string, event_type string, page_type string, total_events long, unique_sessions long, "
    "unique_users long, purchase_events long, avg_event_lag_seconds double, version_emitted_at ts",
    required="aggregate_id window_start window_end event_date total_events unique_sessions unique_users "
    "purchase_events version_emitted_at",
)
SESSION_METRICS = schema(
    "session_record_id string, session_id string, user_id long, traffic_source string, browser string, "
    "session_start ts, session_end ts, session_duration_seconds double, event_count long, "
    "pageview_count long, product_view_count long, cart_count long, purchase_count long, saw_home bool, "
    "saw_product bool, added_to_cart bool, purchased bool, top_category string, session_date date, "
    "version_emitted_at ts, processed_at ts",
    required="session_record_id session_id session_start session_end session_duration_seconds event_count "
    "pageview_count product_view_count cart_count purchase_count saw_home saw_product added_to_cart "
    "purchased session_date version_emitted_at processed_at",
)
