"""Clickstream: parse and validate, dead letters, enrichment, five-minute aggregates, latest views.

The same functions serve batch frames and streams; only the aggregates have a streaming form of their
own (``tidemark.streaming``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import iso_text, once, page_type, parse_iso, safe_divide, uri_product_id
from tidemark.operators.shape import latest_by, lookup
from tidemark.schemas import EVENT_TYPES, EVENTS_RAW

_TEXTS = (
    "event_id", "id", "user_id", "sequence_number", "session_id", "ip_address", "city", "state",
    "postal_code", "browser", "traffic_source", "uri", "event_type", "event_timestamp", "created_at",
    "ingested_at", "_broken",
)
_MESSAGE = T.StructType([T.StructField(name, T.StringType()) for name in _TEXTS])

WINDOW_SECONDS = 300
AGGREGATE_DIMENSIONS = ("event_date", "traffic_source", "browser", "event_type", "page_type")
VALID_COLUMNS = EVENTS_RAW.fieldNames()[:15]


def parse_events(messages: DataFrame) -> DataFrame:
    """Typed event columns plus ``raw_message`` and ``error_message`` (null for a valid event).

    Other input columns (such as the transport timestamp) are kept.
    """
    raw = F.col("value").cast("string")
    body = F.from_json(raw, _MESSAGE, {"columnNameOfCorruptRecord": "_broken"})
    frame = messages.withColumn("raw_message", raw).withColumn("_m", once(body))

    def given(name: str, alias: str) -> Column:
        # The alias stands in for an absent key only, not for an explicit null.
        explicit_null = F.col("raw_message").rlike(rf'"{name}"\s*:\s*null')
        value, other = F.col(f"_m.{name}"), F.col(f"_m.{alias}")
        return F.when(value.isNull() & other.isNotNull() & ~explicit_null, other).otherwise(value)

    frame = frame.withColumn("_id", given("event_id", "id")).withColumn(
        "_when", given("event_timestamp", "created_at")
    )
    arrived = F.when(
        F.col("_m.ingested_at").isNull() & ~F.col("raw_message").rlike(r'"ingested_at"\s*:\s*null'), F.col("_when")
    ).otherwise(F.col("_m.ingested_at"))
    frame = frame.withColumn("_arrived", arrived)
    required = {
        "event_id": F.col("_id"),
        "session_id": F.col("_m.session_id"),
        "event_type": F.col("_m.event_type"),
        "event_timestamp": F.col("_when"),
        "ingested_at": F.col("_arrived"),
    }
    missing = F.concat_ws(
        ", ", *[F.when(F.coalesce(value, F.lit("")) == "", name) for name, value in required.items()]
    )

    def bad_int(text: Column) -> Column:
        return text.isNotNull() & F.trim(text).try_cast("bigint").isNull()

    def int_error(text: Column) -> Column:
        return F.when(bad_int(text), F.concat(F.lit("invalid literal for int() with base 10: '"), text, F.lit("'")))

    def iso_error(text: Column) -> Column:
        return F.when(parse_iso(text).isNull(), F.concat(F.lit("Invalid isoformat string: '"), text, F.lit("'")))

    error = (
        F.when(F.col("_m").isNull() | F.col("_m._broken").isNotNull(), F.lit("Invalid JSON object"))
        .when(missing != "", F.concat(F.lit("Missing required fields: "), missing))
        .when(
            ~F.col("_m.event_type").isin(*EVENT_TYPES), F.concat(F.lit("Unknown event_type: "), F.col("_m.event_type"))
        )
        .otherwise(
            F.coalesce(
                iso_error(F.col("_when")), iso_error(F.col("_arrived")), int_error(F.col("_id")),
                int_error(F.col("_m.user_id")), int_error(F.col("_m.sequence_number")),
            )
        )
    )
    number = {
        "event_id": F.col("_id"), "user_id": F.col("_m.user_id"), "sequence_number": F.col("_m.sequence_number"),
    }
    texts = ("ip_address", "city", "state", "postal_code", "browser", "traffic_source", "uri", "event_type")
    kept = [c for c in messages.columns if c != "value"]
    happened = parse_iso(F.col("_when"))
    return frame.select(
        *[F.trim(value).try_cast("bigint").alias(name) for name, value in number.items()],
        F.col("_m.session_id").alias("session_id"),
        *[F.col(f"_m.{c}").alias(c) for c in texts],
        happened.alias("event_timestamp"),
        happened.cast("date").alias("event_date"),
        parse_iso(F.col("_arrived")).alias("ingested_at"),
        "raw_message",
        error.alias("error_message"),
        *kept,
    )


def valid_events(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("error_message").isNull()).select(*VALID_COLUMNS)


def dead_letters(parsed: DataFrame, failed_at: Column) -> DataFrame:
    return parsed.where(F.col("error_message").isNotNull()).select(
        "raw_message", "error_message", failed_at.alias("failed_at")
    )


def product_lookup(products: DataFrame) -> DataFrame:
    """Lookup side of the enrichment from a products source table or dimension: the key is
    ``product_id`` or else ``id``, the name column ``name`` or else ``product_name``."""

    def either(first: str, second: str) -> Column:
        present = [F.col(c) for c in (first, second) if c in products.columns]
        return F.coalesce(*present)

    return products.select(
        either("product_id", "id").cast("bigint").alias("_product"),
        F.col("category").alias("product_category"),
        F.col("department").alias("product_department"),
        either("name", "product_name").alias("product_name"),
    ).where(F.col("_product").isNotNull())


def products_named(products: DataFrame, events: DataFrame) -> DataFrame:
    """The products that the events name, in a shape that :func:`enrich` takes: its lookup then grows with what the
    events refer to, not with the catalog."""
    side = product_lookup(products)
    named = events.select(uri_product_id(F.col("uri")).alias("_named")).where(F.col("_named").isNotNull()).distinct()
    found = side.join(named, F.col("_product") == F.col("_named"), "left_semi")
    return found.select(
        F.col("_product").alias("product_id"), F.col("product_category").alias("category"),
        F.col("product_department").alias("department"), "product_name",
    )


def enrich(events: DataFrame, products: DataFrame, processed_at: Column) -> DataFrame:
    """Page type, product attributes, conversion flag and arrival lag. ``products``: a products frame."""
    uri = F.col("uri")
    frame = events.withColumn("page_type", page_type(uri)).withColumn("product_id", uri_product_id(uri))
    side = product_lookup(products)
    if frame.isStreaming:
        frame = frame.join(side, F.col("product_id") == F.col("_product"), "left").drop("_product")
    else:
        frame = lookup(frame, side, "product_id", "_product", spread_by="event_id")
    lag = (F.unix_micros("ingested_at") - F.unix_micros("event_timestamp")) / F.lit(1_000_000.0)
    return frame.select(
        *VALID_COLUMNS,
        "page_type", "product_id", "product_category", "product_department", "product_name",
        (F.col("event_type") == "purchase").alias("is_conversion"),
        processed_at.alias("processing_time"),
        F.greatest(F.lit(0.0), lag).alias("event_lag_seconds"),
    )


def _aggregate_id(window_start: Column) -> Column:
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in AGGREGATE_DIMENSIONS]
    return F.concat_ws("|", iso_text(window_start), *texts)


def aggregate_rows(grouped: DataFrame, emitted_at: Column, seconds: int = WINDOW_SECONDS) -> DataFrame:
    """Output row of a five-minute aggregate from its counters (window_start, dimensions, totals)."""
    start = F.col("window_start")
    end = F.timestamp_micros(F.unix_micros(start) + seconds * 1_000_000)
    return grouped.withColumn("window_end", end).select(
        _aggregate_id(start).alias("aggregate_id"),
        start,
        "window_end",
        *AGGREGATE_DIMENSIONS,
        "total_events", "unique_sessions", "unique_users", "purchase_events",
        safe_divide(F.col("lag_sum"), F.col("lag_count")).alias("avg_event_lag_seconds"),
        emitted_at.alias("version_emitted_at"),
    )


def aggregate_5m(events: DataFrame, emitted_at: Column, seconds: int = WINDOW_SECONDS) -> DataFrame:
    """Fixed windows per (date, source, browser, event type, page type) over a batch of enriched events.

    ``emitted_at`` may refer to ``window_end``. Distinct counts run over one row per visitor and session.
    """
    start = F.window("event_timestamp", f"{seconds} seconds").start.alias("window_start")
    visits = events.groupBy(start, *AGGREGATE_DIMENSIONS, "session_id", "user_id").agg(
        F.count("*").alias("n"),
        F.count_if("is_conversion").alias("conversions"),
        F.sum("event_lag_seconds").alias("lags"),
        F.count("event_lag_seconds").alias("lagged"),
    )
    grouped = visits.groupBy("window_start", *AGGREGATE_DIMENSIONS).agg(
        F.sum("n").alias("total_events"),
        F.count_distinct(F.nullif(F.col("session_id"), F.lit(""))).alias("unique_sessions"),
        F.count_distinct("user_id").alias("unique_users"),
        F.sum("conversions").alias("purchase_events"),
        F.sum("lags").alias("lag_sum"),
        F.sum("lagged").alias("lag_count"),
    )
    return aggregate_rows(grouped, emitted_at, seconds)


def events_5m_latest(aggregates: DataFrame) -> DataFrame:
    return latest_by(aggregates, ["aggregate_id"], ["version_emitted_at"])


def events_raw_dedup(events: DataFrame) -> DataFrame:
    return latest_by(events, ["event_id"], ["ingested_at", "processing_time"])


def first_seen(events: DataFrame) -> DataFrame:
    """Batch form of the stream's deduplication: the earliest copy of each event id."""
    return latest_by(events, ["event_id"], [], then=[F.col("ingested_at").asc()])


def session_funnel(latest_sessions: DataFrame) -> DataFrame:
    return latest_sessions.select(
        "session_id", "user_id", "traffic_source", "browser", F.col("session_start").alias("session_started_at"),
        "saw_home", "saw_product", "added_to_cart", "purchased", "session_duration_seconds", "event_count",
        "top_category",
    )


def daily_channel_kpis(deduplicated: DataFrame) -> DataFrame:
    buys = F.sum("buys")
    visits = deduplicated.groupBy("event_date", "traffic_source", "session_id", "user_id").agg(
        F.count("*").alias("n"), F.count_if(F.col("event_type") == "purchase").alias("buys")
    )
    return visits.groupBy("event_date", "traffic_source").agg(
        F.sum("n").alias("total_events"),
        F.count_distinct("session_id").alias("total_sessions"),
        F.count_distinct("user_id").alias("total_users"),
        buys.alias("purchase_events"),
        safe_divide(buys, F.count_distinct("session_id")).alias("purchase_per_session"),
    )


def product_interest(deduplicated: DataFrame) -> DataFrame:
    return (
        deduplicated.where(F.col("product_id").isNotNull())
        .groupBy("event_date", "product_id", "product_name", "product_category", "product_department")
        .agg(
            F.count_if(F.col("page_type") == "product").alias("product_views"),
            F.count_if(F.col("event_type") == "cart").alias("add_to_cart_events"),
            F.count_if(F.col("event_type") == "purchase").alias("purchase_events"),
        )
    )


def publish_payload(events: DataFrame, now: Column) -> DataFrame:
    """Source event rows → JSON payload for the clickstream topic (``key``, ``value``)."""
    happened = F.coalesce(iso_text(F.col("created_at")), iso_text(now))
    payload = F.struct(
        F.col("id").cast("bigint").alias("event_id"),
        F.col("user_id").cast("bigint").alias("user_id"),
        F.col("sequence_number").cast("bigint").alias("sequence_number"),
        "session_id", "ip_address", "city", "state", "postal_code", "browser", "traffic_source", "uri",
        "event_type",
        happened.alias("event_timestamp"),
        iso_text(now).alias("ingested_at"),
    )
    return events.select(
        F.col("id").cast("string").alias("key"),
        F.to_json(payload, {"ignoreNullFields": "false"}).alias("value"),
    )
