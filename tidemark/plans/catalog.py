"""Every registered query by name, over the sample tables.

Each entry takes (spark, sf_dir). Frames are lazy unless the operator itself writes (sinks, streams).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import functions as fn
from tidemark.operators import cdc, clicks, incremental, postprocess, quality, sessions
from tidemark.plans import checks, clickboard, sales, sessionboard, stock
from tidemark.plans.staging import STAGING
from tidemark.plans.warehouse import LAYERS, LAYOUT, MODELS, Warehouse
from tidemark.session import prepare
from tidemark.sources import sample

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries.
AS_OF = "2001-10-01 00:00:00"
CLICKS_AS_OF = "2024-02-01 00:00:00"
START, END = "1997-01-01", "1998-12-31"
CLICKS_START, CLICKS_END = "2024-01-05", "2024-01-20"
BRANDS = ("Brand#1", "Brand#2", "Brand#7")
SOURCES = ("Search", "Email")


def instant(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def warehouse(spark: SparkSession, sf_dir: str, deletes: str = "ignore") -> Warehouse:
    inputs: dict[str, Callable[[], DataFrame]] = {
        name: partial(build, spark, sf_dir) for name, build in sample.BRONZE.items()
    }

    def parsed() -> DataFrame:
        return clicks.parse_events(sample.click_messages(spark, sf_dir))

    inputs["clicks"] = lambda: clicks.valid_events(parsed())
    inputs["dead_letters"] = lambda: clicks.dead_letters(parsed(), F.col("timestamp"))
    processed = F.col("ingested_at") + F.expr("INTERVAL 2 SECONDS")
    return Warehouse(inputs, instant(AS_OF), processed, deletes)


def plain(frame: DataFrame) -> DataFrame:
    """Money to 4 and other fractions to 6 places as doubles, for comparison with other engines."""
    columns = []
    for field in frame.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = F.round(column.cast("double"), 4)
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            column = F.round(column, 6)
        columns.append(column.alias(field.name))
    return frame.select(*columns)


def _model(name: str) -> Callable[[Warehouse], DataFrame]:
    return lambda w: w[name]


# --- change data capture -----------------------------------------------------------------------------------


def _cdc_parsed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return cdc.parse_cdc(sample.cdc_messages(spark, sf_dir, name))


def _both_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cdc_parsed(spark, sf_dir, "events").unionByName(_cdc_parsed(spark, sf_dir, "distribution_centers"))


def cdc_parse(spark, sf_dir):
    """Decoded envelope fields of every order change, the key taken from whichever image is there."""
    parsed = _cdc_parsed(spark, sf_dir, "orders")
    image = F.coalesce("after", "before")
    return parsed.select(
        "table", "schema_name", "op", "cdc_timestamp",
        F.get_json_object(image, "$.order_id").cast("bigint").alias("order_id"),
        F.col("after").isNull().alias("before_only"),
    )


def cdc_table_alias(spark, sf_dir):
    parsed = _cdc_parsed(spark, sf_dir, "distribution_centers")
    return parsed.groupBy("table").agg(F.count("*").alias("messages"))


def cdc_flatten(spark, sf_dir):
    return cdc.flatten(_cdc_parsed(spark, sf_dir, "orders"), "orders", unit="micros").drop("_topic", "_timestamp")


def cdc_route_hot(spark, sf_dir):
    hot = cdc.route_hot(_both_streams(spark, sf_dir))
    return cdc.flatten(hot, "events", unit="micros").drop("_topic", "_timestamp")


def cdc_route_cold(spark, sf_dir):
    cold = cdc.route_cold(_both_streams(spark, sf_dir))
    return cold.groupBy("table", "op").agg(F.count("*").alias("rows"), F.max("cdc_timestamp").alias("newest"))


def topic_route(spark, sf_dir):
    messages = sample.cdc_messages(spark, sf_dir, "events").unionByName(
        sample.cdc_messages(spark, sf_dir, "distribution_centers")
    )
    return messages.groupBy(cdc.topic_of(F.col("topic")).alias("destination")).agg(F.count("*").alias("messages"))


def _mixed_stamps(spark, sf_dir) -> DataFrame:
    """Event times as micros, millis, seconds, ISO text or junk, by key."""
    key, when = F.col("event_id"), F.col("ts")
    micros = F.unix_micros(when)
    text = (
        F.when(key % 5 == 0, micros.cast("string"))
        .when(key % 5 == 1, F.unix_millis(when).cast("string"))
        .when(key % 5 == 2, F.unix_seconds(when).cast("string"))
        .when(key % 5 == 3, F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .otherwise("soon")
    )
    return sample.table(spark, sf_dir, "events").select(key, text.alias("created_at"))


def ts_normalise_row(spark, sf_dir):
    """Whole numbers read as epoch micros, text as ISO, junk null."""
    key = F.col("event_id")
    rows = _mixed_stamps(spark, sf_dir).where((key % 5 == 0) | (key % 5 >= 3))
    return cdc.normalise_timestamps(rows)


def schema_normalise(spark, sf_dir):
    """Two batches with different columns and integer widths as one lake table."""
    orders = sample.table(spark, sf_dir, "orders")
    even = orders.where("o_orderkey % 2 = 0").select(
        "o_orderkey", F.unix_micros("o_orderdate").alias("placed_at"), F.lit(1).alias("batch"), F.lit(None).alias("note")
    )
    odd = orders.where("o_orderkey % 2 = 1").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("placed_at"), "o_orderstatus",
        F.lit(2).cast("smallint").alias("batch"),
    )
    return cdc.union_batches(even, odd)


def f_to_timestamp(spark, sf_dir):
    return _mixed_stamps(spark, sf_dir).select("event_id", fn.to_instant(F.col("created_at")).alias("created_at"))


def f_to_cdc_ms(spark, sf_dir):
    rows = sample.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.when(F.col("o_orderkey") % 2 == 0, F.unix_millis("o_orderdate").cast("string"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
        .alias("cdc_timestamp"),
    )
    return rows.select("order_id", fn.cdc_millis(rows).alias("cdc_timestamp"))


def f_scalars(spark, sf_dir):
    """Keys, date keys, whole-unit differences and guarded ratios over all orders."""
    orders = sample.table(spark, sf_dir, "orders")
    placed, priority = F.col("o_orderdate"), F.col("o_orderpriority")
    later = F.timestamp_micros(F.unix_micros(placed) + (F.col("o_orderkey") % 100000) * 1_000_000)
    return orders.select(
        F.col("o_orderkey").alias("order_id"),
        fn.surrogate_key(F.col("o_orderkey"), F.when(F.col("o_orderkey") % 3 != 0, priority)).alias("two_part_key"),
        fn.date_key(placed).alias("placed_key"),
        fn.whole_days(placed, later).alias("days"),
        fn.whole_seconds(later, placed).alias("seconds"),
        F.date_trunc("hour", later).alias("hour_start"),
        fn.safe_divide(F.col("o_totalprice"), F.col("o_orderkey") % 4).alias("ratio"),
        F.nullif(F.trim(F.lower(priority)), F.lit("5-low")).alias("priority"),
        fn.iso_text(later).alias("iso"),
    )


# --- clickstream -------------------------------------------------------------------------------------------


def ev_parse_validate(spark, sf_dir):
    return clicks.valid_events(clicks.parse_events(sample.click_messages(spark, sf_dir)))


def ev_deadletter(spark, sf_dir):
    parsed = clicks.parse_events(sample.click_messages(spark, sf_dir))
    return clicks.dead_letters(parsed, F.col("timestamp")).select("error_message", "failed_at")


def ev_parse_uri(spark, sf_dir):
    uri = F.col("uri")
    return sample.events(spark, sf_dir).select(
        "id", uri, fn.page_type(uri).alias("page_type"), fn.uri_product_id(uri).alias("product_id")
    )


def ev_iso_ts(spark, sf_dir):
    """ISO texts with Z, with an offset, without zone, and junk."""
    events = sample.table(spark, sf_dir, "events")
    key, when = F.col("event_id"), F.col("ts")
    base = F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    text = (
        F.when(key % 4 == 0, F.concat(base, F.lit("Z")))
        .when(key % 4 == 1, F.concat(base, F.lit("+07:00")))
        .when(key % 4 == 2, base)
        .otherwise("yesterday")
    )
    return events.select(key, fn.parse_iso(text).alias("event_timestamp"))


def publish_payload(spark, sf_dir):
    created = sample.events(spark, sf_dir).where("cdc_operation = 'c'")
    return clicks.publish_payload(created, instant(CLICKS_AS_OF))


def st_dedup(w: Warehouse) -> DataFrame:
    return clicks.first_seen(w["clicks"])


def st_session(w: Warehouse) -> DataFrame:
    """Session windows: bounds and size."""
    assigned = sessions.assign_sessions(sessions.session_cells(w["events_first"]))
    return assigned.groupBy("session_id", "session_cell").agg(
        F.min("first_at").alias("session_start"),
        F.max("last_at").alias("session_end"),
        F.sum("event_count").alias("event_count"),
    ).drop("session_cell")


def st_tumbling_5m(w: Warehouse) -> DataFrame:
    window = F.window("event_timestamp", "300 seconds")
    return clicks.first_seen(w["clicks"]).groupBy(window.alias("w")).agg(F.count("*").alias("events")).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "events"
    )


# --- filters -----------------------------------------------------------------------------------------------


def flt_time_bucket(w: Warehouse) -> DataFrame:
    first, last = instant("2024-01-05 10:03:20"), instant("2024-01-05 18:00:00")
    kept = postprocess.filter_time(w["v_events_5m_latest"], "window_start", first, last, 300)
    return kept.select("aggregate_id", "window_start", "total_events")


# --- incremental -------------------------------------------------------------------------------------------


def _older_half(frame: DataFrame, column: str, cut: str) -> DataFrame:
    return frame.where(F.col(column) < instant(cut))


def inc_lookback(w: Warehouse) -> DataFrame:
    """Items changed since three days before the newest row of a target that stops at the end of 2000."""
    items = w["item_lines"]
    target = _older_half(items, "source_updated_at", "2001-01-01 00:00:00")
    changed = incremental.since(items, "source_updated_at", target, "source_updated_at", days=3)
    return changed.select("order_item_id", "source_updated_at")


def inc_impacted_keys(w: Warehouse) -> DataFrame:
    """Orders touched since a build of the orders created before 2001."""
    target = _older_half(w["stg_orders"], "created_at", "2001-01-01 00:00:00")
    return incremental.impacted_orders(w["stg_orders"], w["stg_order_items"], target)


def inc_impacted_users(w: Warehouse) -> DataFrame:
    users, orders = w["dim_users"], w["order_headers"]
    target = _older_half(w["agg_user_stats"], "source_updated_at", "2001-01-01 00:00:00")
    return incremental.impacted_users(users, orders, target)


def inc_merge(w: Warehouse) -> DataFrame:
    """Orders before 2001 upserted with the orders changed from mid-2000 on: the whole fact again."""
    fact = w["order_revenue"].select("order_id", "status", "created_at", "total_revenue", "source_updated_at")
    target = _older_half(fact, "created_at", "2001-01-01 00:00:00").withColumn("status", F.lower("status"))
    delta = fact.where(F.col("created_at") >= instant("2000-07-01 00:00:00"))
    return incremental.merged(target, delta, "order_id")


# --- data quality ------------------------------------------------------------------------------------------


def dq_accepted_values(w: Warehouse) -> DataFrame:
    allowed = ("Processing", "Shipped", "Complete", "Unknown")
    return quality.unexpected_values(w["stg_orders"], "status", allowed)


def _checked(w: Warehouse, tests: list[quality.Check], order: Iterable[str]) -> DataFrame:
    """The report over models that are computed once each, however many tests read them."""
    return quality.run_checks(w.aside(checks.columns(tests, order)), tests)


def dq_report(w: Warehouse) -> DataFrame:
    return _checked(w, checks.STAGING_CHECKS, STAGING)


def dq_mart_report(w: Warehouse) -> DataFrame:
    return _checked(w, checks.MART_CHECKS, LAYOUT)


def dq_freshness(w: Warehouse) -> DataFrame:
    bronze = {name: w[name] for name in sample.BRONZE}
    return quality.freshness(bronze, instant(AS_OF))


# --- registry ----------------------------------------------------------------------------------------------

DIRECT: dict[str, Query] = {
    "cdc_parse": cdc_parse,
    "cdc_table_alias": cdc_table_alias,
    "cdc_flatten": cdc_flatten,
    "cdc_route_hot": cdc_route_hot,
    "cdc_route_cold": cdc_route_cold,
    "topic_route": topic_route,
    "ts_normalise_row": ts_normalise_row,
    "schema_normalise": schema_normalise,
    "f_to_timestamp": f_to_timestamp,
    "f_to_cdc_ms": f_to_cdc_ms,
    "f_scalars": f_scalars,
    "ev_parse_validate": ev_parse_validate,
    "ev_deadletter": ev_deadletter,
    "ev_parse_uri": ev_parse_uri,
    "ev_iso_ts": ev_iso_ts,
    "publish_payload": publish_payload,
}

CAL = (START, END)
CLK = (CLICKS_START, CLICKS_END)
CLK_OF = (CLICKS_START, CLICKS_END, SOURCES)
NOW, CLICKS_NOW = AS_OF, CLICKS_AS_OF

RAW, WINDOWS, SESSIONS = "v_events_raw_dedup", "v_events_5m_latest", "v_session_metrics_latest"


def _sold(query, *extra, items="item_measures"):
    return lambda w: query(w.days(items, *CAL), w["dim_products"], *CAL, *extra)


def _orders(query, *extra, orders="order_headers"):
    return lambda w: query(w.days(orders, *CAL), *CAL, *extra)


def _stock(query, *dims, aged: bool = False):
    def run(w):
        more = [instant(NOW)] if aged else []
        return query(w["stock_measures"], *[w[d] for d in dims], "2000-06-01", "2001-06-30", *more)

    return run


def _clicks(query, *inputs, scope=CLK_OF, **options):
    return lambda w: query(*[w[i] for i in inputs], *scope, **options)


def _top_trend(trend, performance, label, n):
    return lambda w: postprocess.top_trend(
        trend(w.days("item_lines", *CAL), w["dim_products"], *CAL),
        performance(w.days("item_measures", *CAL), w["dim_products"], *CAL), label, n,
    )


INNER = {"events_deadletter", *[layer for layers in LAYERS.values() for layer in layers]}

OVER_WAREHOUSE: dict[str, Callable[[Warehouse], DataFrame]] = {
    **{name: _model(name) for name in STAGING},
    "stg_tombstones": lambda w: _tombstones(w),
    "stg_cast_default": lambda w: w["stg_events"].select("event_id", "city", "uri", "browser"),
    "stg_filter_valid": lambda w: w["stg_order_items"].select("order_item_id", "sale_price", "cdc_operation"),
    **{name: _model(name) for name in MODELS if name not in INNER},
    # clickstream
    "ev_enrich": _model("events_raw"),
    "st_dedup_ttl": st_dedup,
    "st_tumbling_5m": st_tumbling_5m,
    "st_agg_5m": _model("events_5m"),
    "st_session": st_session,
    "st_session_metrics": _model("session_metrics"),
    # filters and ranges
    "flt_date_range": lambda w: w["stg_orders"].where(fn.between_dates("created_at", *CAL)).select("order_id", "created_at"),
    "flt_in_list": lambda w: w["stg_events"]
    .where(fn.in_list("traffic_source", SOURCES) & fn.in_list("browser", None))
    .groupBy("traffic_source").agg(F.count("*").alias("events")),
    "flt_time_bucket": flt_time_bucket,
    "rng_default": lambda w: sales.default_range(
        sales.latest_date(w["agg_dashboard_daily"], w["order_headers"], w[RAW]), 30, dt.date(2024, 2, 1)
    ),
    # incremental
    "inc_lookback": inc_lookback,
    "inc_impacted_keys": inc_impacted_keys,
    "inc_impacted_users": inc_impacted_users,
    "inc_merge": inc_merge,
    # sales
    "q_latest_date": lambda w: sales.latest_date(w["agg_dashboard_daily"], w["order_headers"], w[RAW]),
    "q_latest_timestamp": lambda w: sales.newest(w[RAW], "event_timestamp", "latest_timestamp"),
    "q_latest_window": lambda w: sales.newest(w[WINDOWS], "window_start", "latest_window"),
    "q_latest_session": lambda w: sales.newest(w[SESSIONS], "session_end", "latest_session"),
    "q_sales_kpis": lambda w: sales.sales_kpis(w.daily(*CAL, "orders"), *CAL),
    "q_revenue_trend": lambda w: sales.revenue_trend(w.daily(*CAL), *CAL),
    "q_top_products": _sold(sales.top_products),
    "q_top_products_by_brand": _sold(sales.top_products, BRANDS),
    "q_product_brands": _sold(sales.product_brands, items="item_lines"),
    "q_order_value_distribution": _orders(sales.order_value_distribution, orders="order_measures"),
    "q_order_status_stats": _orders(sales.order_status_stats),
    "q_order_type_stats": _orders(sales.order_type_stats),
    "q_orders_by_city": lambda w: sales.orders_by_city(w.days("order_headers", *CAL), w["dim_users"], *CAL),
    "q_category_performance": _sold(sales.category_performance),
    "q_category_performance_by_brand": _sold(sales.category_performance, BRANDS),
    "q_product_scatter": _sold(sales.product_scatter),
    "q_product_scatter_by_brand": _sold(sales.product_scatter, BRANDS),
    "q_brand_performance": _sold(sales.brand_performance),
    "q_brand_performance_by_brand": _sold(sales.brand_performance, BRANDS),
    "q_department_performance": _sold(sales.department_performance),
    "q_department_performance_by_brand": _sold(sales.department_performance, BRANDS),
    "q_brand_trend": _sold(sales.brand_trend, items="item_lines"),
    "q_brand_trend_by_brand": _sold(sales.brand_trend, BRANDS, items="item_lines"),
    "q_category_trend": _sold(sales.category_trend, items="item_lines"),
    "q_category_trend_by_brand": _sold(sales.category_trend, BRANDS, items="item_lines"),
    "q_marketing_kpis": lambda w: sales.marketing_kpis(w.daily(*CLK, "audience"), *CLK),
    "q_user_segments": lambda w: sales.user_segments(w["dim_users"], w["agg_user_stats"]),
    "q_traffic_cvr": lambda w: sales.traffic_cvr(w.days("event_visits", *CLK), *CLK),
    "q_latest_traffic_date": lambda w: sales.latest_traffic_date(w["event_visits"]),
    "q_traffic_cvr_latest_window": lambda w: sales.traffic_cvr_latest_window(w["event_visits"], CLICKS_END),
    "q_ops_kpis": lambda w: sales.ops_kpis(w.days("order_headers", *CAL), w.days("item_lines", *CAL), *CAL),
    "q_delivery_histogram": _orders(sales.delivery_histogram),
    # inventory
    "q_inventory_status": _stock(stock.inventory_status, aged=True),
    "q_inventory_kpis": _stock(stock.inventory_kpis, aged=True),
    "q_inventory_age_buckets": _stock(stock.inventory_age_buckets, aged=True),
    "q_inventory_by_dc": _stock(stock.inventory_by_dc, "dim_distribution_centers"),
    "q_inventory_by_segment": _stock(stock.inventory_by_segment, "dim_products"),
    "q_inventory_flow": _stock(stock.inventory_flow),
    # clickstream monitoring
    "q_traffic_sources": _clicks(clickboard.traffic_sources, RAW, scope=CLK),
    "q_overview_metrics": _clicks(clickboard.overview_metrics, RAW),
    "q_daily_events_purchases": _clicks(clickboard.daily_events_purchases, RAW),
    "q_channel_distribution": _clicks(clickboard.channel_distribution, RAW, scope=CLK),
    "q_realtime_windows": _clicks(clickboard.realtime_windows, WINDOWS),
    "q_event_type_breakdown": _clicks(clickboard.event_type_breakdown, RAW),
    "q_deadletter_monitor": lambda w: clickboard.deadletter_monitor(
        w["events_deadletter"], *CLK, instant("2024-01-20 12:00:00")
    ),
    "q_deadletter_samples": lambda w: clickboard.deadletter_samples(w["events_deadletter"], *CLK).select(
        "failed_at", "error_message"
    ),
    "q_deadletter_timeseries": _clicks(clickboard.deadletter_timeseries, "events_deadletter", scope=CLK),
    "q_stream_health": _clicks(clickboard.flow_health, WINDOWS, RAW, "events_deadletter"),
    "q_event_lag_timeseries": _clicks(clickboard.event_lag_timeseries, WINDOWS),
    "q_event_type_windows": _clicks(clickboard.event_type_windows, WINDOWS),
    "q_source_event_flow": _clicks(
        clickboard.source_event_flow, RAW, scope=("2024-01-05 06:00:00", "2024-01-20 18:30:00")
    ),
    "q_ingestion_freshness": lambda w: clickboard.ingestion_freshness(
        w[RAW], w[WINDOWS], *CLK, instant(CLICKS_NOW), SOURCES
    ),
    "q_throughput_by_window": _clicks(clickboard.throughput_by_window, WINDOWS),
    "q_approx_uniques_by_window": _clicks(clickboard.approx_uniques_by_window, RAW),
    "q_event_quality_summary": _clicks(clickboard.event_quality_summary, "events_raw", RAW, "events_deadletter"),
    "q_quality_by_event_type": _clicks(clickboard.quality_by_event_type, RAW),
    "q_source_browser_matrix": _clicks(clickboard.source_browser_matrix, WINDOWS, scope=CLK),
    "q_popular_pages": _clicks(clickboard.popular_pages, RAW),
    # sessions
    "q_session_stream_health": lambda w: sessionboard.session_flow_health(
        w[SESSIONS], w["session_metrics"], *CLK, instant(CLICKS_NOW), SOURCES
    ),
    "q_sessionization_timeseries": _clicks(sessionboard.sessionization_timeseries, SESSIONS),
    "q_session_anomaly_buckets": _clicks(sessionboard.session_anomaly_buckets, SESSIONS),
    "q_session_versions_by_hour": _clicks(sessionboard.session_versions_by_hour, "session_metrics"),
    "q_session_summary": _clicks(sessionboard.session_summary, SESSIONS),
    "q_session_timeseries": _clicks(sessionboard.session_timeseries, SESSIONS),
    "q_conversion_funnel": _clicks(sessionboard.conversion_funnel, SESSIONS),
    "q_funnel_dropoff": _clicks(sessionboard.funnel_dropoff, SESSIONS),
    "q_session_duration_histogram": _clicks(sessionboard.session_duration_histogram, SESSIONS),
    "q_cvr_by_channel": _clicks(sessionboard.cvr_by_channel, SESSIONS, scope=CLK),
    "q_cvr_by_browser": _clicks(sessionboard.cvr_by_browser, SESSIONS),
    "q_top_categories": _clicks(sessionboard.top_categories, SESSIONS),
    "q_session_quality": _clicks(sessionboard.session_quality, SESSIONS, scope=CLK),
    # display post-processing
    "pp_melt": lambda w: postprocess.melt(
        sales.revenue_trend(w.daily(*CAL), *CAL), ["date"], ["revenue", "margin"]
    ),
    "pp_p99_trim": lambda w: postprocess.trimmed_histogram(sales.order_values(w["order_revenue"], *CAL), "order_value"),
    "pp_money_scale": lambda w: postprocess.scaled_money(
        sales.order_values(w["order_revenue"], *CAL), "order_value", "order_value_usd"
    ).select("order_id", "order_value_usd"),
    "pp_geo_weight": lambda w: postprocess.city_weights(
        sales.orders_by_city(w["order_headers"], w["dim_users"], *CAL)
    ),
    "pp_geo_weight_dc": lambda w: postprocess.center_weights(
        _stock(stock.inventory_by_dc, "dim_distribution_centers")(w)
    ).select("distribution_center_name", "radius", "alpha"),
    "pp_topn_trend_category": _top_trend(sales.category_trend, sales.category_performance, "category", 5),
    "pp_topn_trend_brand": _top_trend(sales.brand_trend, sales.brand_performance, "brand", 6),
    "pp_margin_pct": lambda w: postprocess.with_margin_pct(
        sales.top_products(w["item_measures"], w["dim_products"], *CAL)
    ).select("product_name", "category", "brand", "department", "margin_pct"),
    "pp_window_rollup": lambda w: postprocess.window_rollup(
        w[WINDOWS], instant("2024-01-05 10:03:20"), instant("2024-01-12 18:00:00")
    ),
    "pp_funnel_links": lambda w: postprocess.funnel_links(
        sessionboard.conversion_funnel(w[SESSIONS], *CLK_OF), [stage for stage, _ in sessionboard.FUNNEL]
    ),
    # data quality
    "dq_unique": lambda w: quality.duplicates(w["orders"], "order_id"),
    "dq_not_null": lambda w: quality.nulls(w["stg_order_items"], "order_item_id", "inventory_item_id", "shipped_at"),
    "dq_accepted_values": dq_accepted_values,
    "dq_relationships": lambda w: quality.orphans(w["stg_orders"], "user_id", w["stg_users"], "user_id"),
    "dq_freshness": dq_freshness,
    "dq_future_dates": lambda w: quality.future_dates(
        w["stg_orders"], w["stg_order_items"], w["stg_users"], instant("2001-06-01 00:00:00")
    ),
    "dq_item_count_match": lambda w: quality.item_count_mismatches(w["stg_orders"], w["stg_order_items"]),
    "dq_positive_prices": lambda w: quality.negative_prices(
        w["order_items"].select(F.col("id").alias("order_item_id"), "sale_price"), w["stg_products"]
    ),
    "dq_revenue_consistency": lambda w: quality.revenue_mismatches(
        w["item_lines"],
        # Seeded violations: the revenue of each 100th order is off by one.
        w["order_revenue"].withColumn(
            "total_revenue",
            F.col("total_revenue") + F.when(F.col("order_id") % 100 == 0, 1).otherwise(0).cast("decimal(38,9)"),
        ),
    ),
    "dq_status_transitions": lambda w: quality.status_violations(w["stg_orders"]),
    "dq_events_profile": lambda w: quality.events_profile(w["events_raw"]),
    "dq_event_distribution": lambda w: quality.distribution(w["events_raw"], "event_type"),
    "dq_deadletter_distribution": lambda w: quality.distribution(w["events_deadletter"], "error_message"),
    "dq_enrichment_samples": lambda w: quality.enrichment_samples(w["events_raw"]),
    "dq_staging_report": dq_report,
    "dq_mart_report": dq_mart_report,
}


def _tombstones(w: Warehouse) -> DataFrame:
    stage, source = STAGING["stg_orders"]
    return stage(w[source], deletes="tombstone")


def _over(build: Callable[[Warehouse], DataFrame]) -> Query:
    return lambda spark, sf_dir: plain(build(warehouse(prepare(spark), sf_dir)))


def _direct(query: Query) -> Query:
    return lambda spark, sf_dir: plain(query(prepare(spark), sf_dir))


def all_queries() -> dict[str, Query]:
    from tidemark.plans.jobs import JOBS

    return {
        **{name: _direct(query) for name, query in DIRECT.items()},
        **{name: _over(build) for name, build in OVER_WAREHOUSE.items()},
        **{name: _direct(query) for name, query in JOBS.items()},
    }
