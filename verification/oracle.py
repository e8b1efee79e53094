"""Oracle SQL of every registered query that plain SQL can express."""

from __future__ import annotations

import re

from verification.bronze_sql import BRONZE
from verification.model_sql import AS_OF, CLICK_AS_OF, LIVE, MODELS, date_key, session_metrics

NAMED = {**BRONZE, **MODELS}

CAL = "created_at >= TIMESTAMP '1997-01-01' AND created_at < TIMESTAMP '1999-01-01'"
DAYS = "date BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'"
CLK = "event_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'"
SRC = "traffic_source IN ('Search', 'Email')"
CLK_OF = f"{CLK} AND {SRC}"
SES = CLK.replace("event_date", "session_date")
SES_OF = f"{SES} AND {SRC}"
FAILED = "failed_at >= TIMESTAMP '2024-01-05' AND failed_at < TIMESTAMP '2024-01-21'"
STOCK = "created_at < TIMESTAMP '2001-07-01' AND (sold_at IS NULL OR sold_at >= TIMESTAMP '2000-06-01')"
BRANDS = "p.brand IN ('Brand#1', 'Brand#2', 'Brand#7')"
RAW, WIN, SESSIONS = "v_events_raw_dedup", "v_events_5m_latest", "v_session_metrics_latest"


def _uses(sql: str) -> list[str]:
    return [name for name in NAMED if re.search(rf"\b{name}\b", sql)]


def full(body: str, money: str = "", real: str = "") -> str:
    """The body with the named queries it needs, money rounded to 4 and other fractions to 6 places."""
    needed: list[str] = []

    def need(name: str) -> None:
        if name not in needed:
            for inner in _uses(NAMED[name]):
                if inner != name:
                    need(inner)
            needed.append(name)

    for name in _uses(body):
        need(name)
    rounds = [f"round({c}::DOUBLE, 4) AS {c}" for c in money.split()]
    rounds += [f"round({c}::DOUBLE, 6) AS {c}" for c in real.split()]
    outer = f"SELECT * REPLACE ({', '.join(rounds)}) FROM ({body})" if rounds else body
    heads = ", ".join(f"{name} AS ({NAMED[name]})" for name in needed)
    return f"WITH {heads} {outer}" if needed else outer


# Messages by the slice of four days they are delivered in; slices are numbered as micro-batches.
_HELD = "to_seconds(CASE WHEN event_id % 13 = 0 OR {again} THEN 86400 ELSE 0 END)"
_DELIVERED = f"""
SELECT *, dense_rank() OVER (ORDER BY slice) - 1 AS batch_id FROM (
  SELECT TRUE AS valid, event_id, event_timestamp, ingested_at,
         epoch(ingested_at + {_HELD.format(again="ingested_at - event_timestamp >= INTERVAL 1 HOUR")})::BIGINT // 345600 AS slice
  FROM clicks
  UNION ALL
  SELECT FALSE, event_id, ts, NULL,
         epoch(ts + to_seconds((event_id % 7)::INT) + {_HELD.format(again="FALSE")})::BIGINT // 345600
  FROM visits WHERE event_id % 50 = 0)"""


def _kept(ttl_seconds: int, lateness_seconds: int = 600) -> str:
    """Events kept by the ingest job. All copies of an event carry one event time here, so an id is remembered from
    its first batch until the watermark passes that time by the time to live, and never after."""
    reach = (
        "SELECT batch_id, max(max(event_timestamp) FILTER (valid))"
        f" OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM ({_DELIVERED}) GROUP BY 1"
    )
    return (
        "SELECT event_id, ingested_at, batch_id, CASE WHEN event_timestamp < reached - to_seconds({late})"
        " THEN reached - to_seconds({late}) END AS missed_watermark"
        " FROM (SELECT * FROM ({rows}) WHERE valid"
        "       QUALIFY row_number() OVER (PARTITION BY batch_id, event_id ORDER BY ingested_at) = 1)"
        " JOIN ({reach}) USING (batch_id)"
        " QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY batch_id) = 1"
        " OR event_timestamp + to_seconds({ttl}) <= reached"
    ).format(late=lateness_seconds, ttl=ttl_seconds, rows=_DELIVERED, reach=reach)


def _punctual(lateness_seconds: int) -> str:
    """First copies of events, enriched, that the ingest job found on time, with their micro-batch."""
    return (
        f"SELECT e.*, k.batch_id FROM events_first e JOIN ({_kept(400 * 86_400, lateness_seconds)}) k USING (event_id)"
        " WHERE k.missed_watermark IS NULL"
    )


def _panes(lateness_seconds: int) -> str:
    """Micro-batches in which an aggregate has a pane: those of its events, and those in which the watermark passes the
    window's end (``on_time``) and the end of its lateness (``closing``); one more micro-batch ends the stream."""
    dims = "event_date, traffic_source, browser, event_type, page_type, window_start"
    same = " AND ".join(f"e.{c.strip()} IS NOT DISTINCT FROM p.{c.strip()}" for c in dims.split(","))
    return f"""
    WITH marks AS (
      SELECT batch_id, max(max(event_timestamp) FILTER (valid)) OVER (ORDER BY batch_id) AS reached, FALSE AS ends
      FROM ({_DELIVERED}) GROUP BY 1),
    steps AS (SELECT * FROM marks UNION ALL SELECT max(batch_id) + 1, max(reached), TRUE FROM marks),
    ev AS (SELECT *, time_bucket(INTERVAL 5 MINUTE, event_timestamp) AS window_start FROM ({_punctual(lateness_seconds)})),
    win AS (
      SELECT window_start,
             min(batch_id) FILTER (ends OR reached >= window_start + INTERVAL 5 MINUTE) AS on_time,
             min(batch_id) FILTER (ends OR reached >= window_start + INTERVAL 5 MINUTE + to_seconds({lateness_seconds})) AS closing
      FROM (SELECT DISTINCT window_start FROM ev), steps GROUP BY 1),
    agg AS (SELECT {dims}, min(batch_id) AS opened FROM ev GROUP BY ALL),
    pane AS (
      SELECT {dims}, batch_id FROM ev
      UNION SELECT {dims}, on_time FROM agg JOIN win USING (window_start) WHERE opened <= on_time
      UNION SELECT {dims}, closing FROM agg JOIN win USING (window_start))
    SELECT strftime(p.window_start, '%Y-%m-%dT%H:%M:%S+00:00') || '|' || p.event_date || '|' || coalesce(p.traffic_source, '')
             || '|' || coalesce(p.browser, '') || '|' || p.event_type || '|' || p.page_type AS aggregate_id,
           p.window_start, p.window_start + INTERVAL 5 MINUTE AS window_end, p.event_date, p.traffic_source, p.browser,
           p.event_type, p.page_type, count(*) AS total_events, count(DISTINCT e.session_id) AS unique_sessions,
           count(DISTINCT e.user_id) AS unique_users, count(*) FILTER (e.is_conversion) AS purchase_events,
           sum(e.event_lag_seconds) / count(e.event_lag_seconds) AS avg_event_lag_seconds,
           CASE WHEN p.batch_id = any_value(w.closing) THEN 'final' WHEN p.batch_id = any_value(w.on_time) THEN 'on_time'
                WHEN p.batch_id > any_value(w.on_time) THEN 'late' ELSE 'early' END AS kind,
           any_value(s.reached) AS watermark, p.batch_id,
           row_number() OVER (PARTITION BY p.window_start, p.event_date, p.traffic_source, p.browser, p.event_type, p.page_type
                              ORDER BY p.batch_id) - 1 AS pane
    FROM pane p JOIN ev e ON {same} AND e.batch_id <= p.batch_id
    JOIN win w ON w.window_start = p.window_start JOIN steps s ON s.batch_id = p.batch_id
    GROUP BY p.window_start, p.event_date, p.traffic_source, p.browser, p.event_type, p.page_type, p.batch_id"""


def _items(where: str = "TRUE") -> str:
    return f"(SELECT i.*, p.product_name, p.category, p.brand, p.department FROM fact_order_items i JOIN dim_products p USING (product_id) WHERE {CAL.replace('created_at', 'i.created_at')} AND {where})"


def _label(column: str) -> str:
    return f"coalesce(nullif(trim({column}), ''), 'Unknown')"


def _top_products(where: str) -> str:
    return (
        "SELECT product_name, category, brand, department, sum(sale_price) AS revenue, sum(profit) AS margin,"
        f" count(*) AS items_sold FROM {_items(where)} GROUP BY ALL"
        " ORDER BY revenue DESC, product_name, category, brand, department LIMIT 25"
    )


def _categories(where: str) -> str:
    return (
        "SELECT category, sum(sale_price) AS revenue, sum(profit) AS margin, count(DISTINCT order_id) AS orders"
        f" FROM {_items(where)} GROUP BY ALL"
    )


def _scatter(where: str) -> str:
    return (
        # through text, so that halves round up on their decimal digits, as Spark rounds them
        "SELECT product_name, category, brand, department,"
        " (sum(sale_price)::DOUBLE / count(*))::VARCHAR::DECIMAL(38, 6)::DOUBLE AS avg_price,"
        f" sum(profit) AS total_profit, count(*) AS volume FROM {_items(where)} GROUP BY ALL HAVING count(*) > 5"
    )


def _performance(label: str, where: str, limit: str = "") -> str:
    return (
        f"SELECT {_label(label)} AS {label}, sum(sale_price) AS revenue, sum(profit) AS margin, count(*) AS items_sold,"
        " count(DISTINCT order_id) AS orders,"
        " coalesce(sum(profit)::DOUBLE / nullif(sum(sale_price)::DOUBLE, 0), 0) AS margin_rate"
        f" FROM {_items(where)} GROUP BY 1 {limit}"
    )


def _trend(label: str, where: str) -> str:
    return f"SELECT created_at::DATE AS date, {label}, sum(sale_price) AS revenue FROM {_items(where)} GROUP BY ALL"


def _brand_trend(where: str) -> str:
    return _trend(f"{_label('brand')} AS brand", where)


def _cvr(where: str) -> str:
    return (
        "SELECT traffic_source, count(DISTINCT session_id) AS sessions,"
        " count(DISTINCT session_id) FILTER (is_checkout_event) AS purchases,"
        " count(DISTINCT session_id) FILTER (is_checkout_event) / count(DISTINCT session_id)::DOUBLE AS cvr"
        f" FROM fact_events WHERE {where} AND trim(traffic_source) <> '' GROUP BY 1"
    )


def _per_window(columns: str) -> str:
    return f"SELECT window_start, {columns} FROM {WIN} WHERE {CLK_OF} GROUP BY 1"


def _open_cost(prefix: str = "") -> str:
    return f"coalesce(sum({prefix}cost) FILTER (NOT {prefix}is_sold), 0) AS available_cost"


def _stock_by(labels: str, dim: str, key: str, tail: str = "") -> str:
    named = ", ".join(f"d.{x}" for x in labels.split())
    return (
        f"SELECT {named}, count(*) AS item_count, count(*) FILTER (NOT f.is_sold) AS available_items,"
        " count(*) FILTER (f.inventory_status = 'Slow-Moving') AS slow_moving_items,"
        f" {_open_cost('f.')} FROM (SELECT * FROM fact_inventory WHERE {STOCK}) f LEFT JOIN {dim} d USING ({key})"
        f" GROUP BY ALL {tail}"
    )


_AGE = f"CASE WHEN is_sold THEN days_in_inventory ELSE date_sub('day', created_at, {AS_OF}) END"
_LEN = "session_duration_seconds"


def _session_cvr(column: str, where: str, more: str = "") -> str:
    return (
        f"SELECT {column}, count(*) AS sessions, count(*) FILTER (purchased) AS purchased_sessions,"
        f" count(*) FILTER (purchased) / count(*)::DOUBLE AS conversion_rate, avg({_LEN}) AS avg_session_seconds{more}"
        f" FROM {SESSIONS} WHERE {where} GROUP BY ALL"
    )


_FUNNEL = (
    f"SELECT count(*) FILTER (saw_home) AS home, count(*) FILTER (saw_product) AS product,"
    f" count(*) FILTER (added_to_cart) AS cart, count(*) FILTER (purchased) AS bought FROM {SESSIONS} WHERE {SES_OF}"
)

_LATEST_DATE = (
    "(SELECT max(d) AS latest_date FROM (SELECT max(date) AS d FROM agg_dashboard_daily"
    f" UNION ALL SELECT max(created_at)::DATE FROM fact_orders UNION ALL SELECT max(event_date) FROM {RAW}))"
)

_ORDER_VALUES = (
    f"(SELECT order_id, total_revenue, gross_margin, num_of_item FROM fact_orders WHERE {CAL} AND total_revenue > 0"
    ")"
)

_CITIES = (
    "(SELECT city, latitude, longitude, count(DISTINCT o.user_id) AS user_count, count(*) AS order_count"
    f" FROM fact_orders o JOIN dim_users u USING (user_id) WHERE {CAL.replace('created_at', 'o.created_at')}"
    " GROUP BY ALL)"
)

_PROFILE_MONEY = {
    "stg_inventory_items": "cost product_retail_price",
    "stg_order_items": "sale_price",
    "stg_products": "cost retail_price",
    "dim_products": "retail_price cost margin_value",
    "fact_inventory": "cost",
    "fact_order_items": "sale_price cost profit",
    "fact_orders": "total_revenue total_cost gross_margin",
    "agg_dashboard_daily": "revenue cost margin",
    "agg_user_stats": "lifetime_value",
}
_PROFILE_REAL = {
    "fact_order_items": "margin_percentage",
    "fact_orders": "margin_percentage",
    "agg_dashboard_daily": "purchase_cvr",
    "events_raw": "event_lag_seconds",
    "events_first": "event_lag_seconds",
    "v_events_raw_dedup": "event_lag_seconds",
    "events_5m": "avg_event_lag_seconds",
    "v_events_5m_latest": "avg_event_lag_seconds",
    "session_metrics": "session_duration_seconds",
    "v_session_metrics_latest": "session_duration_seconds",
    "dim_distribution_centers": "latitude longitude",
    "dim_users": "latitude longitude",
}


def _models() -> dict[str, str]:
    return {n: full(f"SELECT * FROM {n}", _PROFILE_MONEY.get(n, ""), _PROFILE_REAL.get(n, "")) for n in MODELS}


def _cdc() -> dict[str, str]:
    stamp = (
        "CASE event_id % 5 WHEN 0 THEN ts WHEN 1 THEN date_trunc('milliseconds', ts)"
        " WHEN 2 THEN date_trunc('second', ts) WHEN 3 THEN date_trunc('second', ts) END AS created_at"
    )
    return {
        "cdc_parse": full(
            "SELECT 'orders' AS \"table\", 'demo' AS schema_name, cdc_operation AS op, cdc_timestamp, order_id,"
            " cdc_operation = 'd' AS before_only FROM b_orders"
        ),
        "cdc_table_alias": full("SELECT 'dist_centers' AS \"table\", count(*) AS messages FROM b_distribution_centers"),
        "cdc_flatten": full("SELECT * FROM b_orders"),
        "cdc_route_hot": full("SELECT * FROM b_events"),
        "cdc_route_cold": full(
            "SELECT 'dist_centers' AS \"table\", cdc_operation AS op, count(*) AS rows, max(cdc_timestamp) AS newest"
            " FROM b_distribution_centers GROUP BY ALL"
        ),
        "topic_route": full(
            "SELECT 'clickstream-events' AS destination, count(*) AS messages FROM b_events"
            " UNION ALL SELECT 'cdc-events', count(*) FROM b_distribution_centers"
        ),
        "ts_normalise_row": "SELECT event_id, CASE event_id % 5 WHEN 0 THEN ts WHEN 3 THEN date_trunc('second', ts) END"
        " AS created_at FROM events WHERE event_id % 5 IN (0, 3, 4)",
        "schema_normalise": "SELECT (o_orderkey % 2 + 1) AS batch, NULL::VARCHAR AS note, o_orderkey,"
        " CASE WHEN o_orderkey % 2 = 1 THEN o_orderstatus END AS o_orderstatus, o_orderdate AS placed_at FROM orders",
        "f_to_timestamp": f"SELECT event_id, {stamp} FROM events",
        "f_to_cdc_ms": "SELECT o_orderkey AS order_id, (epoch_us(o_orderdate) // 1000) AS cdc_timestamp FROM orders",
        "f_scalars": "SELECT o_orderkey AS order_id,"
        " md5('c0:' || o_orderkey || '||c1:' || CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority ELSE '__null__' END)"
        f" AS two_part_key, {date_key('o_orderdate')} AS placed_key,"
        " date_sub('day', o_orderdate, later) AS days, date_sub('second', later, o_orderdate) AS seconds,"
        " date_trunc('hour', later) AS hour_start,"
        " round(CASE WHEN o_orderkey % 4 <> 0 THEN o_totalprice / (o_orderkey % 4) END, 6) AS ratio,"
        " nullif(trim(lower(o_orderpriority)), '5-low') AS priority,"
        " strftime(later, '%Y-%m-%dT%H:%M:%S+00:00') AS iso"
        " FROM (SELECT *, o_orderdate + to_seconds((o_orderkey % 100000)::INT) AS later FROM orders)",
        "ev_parse_validate": full("SELECT * FROM clicks"),
        "ev_deadletter": full("SELECT * FROM events_deadletter"),
        "ev_parse_uri": full(
            "SELECT id, uri, CASE WHEN uri IS NULL THEN 'unknown' WHEN uri = '/' THEN 'home'"
            " WHEN uri LIKE '/cancel/%' THEN 'post_purchase' ELSE split_part(uri, '/', 2) END AS page_type,"
            " CASE WHEN uri LIKE '/product/%' THEN split_part(uri, '/', 3)::BIGINT END AS product_id FROM b_events"
        ),
        "ev_iso_ts": "SELECT event_id, CASE event_id % 4 WHEN 0 THEN ts WHEN 1 THEN ts - INTERVAL 7 HOUR WHEN 2 THEN ts"
        " END AS event_timestamp FROM events",
        "publish_payload": full(
            "SELECT id::VARCHAR AS key, to_json(struct_pack(event_id := id, user_id := user_id,"
            " sequence_number := sequence_number, session_id := session_id, ip_address := ip_address, city := city,"
            " state := state, postal_code := postal_code, browser := browser, traffic_source := traffic_source,"
            " uri := uri, event_type := event_type,"
            " event_timestamp := strftime(created_at, '%Y-%m-%dT%H:%M:%S') ||"
            " CASE WHEN epoch_us(created_at) % 1000000 <> 0 THEN strftime(created_at, '.%f') ELSE '' END || '+00:00',"
            " ingested_at := '2024-02-01T00:00:00+00:00'))::VARCHAR AS value FROM b_events WHERE cdc_operation = 'c'"
        ),
    }


def _stream_forms() -> dict[str, str]:
    return {
        "stg_tombstones": full(
            "SELECT * FROM (SELECT order_id, user_id, status, gender, created_at, shipped_at, delivered_at,"
            " returned_at, num_of_item, cdc_timestamp, cdc_operation FROM b_orders"
            " QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY cdc_timestamp DESC) = 1)"
            f" WHERE {LIVE}"
        ),
        "stg_cast_default": full("SELECT event_id, city, uri, browser FROM stg_events"),
        "stg_filter_valid": full("SELECT order_item_id, sale_price, cdc_operation FROM stg_order_items", "sale_price"),
        "ev_enrich": full("SELECT * FROM events_raw", real="event_lag_seconds"),
        "st_dedup_ttl": full("SELECT * FROM clicks QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ingested_at) = 1"),
        "st_tumbling_5m": full(
            "SELECT time_bucket(INTERVAL 5 MINUTE, event_timestamp) AS window_start,"
            " time_bucket(INTERVAL 5 MINUTE, event_timestamp) + INTERVAL 5 MINUTE AS window_end, count(*) AS events"
            " FROM (SELECT DISTINCT event_id, event_timestamp FROM clicks) GROUP BY ALL"
        ),
        "st_agg_5m": full("SELECT * FROM events_5m", real="avg_event_lag_seconds"),
        "st_session": full("SELECT session_id, session_start, session_end, event_count FROM session_metrics"),
        "st_session_metrics": full("SELECT * FROM session_metrics", real="session_duration_seconds"),
        "v_session_funnel": full(
            "SELECT session_id, user_id, traffic_source, browser, session_start AS session_started_at, saw_home,"
            " saw_product, added_to_cart, purchased, session_duration_seconds, event_count, top_category"
            f" FROM {SESSIONS}",
            real="session_duration_seconds",
        ),
        "v_daily_channel_kpis": full(
            "SELECT event_date, traffic_source, count(*) AS total_events, count(DISTINCT session_id) AS total_sessions,"
            " count(DISTINCT user_id) AS total_users, count(*) FILTER (event_type = 'purchase') AS purchase_events,"
            " count(*) FILTER (event_type = 'purchase') / count(DISTINCT session_id)::DOUBLE AS purchase_per_session"
            f" FROM {RAW} GROUP BY ALL",
            real="purchase_per_session",
        ),
        "v_product_interest": full(
            "SELECT event_date, product_id, product_name, product_category, product_department,"
            " count(*) FILTER (page_type = 'product') AS product_views,"
            " count(*) FILTER (event_type = 'cart') AS add_to_cart_events,"
            f" count(*) FILTER (event_type = 'purchase') AS purchase_events FROM {RAW} WHERE product_id IS NOT NULL"
            " GROUP BY ALL"
        ),
        "flt_date_range": full(f"SELECT order_id, created_at FROM stg_orders WHERE {CAL}"),
        "flt_in_list": full(f"SELECT traffic_source, count(*) AS events FROM stg_events WHERE {SRC} GROUP BY ALL"),
        "flt_time_bucket": full(
            f"SELECT aggregate_id, window_start, total_events FROM {WIN}"
            " WHERE window_start BETWEEN TIMESTAMP '2024-01-05 10:00:00' AND TIMESTAMP '2024-01-05 18:00:00'"
        ),
        "rng_default": full(
            f"SELECT (latest_date - 29)::DATE AS start_date, latest_date AS end_date FROM {_LATEST_DATE}"
        ),
        "inc_lookback": full(
            "SELECT order_item_id, source_updated_at FROM fact_order_items WHERE source_updated_at >="
            " (SELECT max(source_updated_at) - INTERVAL 3 DAY FROM fact_order_items"
            " WHERE source_updated_at < TIMESTAMP '2001-01-01')"
        ),
        "inc_impacted_keys": full(
            "SELECT order_id FROM stg_orders WHERE cdc_timestamp >= (SELECT max(cdc_timestamp) FROM stg_orders"
            " WHERE created_at < TIMESTAMP '2001-01-01')"
            " UNION SELECT order_id FROM stg_order_items WHERE created_at >= (SELECT max(created_at) - INTERVAL 1 DAY"
            " FROM stg_orders WHERE created_at < TIMESTAMP '2001-01-01')"
        ),
        "inc_impacted_users": full(
            "SELECT user_id FROM dim_users, (SELECT max(source_updated_at) - INTERVAL 3 DAY AS cut FROM agg_user_stats"
            " WHERE source_updated_at < TIMESTAMP '2001-01-01') WHERE user_id <> -1 AND source_updated_at >= cut"
            " UNION SELECT user_id FROM fact_orders, (SELECT max(source_updated_at) - INTERVAL 3 DAY AS cut"
            " FROM agg_user_stats WHERE source_updated_at < TIMESTAMP '2001-01-01') WHERE source_updated_at >= cut"
        ),
        "inc_merge": full(
            "SELECT order_id, CASE WHEN created_at < TIMESTAMP '2000-07-01' THEN lower(status) ELSE status END AS status,"
            " created_at, total_revenue, source_updated_at FROM fact_orders",
            "total_revenue",
        ),
    }


def _sales() -> dict[str, str]:
    perf = ("revenue margin", "margin_rate")
    every, some = "TRUE", BRANDS
    top20 = "ORDER BY revenue DESC, brand LIMIT 20"
    result = {
        "q_latest_date": full(f"SELECT latest_date FROM {_LATEST_DATE}"),
        "q_latest_timestamp": full(f"SELECT max(event_timestamp) AS latest_timestamp FROM {RAW}"),
        "q_latest_window": full(f"SELECT max(window_start) AS latest_window FROM {WIN}"),
        "q_latest_session": full(f"SELECT max(session_end) AS latest_session FROM {SESSIONS}"),
        "q_sales_kpis": full(
            "SELECT sum(revenue) AS revenue, sum(cost) AS cost, sum(margin) AS margin, sum(orders)::BIGINT AS orders,"
            f" sum(margin)::DOUBLE / sum(revenue)::DOUBLE AS margin_rate FROM agg_dashboard_daily WHERE {DAYS}",
            "revenue cost margin", "margin_rate",
        ),
        "q_revenue_trend": full(
            f"SELECT date, revenue, margin FROM agg_dashboard_daily WHERE {DAYS}", "revenue margin"
        ),
        "q_product_brands": full(f"SELECT DISTINCT {_label('brand')} AS brand FROM {_items()}"),
        "q_order_value_distribution": full(
            f"SELECT order_id, total_revenue AS order_value, gross_margin AS margin, num_of_item FROM {_ORDER_VALUES}",
            "order_value margin",
        ),
        "q_order_status_stats": full(f"SELECT status, count(*) AS order_count FROM fact_orders WHERE {CAL} GROUP BY 1"),
        "q_order_type_stats": full(
            f"SELECT order_type, count(*) AS order_count FROM fact_orders WHERE {CAL} GROUP BY 1"
        ),
        "q_orders_by_city": full(f"SELECT * FROM {_CITIES}", real="latitude longitude"),
        "q_marketing_kpis": full(
            "SELECT sum(total_users)::BIGINT AS total_users, sum(total_sessions)::BIGINT AS total_sessions,"
            " sum(purchase_sessions)::BIGINT AS checkout_events,"
            " sum(purchase_sessions) / sum(total_sessions)::DOUBLE AS cvr"
            f" FROM agg_dashboard_daily WHERE {CLK.replace('event_date', 'date')}",
            real="cvr",
        ),
        "q_user_segments": full(
            "SELECT customer_status, age_group, count(*) AS user_count FROM dim_users LEFT JOIN"
            " (SELECT user_id, customer_status FROM agg_user_stats) USING (user_id) GROUP BY ALL"
        ),
        "q_traffic_cvr": full(
            _cvr("created_at >= TIMESTAMP '2024-01-05' AND created_at < TIMESTAMP '2024-01-21'"), real="cvr"
        ),
        "q_traffic_cvr_latest_window": full(
            _cvr("created_at >= TIMESTAMP '2023-12-22' AND created_at < TIMESTAMP '2024-01-21'"), real="cvr"
        ),
        "q_latest_traffic_date": full(
            "SELECT max(created_at)::DATE AS latest_traffic_date FROM fact_events WHERE trim(traffic_source) <> ''"
        ),
        "q_ops_kpis": full(
            "SELECT avg(delivery_duration_days) AS avg_delivery_days,"
            " count(*) FILTER (is_delayed) / count(*)::DOUBLE AS delayed_rate,"
            f" (SELECT count(*) FILTER (is_returned) / count(*)::DOUBLE FROM fact_order_items WHERE {CAL}) AS return_rate"
            f" FROM fact_orders WHERE {CAL} AND delivery_duration_days > 0",
            real="avg_delivery_days delayed_rate return_rate",
        ),
        "q_delivery_histogram": full(
            "SELECT delivery_duration_days || ' Days' AS duration_bucket, delivery_duration_days, count(*) AS orders"
            f" FROM fact_orders WHERE {CAL} AND delivery_duration_days IS NOT NULL GROUP BY ALL"
        ),
    }
    for suffix, where in (("", every), ("_by_brand", some)):
        result |= {
            f"q_top_products{suffix}": full(_top_products(where), "revenue margin"),
            f"q_category_performance{suffix}": full(_categories(where), "revenue margin"),
            f"q_product_scatter{suffix}": full(_scatter(where), "total_profit", "avg_price"),
            f"q_brand_performance{suffix}": full(_performance("brand", where, top20), *perf),
            f"q_department_performance{suffix}": full(_performance("department", where), *perf),
            f"q_brand_trend{suffix}": full(_brand_trend(where), "revenue"),
            f"q_category_trend{suffix}": full(_trend("category", where), "revenue"),
        }
    return result


def _inventory() -> dict[str, str]:
    rows = f"(SELECT *, {_AGE} AS age FROM fact_inventory WHERE {STOCK})"
    bands = "CASE WHEN age < 30 THEN {} WHEN age < 60 THEN {} WHEN age < 90 THEN {} WHEN age < 180 THEN {} ELSE {} END"
    labels = bands.format("'0-29 days'", "'30-59 days'", "'60-89 days'", "'90-179 days'", "'180+ days'")
    return {
        "q_inventory_status": full(
            "SELECT inventory_status AS status, count(*) AS item_count, sum(cost) AS inventory_cost,"
            f" avg(age) AS avg_days_in_inv FROM {rows} GROUP BY 1",
            "inventory_cost", "avg_days_in_inv",
        ),
        "q_inventory_kpis": full(
            "SELECT count(*) AS inventory_items, count(*) FILTER (NOT is_sold) AS available_items,"
            " count(*) FILTER (inventory_status = 'Slow-Moving') AS slow_moving_items,"
            f" count(*) FILTER (is_sold) AS sold_items, {_open_cost()},"
            " coalesce(avg(age) FILTER (NOT is_sold), 0) AS avg_available_age_days,"
            " coalesce(avg(days_in_inventory), 0) AS avg_sold_days_in_inventory,"
            f" count(*) FILTER (is_sold) / count(*)::DOUBLE AS sell_through_rate FROM {rows}",
            "available_cost", "avg_available_age_days avg_sold_days_in_inventory sell_through_rate",
        ),
        "q_inventory_age_buckets": full(
            f"SELECT {labels} AS age_bucket, {bands.format(1, 2, 3, 4, 5)} AS bucket_order, count(*) AS item_count,"
            f" sum(cost) AS inventory_cost FROM {rows} GROUP BY ALL",
            "inventory_cost",
        ),
        "q_inventory_by_dc": full(
            _stock_by("distribution_center_name latitude longitude", "dim_distribution_centers", "distribution_center_id"),
            "available_cost", "latitude longitude",
        ),
        "q_inventory_by_segment": full(
            _stock_by(
                "category department", "dim_products", "product_id",
                "ORDER BY available_items DESC, category, department LIMIT 20",
            ),
            "available_cost",
        ),
        "q_inventory_flow": full(
            "SELECT date, coalesce(n, 0) AS created_items, coalesce(m, 0) AS sold_items FROM"
            " (SELECT created_at::DATE AS date, count(*) AS n FROM fact_inventory WHERE created_at >= TIMESTAMP"
            " '2000-06-01' AND created_at < TIMESTAMP '2001-07-01' GROUP BY 1) FULL JOIN"
            " (SELECT sold_at::DATE AS date, count(*) AS m FROM fact_inventory WHERE sold_at >= TIMESTAMP '2000-06-01'"
            " AND sold_at < TIMESTAMP '2001-07-01' GROUP BY 1) USING (date)"
        ),
    }


def _clickboard() -> dict[str, str]:
    buys = "count(*) FILTER (event_type = 'purchase')"
    lag = "avg(avg_event_lag_seconds) AS avg_event_lag_seconds"
    p95 = "quantile_disc(event_lag_seconds, 0.95)"
    return {
        "q_traffic_sources": full(f"SELECT DISTINCT traffic_source FROM {RAW} WHERE {CLK}"),
        "q_overview_metrics": full(
            "SELECT count(*) AS total_events, count(DISTINCT session_id) AS total_sessions,"
            f" count(DISTINCT user_id) AS total_users, {buys} AS purchase_events,"
            f" {buys} / count(DISTINCT session_id)::DOUBLE AS conversion_rate FROM {RAW} WHERE {CLK_OF}",
            real="conversion_rate",
        ),
        "q_daily_events_purchases": full(
            f"SELECT event_date, count(*) AS total_events, {buys} AS purchase_events FROM {RAW} WHERE {CLK_OF} GROUP BY 1"
        ),
        "q_channel_distribution": full(
            "SELECT traffic_source, count(*) AS total_events, count(DISTINCT session_id) AS sessions,"
            f" {buys} AS purchases FROM {RAW} WHERE {CLK} GROUP BY 1"
        ),
        "q_realtime_windows": full(
            _per_window(
                "sum(total_events)::BIGINT AS total_events, sum(purchase_events)::BIGINT AS purchase_events, " + lag
            ),
            real="avg_event_lag_seconds",
        ),
        "q_event_type_breakdown": full(
            f"SELECT event_type, count(*) AS total_events FROM {RAW} WHERE {CLK_OF} GROUP BY 1"
        ),
        "q_deadletter_monitor": full(
            "SELECT count(*) AS deadletter_count, count(*) FILTER (failed_at::DATE = DATE '2024-01-20')"
            f" AS deadletter_today, max(failed_at) AS latest_failure_at FROM events_deadletter WHERE {FAILED}"
        ),
        "q_deadletter_samples": full(
            f"SELECT failed_at, error_message FROM events_deadletter WHERE {FAILED} ORDER BY failed_at DESC LIMIT 8"
        ),
        "q_deadletter_timeseries": full(
            "SELECT date_trunc('hour', failed_at) AS failed_hour, count(*) AS deadletter_count"
            f" FROM events_deadletter WHERE {FAILED} GROUP BY 1"
        ),
        "q_stream_health": full(
            "SELECT *, deadletter_count / raw_events::DOUBLE AS deadletter_rate FROM"
            " (SELECT sum(total_events)::BIGINT AS realtime_events, sum(purchase_events)::BIGINT AS realtime_purchases,"
            f" {lag}, max(window_start) AS latest_window_start FROM {WIN} WHERE {CLK_OF}),"
            " (SELECT count(*) AS raw_events, max(event_timestamp) AS latest_event_timestamp,"
            f" max(processing_time) AS latest_processing_time FROM {RAW} WHERE {CLK_OF}),"
            f" (SELECT count(*) AS deadletter_count FROM events_deadletter WHERE {FAILED})",
            real="avg_event_lag_seconds deadletter_rate",
        ),
        "q_event_lag_timeseries": full(
            _per_window(lag + ", sum(total_events)::BIGINT AS total_events"), real="avg_event_lag_seconds"
        ),
        "q_event_type_windows": full(
            f"SELECT window_start, event_type, sum(total_events)::BIGINT AS total_events FROM {WIN} WHERE {CLK_OF} GROUP BY ALL"
        ),
        "q_source_event_flow": full(
            f"SELECT traffic_source, event_type, count(*) AS total_events FROM {RAW} WHERE event_timestamp BETWEEN"
            " TIMESTAMP '2024-01-05 06:00:00' AND TIMESTAMP '2024-01-20 18:30:00' GROUP BY ALL"
        ),
        "q_ingestion_freshness": full(
            f"SELECT *, date_sub('second', latest_processing_time, {CLICK_AS_OF}) AS processing_freshness_seconds,"
            f" date_sub('second', latest_window_emitted_at, {CLICK_AS_OF}) AS aggregate_freshness_seconds FROM"
            " (SELECT count(*) AS dedup_events, max(event_timestamp) AS latest_event_timestamp,"
            " max(ingested_at) AS latest_ingested_at, max(processing_time) AS latest_processing_time,"
            f" avg(event_lag_seconds) AS avg_event_lag_seconds, {p95} AS p95_event_lag_seconds FROM {RAW} WHERE {CLK_OF}),"
            " (SELECT max(window_start) AS latest_window_start, max(version_emitted_at) AS latest_window_emitted_at,"
            " count(DISTINCT window_start) AS emitted_windows, sum(total_events)::BIGINT AS window_events"
            f" FROM {WIN} WHERE {CLK_OF})",
            real="avg_event_lag_seconds p95_event_lag_seconds",
        ),
        "q_throughput_by_window": full(
            _per_window(
                "sum(total_events)::BIGINT AS total_events, sum(unique_sessions)::BIGINT AS unique_sessions,"
                f" sum(unique_users)::BIGINT AS unique_users, {lag}, sum(total_events) / 300.0::DOUBLE AS"
                " events_per_second, max(version_emitted_at) AS version_emitted_at"
            ),
            real="avg_event_lag_seconds events_per_second",
        ),
        "q_event_quality_summary": full(
            "SELECT *, raw_rows - dedup_rows AS duplicate_rows_removed,"
            " (raw_rows - dedup_rows) / raw_rows::DOUBLE AS duplicate_rate,"
            " deadletter_rows / (raw_rows + deadletter_rows)::DOUBLE AS reject_rate FROM"
            " (SELECT count(*) AS raw_rows, count(DISTINCT event_id) AS distinct_event_ids,"
            " count(*) FILTER (coalesce(trim(session_id), '') = '') AS missing_session_id,"
            " count(*) FILTER (user_id IS NULL) AS missing_user_id,"
            " count(*) FILTER (coalesce(trim(event_type), '') = '') AS missing_event_type,"
            " count(*) FILTER (event_timestamp IS NULL) AS missing_event_timestamp,"
            f" count(*) FILTER (event_lag_seconds < 0) AS negative_lag_events FROM events_raw WHERE {CLK_OF}),"
            f" (SELECT count(*) AS dedup_rows FROM {RAW} WHERE {CLK_OF}),"
            f" (SELECT count(*) AS deadletter_rows FROM events_deadletter WHERE {FAILED})",
            real="duplicate_rate reject_rate",
        ),
        "q_quality_by_event_type": full(
            "SELECT event_type, count(*) AS total_events, count(*) FILTER (coalesce(trim(session_id), '') = '')"
            " AS missing_session_id, count(*) FILTER (user_id IS NULL) AS missing_user_id,"
            f" avg(event_lag_seconds) AS avg_event_lag_seconds, {p95} AS p95_event_lag_seconds"
            f" FROM {RAW} WHERE {CLK_OF} GROUP BY 1",
            real="avg_event_lag_seconds p95_event_lag_seconds",
        ),
        "q_source_browser_matrix": full(
            "SELECT traffic_source, browser, sum(total_events)::BIGINT AS total_events,"
            f" sum(unique_sessions)::BIGINT AS unique_sessions, {lag} FROM {WIN} WHERE {CLK} GROUP BY ALL",
            real="avg_event_lag_seconds",
        ),
        "q_popular_pages": full(
            f"SELECT uri, page_type, count(*) AS total_events, count(DISTINCT session_id) AS sessions, {buys} AS purchases"
            f" FROM {RAW} WHERE {CLK_OF} GROUP BY ALL ORDER BY total_events DESC, uri NULLS FIRST, page_type LIMIT 12"
        ),
    }


def _sessionboard() -> dict[str, str]:
    bands = (
        f"CASE WHEN {_LEN} < 60 THEN {{}} WHEN {_LEN} < 180 THEN {{}} WHEN {_LEN} < 300 THEN {{}}"
        f" WHEN {_LEN} < 600 THEN {{}} WHEN {_LEN} < 900 THEN {{}} WHEN {_LEN} < 1800 THEN {{}} ELSE {{}} END"
    )
    labels = bands.format("'0-1m'", "'1-3m'", "'3-5m'", "'5-10m'", "'10-15m'", "'15-30m'", "'30m+'")
    seconds = f"avg({_LEN}) AS avg_session_seconds"
    hour = "date_trunc('hour', session_start) AS session_hour"
    scope = f"FROM {SESSIONS} WHERE {SES_OF}"
    return {
        "q_session_stream_health": full(
            "SELECT *, session_metric_versions - distinct_sessions AS superseded_versions,"
            " (session_metric_versions - distinct_sessions) / session_metric_versions::DOUBLE AS superseded_version_rate,"
            f" date_sub('second', latest_processed_at, {CLICK_AS_OF}) AS session_freshness_seconds FROM"
            " (SELECT count(*) AS latest_sessions, count(*) FILTER (coalesce(trim(session_id), '') = '')"
            f" AS missing_session_id, count(*) FILTER ({_LEN} < 0) AS negative_duration_sessions,"
            " count(*) FILTER (event_count = 0) AS zero_event_sessions, avg(event_count) AS avg_events_per_session,"
            f" quantile_disc(event_count, 0.95) AS p95_events_per_session, {seconds},"
            f" quantile_disc({_LEN}, 0.95) AS p95_session_seconds, max(session_end) AS latest_session_end,"
            f" max(version_emitted_at) AS latest_version_emitted_at, max(processed_at) AS latest_processed_at {scope}),"
            " (SELECT count(*) AS session_metric_versions, count(DISTINCT session_id) AS distinct_sessions"
            f" FROM session_metrics WHERE {SES_OF})",
            real="avg_events_per_session avg_session_seconds p95_session_seconds superseded_version_rate",
        ),
        "q_sessionization_timeseries": full(
            f"SELECT {hour}, count(*) AS sessions, sum(event_count)::BIGINT AS events_in_sessions,"
            f" avg(event_count) AS avg_events_per_session, {seconds},"
            f" max(version_emitted_at) AS latest_version_emitted_at {scope} GROUP BY 1",
            real="avg_events_per_session avg_session_seconds",
        ),
        "q_session_anomaly_buckets": full(
            f"SELECT 'zero_event_sessions' AS check_name, count(*) FILTER (event_count = 0) AS sessions {scope} UNION ALL"
            f" SELECT 'single_event_sessions', count(*) FILTER (event_count = 1) {scope} UNION ALL"
            f" SELECT 'negative_duration_sessions', count(*) FILTER ({_LEN} < 0) {scope} UNION ALL"
            f" SELECT 'long_sessions_over_30m', count(*) FILTER ({_LEN} > 1800) {scope}"
        ),
        "q_session_versions_by_hour": full(
            "SELECT date_trunc('hour', version_emitted_at) AS emitted_hour, count(*) AS emitted_versions,"
            " count(DISTINCT session_id) AS distinct_sessions,"
            f" count(*) - count(DISTINCT session_id) AS superseded_versions FROM session_metrics WHERE {SES_OF} GROUP BY 1"
        ),
        "q_session_summary": full(
            f"SELECT count(*) AS total_sessions, {seconds}, quantile_disc({_LEN}, 0.5) AS median_session_seconds,"
            " avg(event_count) AS avg_event_count, avg(pageview_count) AS avg_pageviews,"
            " avg(product_view_count) AS avg_product_views,"
            " count(*) FILTER (added_to_cart) / count(*)::DOUBLE AS cart_rate,"
            f" count(*) FILTER (purchased) / count(*)::DOUBLE AS conversion_rate {scope}",
            real="avg_session_seconds median_session_seconds avg_event_count avg_pageviews avg_product_views cart_rate"
            " conversion_rate",
        ),
        "q_session_timeseries": full(
            f"SELECT {hour}, count(*) AS sessions, count(*) FILTER (purchased) AS purchased_sessions, {seconds} {scope}"
            " GROUP BY 1",
            real="avg_session_seconds",
        ),
        "q_conversion_funnel": full(
            "SELECT unnest(['Home', 'Product', 'Cart', 'Purchase']) AS stage,"
            f" unnest([home, product, cart, bought]) AS sessions FROM ({_FUNNEL})"
        ),
        "q_funnel_dropoff": full(
            "SELECT unnest(['Home -> Product', 'Product -> Cart', 'Cart -> Purchase']) AS transition,"
            f" unnest([home, product, cart]) AS from_sessions, unnest([product, cart, bought]) AS to_sessions FROM ({_FUNNEL})"
        ),
        "q_session_duration_histogram": full(
            f"SELECT {labels} AS duration_bucket, {bands.format(1, 2, 3, 4, 5, 6, 7)} AS bucket_order,"
            f" count(*) AS sessions {scope} GROUP BY ALL"
        ),
        "q_cvr_by_channel": full(_session_cvr("traffic_source", SES), real="conversion_rate avg_session_seconds"),
        "q_cvr_by_browser": full(_session_cvr("browser", SES_OF), real="conversion_rate avg_session_seconds"),
        "q_top_categories": full(
            _session_cvr(
                "coalesce(top_category, 'Unknown') AS top_category", SES_OF,
                ", avg(product_view_count) AS avg_product_views",
            )
            + " ORDER BY sessions DESC, top_category LIMIT 12",
            real="conversion_rate avg_session_seconds avg_product_views",
        ),
        "q_session_quality": full(
            f"SELECT traffic_source, browser, count(*) AS sessions, {seconds}, avg(event_count) AS avg_event_count,"
            " avg(pageview_count) AS avg_pageviews, count(*) FILTER (purchased) / count(*)::DOUBLE AS conversion_rate"
            f" FROM {SESSIONS} WHERE {SES} GROUP BY ALL ORDER BY sessions DESC, traffic_source, browser LIMIT 20",
            real="avg_session_seconds avg_event_count avg_pageviews conversion_rate",
        ),
    }


def _display() -> dict[str, str]:
    located = (
        f"(SELECT *, greatest((order_count + user_count)::DOUBLE, 1) AS heat_score FROM {_CITIES}"
        " WHERE latitude <> 0 AND longitude <> 0)"
    )
    centers = (
        "(SELECT * FROM ("
        + _stock_by("distribution_center_name latitude longitude", "dim_distribution_centers", "distribution_center_id")
        + ") WHERE latitude <> 0 AND longitude <> 0)"
    )
    return {
        "pp_melt": full(
            f"SELECT date, 'revenue' AS metric, revenue AS value FROM agg_dashboard_daily WHERE {DAYS} UNION ALL"
            f" SELECT date, 'margin', margin FROM agg_dashboard_daily WHERE {DAYS}",
            "value",
        ),
        "pp_p99_trim": full(
            "SELECT bin, low + bin * w AS low, low + (bin + 1) * w AS high, count(*) AS rows FROM"
            " (SELECT least(floor((v - low) / w), 29)::INT AS bin, low, w FROM"
            " (SELECT v, min(v) OVER () AS low, (max(v) OVER () - min(v) OVER ()) / 30 AS w FROM"
            f" (SELECT v, quantile_disc(v, 0.99) OVER () AS cut FROM (SELECT total_revenue::DOUBLE AS v FROM {_ORDER_VALUES}))"
            " WHERE v <= cut)) GROUP BY ALL",
            real="low high",
        ),
        "pp_money_scale": full(
            "SELECT order_id, CASE WHEN quantile_disc(v, 0.95) OVER () > 1000000 THEN v / 1000000000 ELSE v END AS"
            f" order_value_usd FROM (SELECT order_id, total_revenue::DOUBLE AS v FROM {_ORDER_VALUES})",
            real="order_value_usd",
        ),
        "pp_geo_weight": full(
            "SELECT city, latitude AS lat, longitude AS lon, user_count, order_count, heat_score,"
            " 45000 + (heat_score / max(heat_score) OVER ()) ** 0.52 * 260000 AS radius,"
            " floor(95 + 145 * (heat_score / max(heat_score) OVER ()) ** 0.35)::INT AS alpha"
            f" FROM {located}",
            real="lat lon heat_score radius",
        ),
        "pp_geo_weight_dc": full(
            "SELECT distribution_center_name, 35000 + (available_items / m) ** 0.55 * 180000 AS radius,"
            " floor(95 + 145 * least(slow_moving_items / m, 1))::INT AS alpha FROM"
            f" (SELECT *, coalesce(nullif(max(available_items) OVER (), 0), 1)::DOUBLE AS m FROM {centers})",
            real="radius",
        ),
        "pp_topn_trend_category": full(
            f"SELECT * FROM ({_trend('category', 'TRUE')}) SEMI JOIN (SELECT category FROM"
            f" ({_categories('TRUE')}) ORDER BY revenue DESC, category LIMIT 5) USING (category)",
            "revenue",
        ),
        "pp_topn_trend_brand": full(
            f"SELECT * FROM ({_brand_trend('TRUE')}) SEMI JOIN (SELECT brand FROM"
            f" ({_performance('brand', 'TRUE')}) ORDER BY revenue DESC, brand LIMIT 6) USING (brand)",
            "revenue",
        ),
        "pp_margin_pct": full(
            "SELECT product_name, category, brand, department,"
            " coalesce(margin::DOUBLE / nullif(revenue::DOUBLE, 0), 0) AS margin_pct"
            f" FROM ({_top_products('TRUE')})",
            real="margin_pct",
        ),
        "pp_window_rollup": full(
            f"SELECT event_type, sum(total_events)::BIGINT AS total_events FROM {WIN} WHERE window_start BETWEEN"
            " TIMESTAMP '2024-01-05 10:00:00' AND TIMESTAMP '2024-01-12 18:00:00' GROUP BY 1"
        ),
        "pp_funnel_links": full(
            "SELECT unnest(['Home', 'Product', 'Cart']) AS source, unnest(['Product', 'Cart', 'Purchase']) AS target,"
            f" unnest([product, cart, bought]) AS value FROM ({_FUNNEL})"
        ),
    }


def _checks() -> dict[str, str]:
    orphan = "SELECT {c}::VARCHAR AS value, count(*) AS rows FROM {t} WHERE {c} NOT IN (SELECT {k} FROM {p}) GROUP BY 1"
    future = "created_at > TIMESTAMP '2001-06-01'"
    limits = "('users', 2, 12), ('products', 24, 72), ('inventory_items', 2, 12), ('orders', 6, 24), ('order_items', 6, 24), ('events', 12, 24)"
    newest = " UNION ALL ".join(
        f"SELECT '{t}' AS source_table, make_timestamp(max(cdc_timestamp) * 1000) AS latest_change_at FROM b_{t}"
        for t in ("users", "products", "inventory_items", "orders", "order_items", "events")
    )
    return {
        "dq_unique": full(
            "SELECT order_id::VARCHAR AS value, count(*) AS rows FROM b_orders GROUP BY 1 HAVING count(*) > 1"
        ),
        "dq_not_null": full(
            "SELECT 'inventory_item_id' AS column_name, count(*) AS rows FROM stg_order_items WHERE inventory_item_id IS"
            " NULL UNION ALL SELECT 'shipped_at', count(*) FROM stg_order_items WHERE shipped_at IS NULL"
        ),
        "dq_accepted_values": full(
            "SELECT status AS value, count(*) AS rows FROM stg_orders WHERE status NOT IN ('Processing', 'Shipped',"
            " 'Complete', 'Unknown') GROUP BY 1"
        ),
        "dq_relationships": full(orphan.format(c="user_id", t="stg_orders", k="user_id", p="stg_users")),
        "dq_freshness": full(
            "SELECT source_table, latest_change_at, age_hours, CASE WHEN age_hours > e THEN 'error' WHEN age_hours > w"
            " THEN 'warn' ELSE 'pass' END AS status FROM (SELECT *, (epoch_us("
            f"{AS_OF}) - epoch_us(latest_change_at)) / 3600000000 AS age_hours FROM ({newest})"
            f" JOIN (VALUES {limits}) AS l(source_table, w, e) USING (source_table))",
            real="age_hours",
        ),
        "dq_future_dates": full(
            f"SELECT 'orders' AS source_table, order_id AS record_id, created_at AS timestamp_value FROM stg_orders WHERE {future}"
            f" UNION ALL SELECT 'order_items', order_item_id, created_at FROM stg_order_items WHERE {future}"
            f" UNION ALL SELECT 'users', user_id, created_at FROM stg_users WHERE {future}"
        ),
        "dq_item_count_match": full(
            "SELECT order_id, num_of_item AS declared_item_count, coalesce(n, 0) AS actual_item_count,"
            " num_of_item - coalesce(n, 0) AS discrepancy FROM stg_orders LEFT JOIN"
            " (SELECT order_id, count(*) AS n FROM stg_order_items GROUP BY 1) USING (order_id)"
            " WHERE num_of_item <> coalesce(n, 0)"
        ),
        "dq_positive_prices": full(
            "SELECT 'order_items' AS source_table, id AS record_id, sale_price AS price_value FROM b_order_items"
            " WHERE sale_price < 0"
            " UNION ALL SELECT 'products', product_id, cost FROM stg_products WHERE cost < 0"
            " UNION ALL SELECT 'products', product_id, retail_price FROM stg_products WHERE retail_price < 0",
            real="price_value",
        ),
        "dq_revenue_consistency": full(
            "SELECT order_id, s AS sales_total_revenue, t AS total_revenue, abs(s - t) AS revenue_diff FROM"
            " (SELECT order_id, sum(sale_price) AS s FROM fact_order_items GROUP BY 1) JOIN"
            " (SELECT order_id, total_revenue + CASE WHEN order_id % 100 = 0 THEN 1 ELSE 0 END AS t FROM fact_orders)"
            " USING (order_id) WHERE abs(s - t) > 0.01",
            "sales_total_revenue total_revenue revenue_diff",
        ),
        "dq_status_transitions": full(
            "SELECT order_id, status, created_at, shipped_at, delivered_at, returned_at FROM stg_orders WHERE"
            " shipped_at < created_at OR delivered_at < shipped_at OR returned_at < delivered_at"
            " OR (status = 'Complete' AND delivered_at IS NULL) OR (status = 'Returned' AND returned_at IS NULL)"
        ),
        "dq_events_profile": full(
            "SELECT count(*) AS total_rows, count(DISTINCT event_id) AS unique_events, min(event_timestamp) AS"
            " min_timestamp, max(event_timestamp) AS max_timestamp, count(DISTINCT session_id) AS unique_sessions,"
            " count(DISTINCT user_id) AS unique_users, count(*) FILTER (user_id IS NULL) AS null_users,"
            " count(*) FILTER (product_id IS NULL AND event_type IN ('product', 'cart', 'purchase'))"
            " AS null_products_in_product_events,"
            " count(*) FILTER (product_name IS NULL AND product_id IS NOT NULL) AS failed_enrichments,"
            " count(*) FILTER (city IS NULL) AS null_city,"
            " count(*) FILTER (traffic_source IS NULL) AS null_traffic_source FROM events_raw"
        ),
        "dq_event_distribution": full("SELECT event_type, count(*) AS rows FROM events_raw GROUP BY 1"),
        "dq_deadletter_distribution": full("SELECT error_message, count(*) AS rows FROM events_deadletter GROUP BY 1"),
        "dq_enrichment_samples": full(
            "SELECT product_id, product_name, product_category, count(*) AS rows FROM events_raw WHERE product_id IS NOT"
            " NULL GROUP BY ALL ORDER BY rows DESC, product_id LIMIT 10"
        ),
        "dq_staging_report": _report("staging"),
        "dq_mart_report": _report("mart"),
    }


def _jobs() -> dict[str, str]:
    snapshot = "1700000000000::BIGINT AS cdc_timestamp, 'r' AS cdc_operation"
    first = "b_orders WHERE cdc_operation = 'c'"
    return {
        "src_cdc_stream": full(
            "SELECT 'server.demo.events' AS topic, make_timestamp(cdc_timestamp * 1000)::DATE AS day, count(*) AS messages"
            " FROM b_events GROUP BY ALL"
        ),
        "src_clickstream": full(
            "SELECT (ts + to_seconds((event_id % 7 + delay + 1)::INT))::DATE AS day, count(*) AS messages"
            " FROM visits, (VALUES (0), (7200)) AS d(delay) WHERE delay = 0 OR event_id % 25 = 1 GROUP BY ALL"
        ),
        "sink_hot_events": full("SELECT * FROM b_events"),
        "sink_cold_parquet": full("SELECT * FROM b_events"),
        "src_hive_parquet": full(
            "SELECT date_trunc('month', make_timestamp(cdc_timestamp * 1000))::DATE AS date, count(*) AS changes,"
            " count(DISTINCT order_id) AS orders FROM b_orders GROUP BY 1"
        ),
        "sink_raw_replay": full(
            "SELECT unnest(['table', 'archive']) AS copy, 'server.demo.events' AS topic, n AS messages"
            " FROM (SELECT count(*) AS n FROM b_events)"
        ),
        "sink_append_table": full(
            "SELECT event_date, event_type, count(*) AS events FROM clicks"
            " WHERE event_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-14' GROUP BY ALL"
        ),
        "st_stream_split": full(
            "SELECT 'valid' AS outcome, count(*) AS messages FROM clicks"
            " UNION ALL SELECT error_message, count(*) FROM events_deadletter GROUP BY 1"
        ),
        "st_counters": full(
            "SELECT (SELECT count(*) FROM clicks) AS valid_events,"
            " (SELECT count(*) FROM events_deadletter) AS invalid_events"
        ),
        "st_counters_by_batch": full(
            f"SELECT batch_id, valid_events, invalid_events, coalesce(n, 0) AS enriched_events,"
            f" valid_events - coalesce(n, 0) AS duplicate_events, coalesce(late, 0) AS late_events"
            f" FROM (SELECT batch_id, count(*) FILTER (valid) AS valid_events, count(*) FILTER (NOT valid) AS invalid_events"
            f"       FROM ({_DELIVERED}) GROUP BY 1)"
            f" LEFT JOIN (SELECT batch_id, count(*) AS n, count(missed_watermark) AS late FROM ({_kept(3 * 86_400)}) GROUP BY 1)"
            f" USING (batch_id)"
        ),
        "st_lateness": full(_kept(3600)),
        "st_late_repair": full("SELECT * EXCLUDE (version_emitted_at) FROM events_5m", real="avg_event_lag_seconds"),
        "st_panes": full(f"SELECT * FROM ({_panes(2 * 86_400)})", real="avg_event_lag_seconds"),
        "st_session_batches": full(
            "SELECT * EXCLUDE (version_emitted_at, processed_at)"
            f" FROM ({session_metrics('(' + _punctual(2 * 86_400) + ')')})",
            real="session_duration_seconds",
        ),
        "st_stream_dedup": full(
            "SELECT DISTINCT event_id, session_id, event_type, page_type, product_id, product_name, is_conversion"
            " FROM events_raw"
        ),
        "st_stream_5m": full("SELECT * EXCLUDE (version_emitted_at) FROM events_5m", real="avg_event_lag_seconds"),
        "st_session_early": full(
            "SELECT * EXCLUDE (version_emitted_at, processed_at) FROM session_metrics", real="session_duration_seconds"
        ),
        "inc_upsert": full(
            "SELECT order_id, CASE WHEN created_at < TIMESTAMP '2000-07-01' THEN lower(status) ELSE status END AS status,"
            " created_at, num_of_item FROM stg_orders"
        ),
        "snap_replace": full(f"SELECT id, retail_price, {snapshot} FROM b_products WHERE cdc_operation = 'c'", real="retail_price"),
        "src_jdbc_full": full(f"SELECT * REPLACE ({snapshot.replace('::BIGINT', '')}) FROM {first}"),
        "src_jdbc_initial": full(
            "SELECT order_id, status, CASE WHEN order_id % 10 <> 0 THEN created_at ELSE TIMESTAMP '2024-02-01' END AS"
            " created_at, CASE WHEN order_id % 4 <> 0 THEN shipped_at END AS shipped_at, 'c' AS cdc_operation,"
            f" 1700000000000::BIGINT AS cdc_timestamp FROM {first}"
        ),
        "src_csv_shift": full(
            "SELECT order_id, user_id, status, created_at + INTERVAL 5 YEAR AS created_at,"
            f" shipped_at + INTERVAL 5 YEAR AS shipped_at FROM {first}"
        ),
        "src_product_lookup": full(
            "SELECT id AS product_id, category AS product_category, department AS product_department,"
            " name AS product_name FROM b_products WHERE cdc_operation = 'c'"
        ),
    }


def _report(which: str) -> str:
    """The declared checks as one statement; their list is data shared with the library."""
    from tidemark.plans.checks import MART_CHECKS, STAGING_CHECKS

    parts = []
    for c in STAGING_CHECKS if which == "staging" else MART_CHECKS:
        if c.kind == "unique":
            sql = (
                f"SELECT count(*) AS n FROM (SELECT {c.column} FROM {c.model} WHERE {c.column} IS NOT NULL GROUP BY 1"
                " HAVING count(*) > 1)"
            )
        elif c.kind == "not_null":
            sql = f"SELECT count(*) FILTER ({c.column} IS NULL) AS n FROM {c.model}"
        elif c.kind == "accepted":
            values = ", ".join(f"'{v}'" for v in c.accepted)
            sql = f"SELECT count(*) FILTER ({c.column} NOT IN ({values})) AS n FROM {c.model}"
        else:
            sql = (
                f"SELECT count(*) AS n FROM {c.model} x WHERE {c.column} IS NOT NULL AND NOT EXISTS"
                f" (SELECT 1 FROM {c.parent} y WHERE y.{c.parent_column} = x.{c.column})"
            )
        parts.append(
            f"SELECT '{c.name}' AS check_name, '{c.model}' AS model, '{c.column}' AS column_name,"
            f" '{c.severity}' AS severity, n AS violations, CASE WHEN n > 0 THEN '{c.severity}' ELSE 'pass' END AS status"
            f" FROM ({sql})"
        )
    return full(" UNION ALL ".join(parts))


def oracles() -> dict[str, str]:
    return {
        **_models(), **_cdc(), **_stream_forms(), **_sales(), **_inventory(), **_clickboard(), **_sessionboard(),
        **_display(), **_checks(), **_jobs(),
        # An incremental build ends with the rows of the full one.
        **{f"inc_{n}": sql for n, sql in _models().items() if n.startswith(("fact_", "agg_"))},
    }
