"""DuckDB forms of the staging models, marts and clickstream tables as named queries."""

AS_OF = "TIMESTAMP '2001-10-01'"
CLICK_AS_OF = "TIMESTAMP '2024-02-01'"
MONEY = "DECIMAL(38, 9)"
NO_KEY = "md5('c0:-1')"


def latest(source: str, key: str, where: str = "TRUE") -> str:
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY cdc_timestamp DESC) AS rn"
        f" FROM {source} WHERE {where}) WHERE rn = 1"
    )


LIVE = "cdc_operation <> 'd'"

MODELS: dict[str, str] = {}

MODELS["stg_distribution_centers"] = f"""
SELECT id AS distribution_center_id, name AS distribution_center_name, latitude, longitude, cdc_timestamp, cdc_operation
FROM ({latest('b_distribution_centers', 'id')})"""

MODELS["stg_events"] = f"""
SELECT id AS event_id, user_id, sequence_number, session_id, ip_address, coalesce(city, 'Unknown') AS city, state,
       postal_code, browser, traffic_source, event_type, coalesce(uri, 'N/A') AS uri, created_at, cdc_timestamp,
       cdc_operation
FROM ({latest('b_events', 'id', LIVE)})"""

MODELS["stg_inventory_items"] = f"""
SELECT id AS inventory_item_id, product_id, created_at, sold_at, cost::{MONEY} AS cost, product_category, product_name,
       product_brand, product_retail_price::{MONEY} AS product_retail_price, product_department, product_sku,
       product_distribution_center_id, cdc_timestamp, cdc_operation
FROM ({latest('b_inventory_items', 'id')})"""

MODELS["stg_order_items"] = f"""
SELECT id AS order_item_id, order_id, user_id, product_id, inventory_item_id, status, created_at, shipped_at,
       delivered_at, returned_at, sale_price::{MONEY} AS sale_price, cdc_timestamp, cdc_operation
FROM ({latest('b_order_items', 'id', LIVE + ' AND sale_price >= 0')})"""

MODELS["stg_orders"] = f"""
SELECT order_id, user_id, status, gender, created_at, shipped_at, delivered_at, returned_at, num_of_item,
       cdc_timestamp, cdc_operation
FROM ({latest('b_orders', 'order_id', LIVE)})"""

MODELS["stg_products"] = f"""
SELECT id AS product_id, cost::{MONEY} AS cost, category, name AS product_name, brand,
       retail_price::{MONEY} AS retail_price, department, sku, distribution_center_id, cdc_timestamp, cdc_operation,
       make_timestamp(cdc_timestamp * 1000) AS source_updated_at
FROM ({latest('b_products', 'id')})"""

MODELS["stg_users"] = f"""
SELECT id AS user_id, first_name, last_name, email, age, gender, street_address, postal_code, city, state, country,
       latitude, longitude, traffic_source, created_at, coalesce(updated_at, created_at) AS updated_at,
       cdc_timestamp, cdc_operation
FROM ({latest('b_users', 'id')})"""


def date_key(column: str) -> str:
    return f"strftime({column}, '%Y%m%d')::BIGINT"


MODELS["dim_date"] = f"""
SELECT {date_key('d')} AS date_key, d AS full_date, day(d) AS day_of_month, dayofweek(d) + 1 AS day_of_week,
       dayname(d) AS day_name, strftime(d, '%U')::INT AS week_of_year, week(d) AS iso_week_of_year,
       month(d) AS month_of_year, monthname(d) AS month_name, quarter(d) AS quarter_of_year, year(d) AS year_number,
       isoyear(d) AS iso_year_number, NULL::TIMESTAMP AS source_updated_at, {AS_OF} AS dwh_updated_at,
       dayofweek(d) IN (0, 6) AS is_weekend
FROM (SELECT unnest(generate_series(lo::TIMESTAMP, hi::TIMESTAMP, INTERVAL 1 DAY))::DATE AS d
      FROM (SELECT min(t)::DATE AS lo, max(t)::DATE AS hi
            FROM (SELECT o_orderdate AS t FROM orders UNION ALL SELECT l_shipdate FROM lineitem
                  UNION ALL SELECT ts FROM events)))
UNION ALL
SELECT 0, DATE '1970-01-01', 0, 0, 'Unknown', 0, 0, 0, 'Unknown', 0, 0, 0, NULL, {AS_OF}, FALSE"""

MODELS["dim_distribution_centers"] = f"""
SELECT md5('c0:' || distribution_center_id) AS dc_key, distribution_center_id, distribution_center_name, latitude,
       longitude, NULL::TIMESTAMP AS source_updated_at, {AS_OF} AS dwh_updated_at
FROM stg_distribution_centers
UNION ALL SELECT {NO_KEY}, -1, 'Unknown Distribution Center', 0, 0, NULL, {AS_OF}"""

MODELS["dim_products"] = f"""
SELECT md5('c0:' || product_id) AS product_key, product_id, product_name, category, brand, department, sku,
       retail_price, cost, retail_price - cost AS margin_value, distribution_center_id, source_updated_at,
       {AS_OF} AS dwh_updated_at
FROM stg_products
UNION ALL
SELECT {NO_KEY}, -1, 'Unknown Product', 'Unknown', 'Unknown', 'Unknown', 'N/A', 0, 0, 0, -1, TIMESTAMP '1970-01-01',
       {AS_OF}"""

MODELS["dim_users"] = f"""
SELECT md5('c0:' || user_id) AS user_key, user_id, first_name, last_name, email, age,
       CASE WHEN age IS NULL THEN 'Unknown' WHEN age < 18 THEN 'Under 18' WHEN age < 60 THEN 'Adult'
            ELSE 'Senior' END AS age_group,
       gender, street_address, postal_code, city, state, country, latitude, longitude, traffic_source, created_at,
       updated_at AS source_updated_at, {AS_OF} AS dwh_updated_at
FROM stg_users
UNION ALL
SELECT {NO_KEY}, -1, 'Unknown', 'Unknown', 'unknown@example.com', NULL, 'Unknown', 'Unknown', 'Unknown', 'N/A',
       'Unknown', 'Unknown', 'Unknown', 0, 0, 'Unknown', TIMESTAMP '1970-01-01', TIMESTAMP '1970-01-01', {AS_OF}"""

MODELS["fact_events"] = f"""
SELECT e.event_id, coalesce(u.user_key, {NO_KEY}) AS user_key, e.user_id, e.sequence_number, e.session_id,
       {date_key('e.created_at')} AS created_date_key, e.ip_address, e.city, e.state, e.postal_code, e.browser,
       e.traffic_source, e.event_type, lower(trim(e.event_type)) = 'purchase' AS is_checkout_event, e.uri,
       e.created_at AS source_updated_at, {AS_OF} AS dwh_updated_at, e.created_at
FROM stg_events e LEFT JOIN dim_users u USING (user_id)"""

MODELS["fact_inventory"] = f"""
SELECT i.inventory_item_id, coalesce(p.product_key, {NO_KEY}) AS product_key, i.product_id,
       coalesce(c.dc_key, {NO_KEY}) AS dc_key, i.product_distribution_center_id AS distribution_center_id,
       {date_key('i.created_at')} AS created_date_key, coalesce({date_key('i.sold_at')}, 0) AS sold_date_key,
       i.created_at, i.sold_at, i.cost, coalesce(i.sold_at, i.created_at) AS source_updated_at,
       {AS_OF} AS dwh_updated_at,
       CASE WHEN i.sold_at IS NOT NULL THEN 'Sold' WHEN i.created_at < {AS_OF} - INTERVAL 180 DAY THEN 'Slow-Moving'
            ELSE 'Available' END AS inventory_status,
       i.sold_at IS NOT NULL AS is_sold, date_sub('day', i.created_at, i.sold_at) AS days_in_inventory
FROM stg_inventory_items i LEFT JOIN dim_products p USING (product_id)
LEFT JOIN dim_distribution_centers c ON i.product_distribution_center_id = c.distribution_center_id"""

MODELS["fact_order_items"] = f"""
SELECT *, sale_price - cost AS profit,
       CASE WHEN sale_price = 0 THEN 0 ELSE (sale_price - cost)::DOUBLE / sale_price::DOUBLE END AS margin_percentage
FROM (SELECT t.order_item_id, t.order_id, coalesce(u.user_key, {NO_KEY}) AS user_key, t.user_id,
             coalesce(p.product_key, {NO_KEY}) AS product_key, t.product_id,
             coalesce(t.inventory_item_id, -1) AS inventory_item_id, coalesce(c.dc_key, {NO_KEY}) AS dc_key,
             {date_key('t.created_at')} AS created_date_key, coalesce({date_key('t.shipped_at')}, 0) AS shipped_date_key,
             coalesce({date_key('t.delivered_at')}, 0) AS delivered_date_key,
             coalesce({date_key('t.returned_at')}, 0) AS returned_date_key, t.status,
             t.status IN ('Returned', 'Cancelled') AS is_returned, t.created_at, t.shipped_at, t.delivered_at,
             t.returned_at, t.sale_price, coalesce(i.cost, p.cost, 0) AS cost,
             coalesce(t.returned_at, t.delivered_at, t.shipped_at, t.created_at) AS source_updated_at,
             {AS_OF} AS dwh_updated_at
      FROM stg_order_items t LEFT JOIN stg_inventory_items i USING (inventory_item_id)
      LEFT JOIN dim_users u ON t.user_id = u.user_id LEFT JOIN dim_products p ON t.product_id = p.product_id
      LEFT JOIN dim_distribution_centers c ON i.product_distribution_center_id = c.distribution_center_id)"""

MODELS["fact_orders"] = f"""
SELECT o.order_id, coalesce(u.user_key, {NO_KEY}) AS user_key, o.user_id, o.status,
       {date_key('o.created_at')} AS created_date_key, coalesce({date_key('o.shipped_at')}, 0) AS shipped_date_key,
       coalesce({date_key('o.delivered_at')}, 0) AS delivered_date_key,
       coalesce({date_key('o.returned_at')}, 0) AS returned_date_key, o.created_at, o.shipped_at, o.delivered_at,
       o.returned_at, o.num_of_item,
       coalesce(o.returned_at, o.delivered_at, o.shipped_at, o.created_at) AS source_updated_at,
       {AS_OF} AS dwh_updated_at, coalesce(s.revenue, 0) AS total_revenue, coalesce(s.cost, 0) AS total_cost,
       coalesce(s.margin, 0) AS gross_margin,
       CASE WHEN coalesce(s.revenue, 0) = 0 THEN 0 ELSE s.margin::DOUBLE / s.revenue::DOUBLE END AS margin_percentage,
       date_sub('day', o.created_at, o.shipped_at) AS shipping_duration_days,
       date_sub('day', o.shipped_at, o.delivered_at) AS delivery_duration_days,
       date_sub('day', o.created_at, o.delivered_at) AS order_duration_days,
       CASE WHEN o.num_of_item = 1 THEN 'Single' ELSE 'Multi' END AS order_type,
       coalesce(date_sub('day', o.shipped_at, o.delivered_at) > 5, FALSE) AS is_delayed, o.cdc_timestamp
FROM stg_orders o LEFT JOIN dim_users u USING (user_id)
LEFT JOIN (SELECT order_id, sum(sale_price) AS revenue, sum(cost) AS cost, sum(profit) AS margin
           FROM fact_order_items GROUP BY ALL) s ON o.order_id = s.order_id"""

MODELS["agg_dashboard_daily"] = f"""
SELECT date, coalesce(revenue, 0) AS revenue, coalesce(cost, 0) AS cost, coalesce(margin, 0) AS margin,
       coalesce(orders, 0) AS orders, coalesce(total_users, 0) AS total_users,
       coalesce(total_sessions, 0) AS total_sessions, coalesce(purchase_sessions, 0) AS purchase_sessions,
       greatest(coalesce(o.changed, TIMESTAMP '1970-01-01'), coalesce(e.changed, TIMESTAMP '1970-01-01'))
         AS source_updated_at,
       {AS_OF} AS dwh_updated_at, coalesce(purchase_sessions::DOUBLE / nullif(total_sessions, 0), 0) AS purchase_cvr
FROM (SELECT created_at::DATE AS date, sum(total_revenue) AS revenue, sum(total_cost) AS cost,
             sum(gross_margin) AS margin, count(DISTINCT order_id) AS orders, max(source_updated_at) AS changed
      FROM fact_orders GROUP BY 1) o
FULL JOIN (SELECT created_at::DATE AS date, count(DISTINCT user_id) AS total_users,
                  count(DISTINCT session_id) AS total_sessions,
                  count(DISTINCT session_id) FILTER (is_checkout_event) AS purchase_sessions,
                  max(source_updated_at) AS changed
           FROM fact_events GROUP BY 1) e USING (date)"""

MODELS["agg_user_stats"] = f"""
SELECT u.user_id, min(o.created_at) AS first_purchase_date, max(o.created_at) AS latest_purchase_date,
       count(DISTINCT o.order_id) AS total_orders, coalesce(sum(o.total_revenue), 0) AS lifetime_value,
       CASE count(DISTINCT o.order_id) WHEN 0 THEN 'Potential' WHEN 1 THEN 'New' ELSE 'Returning' END
         AS customer_status,
       max(coalesce(o.source_updated_at, u.source_updated_at)) AS source_updated_at, {AS_OF} AS dwh_updated_at
FROM dim_users u LEFT JOIN fact_orders o USING (user_id) WHERE u.user_id <> -1 GROUP BY u.user_id"""

# Clickstream tables.
MODELS["events_raw"] = """
SELECT c.*, CASE WHEN uri IS NULL THEN 'unknown' WHEN uri = '/' THEN 'home'
                 WHEN split_part(uri, '/', 2) = 'cancel' THEN 'post_purchase' ELSE split_part(uri, '/', 2) END AS page_type,
       CASE WHEN uri LIKE '/product/%' THEN split_part(uri, '/', 3)::BIGINT END AS product_id,
       p.category AS product_category, p.department AS product_department, p.product_name,
       c.event_type = 'purchase' AS is_conversion, ingested_at + INTERVAL 2 SECOND AS processing_time,
       greatest(0, (epoch_us(ingested_at) - epoch_us(event_timestamp)) / 1000000) AS event_lag_seconds
FROM clicks c LEFT JOIN stg_products p
  ON CASE WHEN uri LIKE '/product/%' THEN split_part(uri, '/', 3)::BIGINT END = p.product_id"""

MODELS["events_first"] = """
SELECT * FROM events_raw QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ingested_at) = 1"""

MODELS["events_5m"] = """
SELECT strftime(window_start, '%Y-%m-%dT%H:%M:%S+00:00') || '|' || event_date || '|' || coalesce(traffic_source, '')
         || '|' || coalesce(browser, '') || '|' || event_type || '|' || page_type AS aggregate_id,
       window_start, window_start + INTERVAL 5 MINUTE AS window_end, event_date, traffic_source, browser, event_type,
       page_type, count(*) AS total_events, count(DISTINCT session_id) AS unique_sessions,
       count(DISTINCT user_id) AS unique_users, count(*) FILTER (is_conversion) AS purchase_events,
       sum(event_lag_seconds) / count(event_lag_seconds) AS avg_event_lag_seconds,
       window_start + INTERVAL 15 MINUTE AS version_emitted_at
FROM (SELECT *, time_bucket(INTERVAL 5 MINUTE, event_timestamp) AS window_start FROM events_first)
GROUP BY ALL"""


def session_metrics(source: str, gap: str = "INTERVAL 30 MINUTE", limit: str = "TRUE") -> str:
    return f"""
SELECT session_id AS session_record_id, session_id, first(user_id ORDER BY event_timestamp, event_id) AS user_id,
       first(traffic_source ORDER BY event_timestamp, event_id) AS traffic_source,
       first(browser ORDER BY event_timestamp, event_id) AS browser,
       min(event_timestamp) AS session_start, max(event_timestamp) AS session_end,
       (epoch_us(max(event_timestamp)) - epoch_us(min(event_timestamp))) / 1000000 AS session_duration_seconds,
       count(*) AS event_count,
       count(*) FILTER (page_type IN ('home', 'department', 'category', 'product')) AS pageview_count,
       count(*) FILTER (page_type = 'product') AS product_view_count,
       count(*) FILTER (event_type = 'cart') AS cart_count,
       count(*) FILTER (event_type = 'purchase') AS purchase_count, bool_or(page_type = 'home') AS saw_home,
       bool_or(page_type = 'product') AS saw_product, bool_or(event_type = 'cart') AS added_to_cart,
       bool_or(event_type = 'purchase') AS purchased,
       first(product_category ORDER BY (product_category IS NULL), n_category DESC, first_category)
         AS top_category,
       min(event_timestamp)::DATE AS session_date, max(event_timestamp) + {gap} AS version_emitted_at,
       max(event_timestamp) + {gap} AS processed_at
FROM (SELECT *, count(*) OVER c AS n_category, min(event_timestamp) OVER c AS first_category
      FROM (SELECT *, row_number() OVER (PARTITION BY session_id, no ORDER BY event_timestamp, event_id) AS nth
            FROM (SELECT *, sum(opens) OVER (PARTITION BY session_id ORDER BY event_timestamp, event_id
                                             RANGE UNBOUNDED PRECEDING) AS no
                  FROM (SELECT *, CASE WHEN event_timestamp - lag(event_timestamp) OVER
                                         (PARTITION BY session_id ORDER BY event_timestamp, event_id) < {gap}
                                       THEN 0 ELSE 1 END AS opens FROM {source})))
      WHERE {limit} WINDOW c AS (PARTITION BY session_id, no, product_category))
GROUP BY session_id, no"""


MODELS["session_metrics"] = session_metrics("events_first")

MODELS["v_events_raw_dedup"] = """
SELECT * FROM events_raw
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ingested_at DESC, processing_time DESC) = 1"""
MODELS["v_events_5m_latest"] = """
SELECT * FROM events_5m QUALIFY row_number() OVER (PARTITION BY aggregate_id ORDER BY version_emitted_at DESC) = 1"""
MODELS["v_session_metrics_latest"] = """
SELECT * FROM session_metrics
QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY version_emitted_at DESC, session_start DESC) = 1"""
