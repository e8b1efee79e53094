"""DuckDB forms of the sample rules (tidemark/sources/sample.py) as named queries."""

VERSIONS = "(VALUES ('c', 0), ('u', 1), ('d', 2)) AS v(op, vday)"


def _versions(key: str) -> str:
    return f"(op = 'c' OR (op = 'u' AND ({key}) % 3 = 0) OR (op = 'd' AND ({key}) % 97 = 0))"


CHANNELS = "['Search', 'Organic', 'Email', 'Facebook', 'Display']"
BROWSERS = "['Chrome', 'Firefox', 'Safari', 'IE', 'Other']"
DAY0 = "TIMESTAMP '1995-01-01'"



def _cents(column: str) -> str:
    return f"floor({column} * 100 + 0.5)::BIGINT"


def _line_half(factor: int) -> str:
    half = "0::BIGINT"
    for value in (
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", _cents("l_quantity"), _cents("l_extendedprice"),
        _cents("l_discount"), _cents("l_tax"), "ascii(l_returnflag)", "ascii(l_linestatus)", "epoch_us(l_shipdate) // 1000000",
    ):
        half = f"(({half} * {factor} + {value}) % 2147483647)"
    return half


LINE_ID = f"{_line_half(1000003)} * 2147483648 + {_line_half(69069)}"

BRONZE: dict[str, str] = {}

BRONZE["b_users"] = f"""
SELECT c_custkey AS id, c_name AS first_name, c_mktsegment AS last_name,
       'user' || c_custkey || '@example.com' AS email,
       CASE WHEN c_custkey % 41 <> 0 THEN 15 + c_custkey % 60 END AS age,
       CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
       'State ' || n_nationkey AS state, c_custkey || ' Main Street' AS street_address,
       'P' || (c_custkey % 1000) AS postal_code, n_name AS city, r_name AS country,
       (n_nationkey * 7 - 84)::DOUBLE AS latitude, (n_nationkey * 13 - 150)::DOUBLE AS longitude,
       {CHANNELS}[((c_custkey + CASE WHEN op = 'c' THEN 0 ELSE 1 END) % 5) + 1] AS traffic_source,
       {DAY0} + to_days((c_custkey % 2000)::INT) AS created_at,
       CASE WHEN c_custkey % 5 <> 0
            THEN {DAY0} + to_days((c_custkey % 2000)::INT) + to_days((30 + vday)::INT) END AS updated_at,
       (epoch_us({DAY0} + to_days((c_custkey % 2000)::INT)) // 1000) + vday * 86400000 AS cdc_timestamp, op AS cdc_operation
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey, {VERSIONS}
WHERE {_versions('c_custkey')}"""

BRONZE["b_products"] = f"""
SELECT p_partkey AS id, cents * 60 / 10000 AS cost, p_type AS category, p_name AS name,
       CASE WHEN p_partkey % 50 = 0 THEN '  ' ELSE p_brand END AS brand,
       CASE WHEN op = 'c' THEN cents / 100 ELSE cents * 110 / 10000 END AS retail_price,
       CASE WHEN p_size % 2 = 0 THEN 'Men' ELSE 'Women' END AS department,
       'SKU-' || p_partkey AS sku, p_partkey % 10 AS distribution_center_id,
       base_at + to_days(vday) AS updated_at,
       (epoch_us(base_at) // 1000) + vday * 86400000 AS cdc_timestamp, op AS cdc_operation
FROM (SELECT *, floor(p_retailprice * 100 + 0.5)::BIGINT AS cents,
             {DAY0} + to_days((p_partkey % 365)::INT) AS base_at FROM part), {VERSIONS}
WHERE {_versions('p_partkey')}"""

BRONZE["b_distribution_centers"] = f"""
SELECT s_suppkey AS id, CASE WHEN op = 'c' THEN s_name ELSE s_name || ' (moved)' END AS name,
       (s_nationkey * 3 - 30)::DOUBLE AS latitude, (s_nationkey * 11 - 120)::DOUBLE AS longitude,
       (epoch_us({DAY0}) // 1000) + vday * 86400000 AS cdc_timestamp, op AS cdc_operation
FROM supplier, {VERSIONS} WHERE {_versions('s_suppkey')}"""

BRONZE["b_orders"] = f"""
SELECT order_id, user_id, status, gender, created_at, updated_at,
       CASE WHEN status = 'Returned' AND order_id % 70 <> 0 THEN delivered_at + INTERVAL 3 DAY END AS returned_at,
       shipped_at, delivered_at, num_of_item, cdc_timestamp, cdc_operation
FROM (SELECT *, CASE WHEN status IN ('Complete', 'Returned') AND order_id % 53 <> 0
                     THEN shipped_at + to_days((order_id % 9)::INT) END AS delivered_at
      FROM (SELECT *, CASE WHEN status IN ('Processing', 'Cancelled') THEN NULL
                           WHEN order_id % 211 = 0 THEN created_at - INTERVAL 1 DAY
                           ELSE created_at + to_days((order_id % 4 + vday)::INT) END AS shipped_at
            FROM (SELECT o_orderkey AS order_id,
                         o_custkey + CASE WHEN o_custkey % 89 = 0 THEN 1000000000 ELSE 0 END AS user_id,
                         CASE WHEN o_orderkey % 11 = 0 THEN 'Cancelled' WHEN o_orderkey % 10 = 0 THEN 'Returned'
                              WHEN o_orderstatus = 'F' THEN 'Complete' WHEN o_orderstatus = 'O' THEN 'Processing'
                              ELSE 'Shipped' END AS status,
                         CASE WHEN o_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
                         o_orderdate AS created_at, o_orderdate + to_days(vday) AS updated_at, vday,
                         1 + o_orderkey % 7 AS num_of_item,
                         (epoch_us(o_orderdate) // 1000) + vday * 86400000 AS cdc_timestamp, op AS cdc_operation
                  FROM orders, {VERSIONS} WHERE {_versions('o_orderkey')})))"""

BRONZE["lines"] = f"""
SELECT *, {LINE_ID} AS line_id, {_cents('l_extendedprice')} AS cents, {_cents('l_discount')} AS disc,
       l_partkey + CASE WHEN l_partkey % 101 = 0 THEN 1000000000 ELSE 0 END AS item_product,
       CASE WHEN l_returnflag = 'R' THEN 'Returned' WHEN l_returnflag = 'A' THEN 'Complete'
            WHEN l_linestatus = 'O' THEN 'Processing' ELSE 'Shipped' END AS status
FROM lineitem"""

BRONZE["b_order_items"] = f"""
SELECT line_id AS id, l_orderkey AS order_id,
       l_suppkey + CASE WHEN l_suppkey % 37 = 0 THEN 1000000000 ELSE 0 END AS user_id,
       item_product AS product_id, CASE WHEN l_linenumber <> 5 THEN line_id END AS inventory_item_id, status,
       l_shipdate AS created_at, l_shipdate + to_days(vday) AS updated_at,
       CASE WHEN status <> 'Processing' THEN l_shipdate + INTERVAL 1 DAY END AS shipped_at,
       CASE WHEN status IN ('Complete', 'Returned') THEN l_shipdate + to_days((2 + l_orderkey % 9)::INT) END
         AS delivered_at,
       CASE WHEN status = 'Returned' THEN l_shipdate + to_days((7 + l_orderkey % 9)::INT) END AS returned_at,
       CASE WHEN l_orderkey % 499 = 0 THEN -1.0::DOUBLE
            WHEN l_orderkey % 50 = 0 AND l_linenumber = 3 THEN 0.0::DOUBLE
            WHEN op = 'c' THEN cents * (100 - disc) / 10000 ELSE cents * (100 - disc) * 9 // 10 / 10000 END AS sale_price,
       (epoch_us(l_shipdate) // 1000) + vday * 86400000 AS cdc_timestamp, op AS cdc_operation
FROM lines, {VERSIONS} WHERE {_versions('line_id')}"""

_STOCK = """product_id, created_at, sold_at, cost, 'Category ' || (part % 25) AS product_category,
       'Product ' || part AS product_name, 'Brand ' || (part % 40) AS product_brand,
       (900 + part % 1000)::DOUBLE AS product_retail_price,
       CASE WHEN part % 2 = 0 THEN 'Men' ELSE 'Women' END AS product_department, 'SKU-' || part AS product_sku,
       center AS product_distribution_center_id,
       (epoch_us(created_at) // 1000) + vday * 86400000 AS cdc_timestamp, op AS cdc_operation"""

BRONZE["b_inventory_items"] = f"""
SELECT id, {_STOCK}
FROM (SELECT line_id AS id, item_product AS product_id, l_partkey AS part,
             l_shipdate - to_days((l_partkey % 120)::INT) AS created_at,
             l_shipdate + to_days((l_orderkey % 50 + vday)::INT) AS sold_at,
             (cents * 55 // 100) / 100 AS cost,
             l_suppkey + CASE WHEN l_suppkey % 41 = 0 THEN 1000000000 ELSE 0 END AS center, vday, op
      FROM lines, {VERSIONS} WHERE {_versions('line_id')}
      UNION ALL
      SELECT -10 - p_partkey, p_partkey, p_partkey, TIMESTAMP '2001-01-01' + to_days((p_partkey % 270)::INT),
             NULL, floor(p_retailprice * 100 + 0.5)::BIGINT * 60 / 10000, p_partkey % 10, vday, op
      FROM part, {VERSIONS} WHERE {_versions('-10 - p_partkey')})"""

BRONZE["visits"] = f"""
SELECT event_id, user_id, ts, event_id % 20 AS sequence_number,
       user_id || '-' || strftime(ts, '%Y%m%d') AS session_id, '10.0.0.' || (user_id % 256) AS ip_address,
       CASE WHEN user_id % 19 <> 0 THEN 'City ' || (user_id % 30) END AS city, 'State ' || (user_id % 12) AS state,
       'P' || (user_id % 1000) AS postal_code, {BROWSERS}[(event_id % 5) + 1] AS browser,
       CASE WHEN user_id % 17 = 0 THEN ' ' ELSE {CHANNELS}[(user_id % 5) + 1] END AS traffic_source,
       CASE WHEN event_id % 37 = 0 THEN NULL WHEN kind = 'home' THEN '/'
            WHEN kind = 'cancel' THEN '/cancel/item/' || k WHEN kind = 'category' THEN '/category/' || k
            WHEN kind = 'department' THEN '/department/Men/category/Jeans%20%26%20Co' ELSE '/product/' || k END AS uri,
       kind AS event_type, k
FROM (SELECT *, regexp_extract(props, '([0-9]+)', 1) AS k,
             CASE WHEN event_id % 29 = 0 THEN 'cancel' WHEN event_id % 31 = 0 THEN 'department'
                  WHEN event_type = 'view' THEN 'product' WHEN event_type = 'click' THEN 'category'
                  WHEN event_type = 'signup' THEN 'home' WHEN event_type = 'error' THEN 'cart'
                  ELSE 'purchase' END AS kind FROM events)"""

BRONZE["b_events"] = f"""
SELECT event_id AS id, user_id, sequence_number, session_id, ts AS created_at, ip_address, city, state, postal_code,
       CASE WHEN op = 'c' THEN browser ELSE 'Opera' END AS browser, traffic_source, uri, event_type,
       (epoch_us(ts) // 1000) + vday * 86400000 AS cdc_timestamp, op AS cdc_operation
FROM visits, {VERSIONS} WHERE {_versions('event_id')}"""

# Valid clickstream events and dead letters, told from the rules instead of parsing JSON.
BRONZE["clicks"] = """
SELECT event_id, CASE WHEN event_id % 43 <> 0 THEN user_id END AS user_id, sequence_number, session_id, ip_address,
       city, state, postal_code, browser, traffic_source, uri, event_type, ts AS event_timestamp,
       ts::DATE AS event_date, ts + to_seconds((event_id % 7 + delay)::INT) AS ingested_at
FROM visits, (VALUES (0), (7200)) AS d(delay)
WHERE event_id % 50 <> 0 AND (delay = 0 OR event_id % 25 = 1)"""

BRONZE["events_deadletter"] = """
SELECT CASE WHEN (event_id // 50) % 3 = 0 THEN 'Unknown event_type: teleport'
            WHEN (event_id // 50) % 3 = 1 THEN 'Missing required fields: session_id'
            ELSE 'Invalid JSON object' END AS error_message,
       ts + to_seconds((event_id % 7 + 1)::INT) AS failed_at
FROM visits WHERE event_id % 50 = 0"""
