"""Sample tables → the shapes the library works on (rules in FIXTURES.md §4).

Every rule is a per-row projection (one dimension lookup for users), so a consumer pays only for the
columns it reads; nothing here groups or sorts. The functions accept a stream of the events table too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the rules.
DAY_MS = 86_400_000
LINE_PRIME = 2_147_483_647
LINE_FACTORS = (1_000_003, 69_069)
MISSING = 1_000_000_000  # added to a foreign key to make it dangle
CHANNELS = "array('Search', 'Organic', 'Email', 'Facebook', 'Display')"
BROWSERS = "array('Chrome', 'Firefox', 'Safari', 'IE', 'Other')"
DAY0 = "TIMESTAMP '1995-01-01 00:00:00'"
NEW_STOCK_DAY = "TIMESTAMP '2001-01-01 00:00:00'"


def _instants(frame: DataFrame) -> DataFrame:
    """Zone-less timestamps as UTC instants."""
    bare = [f.name for f in frame.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return frame.withColumns({c: F.col(c).cast("timestamp") for c in bare}) if bare else frame


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return _instants(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a file stream."""
    path = f"{sf_dir}/events.parquet"
    layout = spark.read.parquet(path).schema
    # A glob keeps the file source from insisting on a folder.
    return _instants(spark.readStream.schema(layout).parquet(f"{sf_dir}/events.parque[t]"))


def _days(instant: str, days: str) -> str:
    return f"timestamp_micros(unix_micros({instant}) + bigint({days}) * {DAY_MS * 1000})"


def _seconds(instant: str, seconds: str) -> str:
    return f"timestamp_micros(unix_micros({instant}) + bigint({seconds}) * 1000000)"


def _cents(amount: str) -> str:
    return f"bigint({amount} * 100 + 0.5D)"


def _dangling(key: str, every: int) -> str:
    return f"{key} + IF({key} % {every} = 0, {MISSING}, 0)"


def _with_versions(frame: DataFrame, key: str) -> DataFrame:
    """Create for every key, update for each third, delete for each 97th; ``vday`` = days after creation."""
    operations = f"array_compact(array('c', IF({key} % 3 = 0, 'u', NULL), IF({key} % 97 = 0, 'd', NULL)))"
    return frame.selectExpr("*", f"explode({operations}) AS op").selectExpr(
        "*", "CASE op WHEN 'c' THEN 0 WHEN 'u' THEN 1 ELSE 2 END AS vday"
    )


def _change(base: str) -> tuple[str, str]:
    return f"unix_millis({base}) + vday * {DAY_MS} AS cdc_timestamp", "op AS cdc_operation"


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    joined = customer.join(nation, customer.c_nationkey == nation.n_nationkey).join(
        region, nation.n_regionkey == region.r_regionkey
    )
    created = _days(DAY0, "c_custkey % 2000")
    return _with_versions(joined, "c_custkey").selectExpr(
        "c_custkey AS id",
        "c_name AS first_name",
        "c_mktsegment AS last_name",
        "concat('user', c_custkey, '@example.com') AS email",
        "int(IF(c_custkey % 41 <> 0, 15 + c_custkey % 60, NULL)) AS age",
        "IF(c_custkey % 2 = 0, 'F', 'M') AS gender",
        "concat('State ', n_nationkey) AS state",
        "concat(c_custkey, ' Main Street') AS street_address",
        "concat('P', c_custkey % 1000) AS postal_code",
        "n_name AS city",
        "r_name AS country",
        "double(n_nationkey * 7 - 84) AS latitude",
        "double(n_nationkey * 13 - 150) AS longitude",
        f"get({CHANNELS}, int((c_custkey + IF(op = 'c', 0, 1)) % 5)) AS traffic_source",
        f"{created} AS created_at",
        f"IF(c_custkey % 5 <> 0, {_days(created, '30 + vday')}, NULL) AS updated_at",
        *_change(created),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    created, cents = _days(DAY0, "p_partkey % 365"), _cents("p_retailprice")
    return _with_versions(table(spark, sf_dir, "part"), "p_partkey").selectExpr(
        "p_partkey AS id",
        f"{cents} * 60 / 10000D AS cost",
        "p_type AS category",
        "p_name AS name",
        "IF(p_partkey % 50 = 0, '  ', p_brand) AS brand",
        f"IF(op = 'c', {cents} / 100D, {cents} * 110 / 10000D) AS retail_price",
        "IF(p_size % 2 = 0, 'Men', 'Women') AS department",
        "concat('SKU-', p_partkey) AS sku",
        "p_partkey % 10 AS distribution_center_id",
        f"{_days(created, 'vday')} AS updated_at",
        *_change(created),
    )


def distribution_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_versions(table(spark, sf_dir, "supplier"), "s_suppkey").selectExpr(
        "s_suppkey AS id",
        "IF(op = 'c', s_name, concat(s_name, ' (moved)')) AS name",
        "double(s_nationkey * 3 - 30) AS latitude",
        "double(s_nationkey * 11 - 120) AS longitude",
        *_change(DAY0),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _with_versions(table(spark, sf_dir, "orders"), "o_orderkey").selectExpr(
        "*",
        "CASE WHEN o_orderkey % 11 = 0 THEN 'Cancelled' WHEN o_orderkey % 10 = 0 THEN 'Returned'"
        " WHEN o_orderstatus = 'F' THEN 'Complete' WHEN o_orderstatus = 'O' THEN 'Processing' ELSE 'Shipped' END AS status",
    )
    shipped = base.selectExpr(
        "*",
        "CASE WHEN status IN ('Processing', 'Cancelled') THEN NULL"
        f" WHEN o_orderkey % 211 = 0 THEN {_days('o_orderdate', '-1')}"
        f" ELSE {_days('o_orderdate', 'o_orderkey % 4 + vday')} END AS shipped_at",
    )
    delivered = shipped.selectExpr(
        "*",
        "CASE WHEN status IN ('Complete', 'Returned') AND o_orderkey % 53 <> 0"
        f" THEN {_days('shipped_at', 'o_orderkey % 9')} END AS delivered_at",
    )
    return delivered.selectExpr(
        "o_orderkey AS order_id",
        f"{_dangling('o_custkey', 89)} AS user_id",
        "status",
        "IF(o_custkey % 2 = 0, 'F', 'M') AS gender",
        "o_orderdate AS created_at",
        f"{_days('o_orderdate', 'vday')} AS updated_at",
        f"CASE WHEN status = 'Returned' AND o_orderkey % 70 <> 0 THEN {_days('delivered_at', '3')} END AS returned_at",
        "shipped_at",
        "delivered_at",
        "int(1 + o_orderkey % 7) AS num_of_item",
        *_change("o_orderdate"),
    )


def _line_id() -> str:
    """62-bit content key of a line, two polynomial remainders side by side: rows carry no unique key, and
    ranking them would need one global (or per-order) sort. Identical lines are the same item."""
    values = (
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", _cents("l_quantity"), _cents("l_extendedprice"),
        _cents("l_discount"), _cents("l_tax"), "ascii(l_returnflag)", "ascii(l_linestatus)", "unix_seconds(l_shipdate)",
    )
    halves = []
    for factor in LINE_FACTORS:
        half = "0L"
        for value in values:
            half = f"(({half} * {factor} + {value}) % {LINE_PRIME})"
        halves.append(half)
    return f"{halves[0]} * {LINE_PRIME + 1} + {halves[1]}"


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr("*", f"{_line_id()} AS line_id")


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = f"{_cents('l_extendedprice')} * (100 - {_cents('l_discount')})"
    rows = _with_versions(_lines(spark, sf_dir), "line_id").selectExpr(
        "*",
        "CASE WHEN l_returnflag = 'R' THEN 'Returned' WHEN l_returnflag = 'A' THEN 'Complete'"
        " WHEN l_linestatus = 'O' THEN 'Processing' ELSE 'Shipped' END AS status",
    )
    return rows.selectExpr(
        "line_id AS id",
        "l_orderkey AS order_id",
        f"{_dangling('l_suppkey', 37)} AS user_id",
        f"{_dangling('l_partkey', 101)} AS product_id",
        "IF(l_linenumber <> 5, line_id, NULL) AS inventory_item_id",
        "status",
        "l_shipdate AS created_at",
        f"{_days('l_shipdate', 'vday')} AS updated_at",
        f"CASE WHEN status <> 'Processing' THEN {_days('l_shipdate', '1')} END AS shipped_at",
        f"CASE WHEN status IN ('Complete', 'Returned') THEN {_days('l_shipdate', '2 + l_orderkey % 9')} END AS delivered_at",
        f"CASE WHEN status = 'Returned' THEN {_days('l_shipdate', '7 + l_orderkey % 9')} END AS returned_at",
        "CASE WHEN l_orderkey % 499 = 0 THEN -1D WHEN l_orderkey % 50 = 0 AND l_linenumber = 3 THEN 0D"
        f" WHEN op = 'c' THEN {price} / 10000D ELSE ({price} * 9 div 10) / 10000D END AS sale_price",
        *_change("l_shipdate"),
    )


_STOCK = (
    "id", "product_id", "created_at", "sold_at", "cost",
    "concat('Category ', part % 25) AS product_category",
    "concat('Product ', part) AS product_name",
    "concat('Brand ', part % 40) AS product_brand",
    "double(900 + part % 1000) AS product_retail_price",
    "IF(part % 2 = 0, 'Men', 'Women') AS product_department",
    "concat('SKU-', part) AS product_sku",
    "center AS product_distribution_center_id",
)


def inventory_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sold item per line plus one unsold copy of each part."""
    sold = _with_versions(_lines(spark, sf_dir), "line_id").selectExpr(
        "line_id AS id", f"{_dangling('l_partkey', 101)} AS product_id", "l_partkey AS part",
        f"{_days('l_shipdate', '-(l_partkey % 120)')} AS created_at",
        f"{_days('l_shipdate', 'l_orderkey % 50 + vday')} AS sold_at",
        f"({_cents('l_extendedprice')} * 55 div 100) / 100D AS cost",
        f"{_dangling('l_suppkey', 41)} AS center", "op", "vday",
    )
    unsold = _with_versions(
        table(spark, sf_dir, "part").selectExpr("*", "-10 - p_partkey AS stock_id"), "stock_id"
    ).selectExpr(
        "stock_id AS id", "p_partkey AS product_id", "p_partkey AS part",
        f"{_days(NEW_STOCK_DAY, 'p_partkey % 270')} AS created_at",
        "CAST(NULL AS TIMESTAMP) AS sold_at",
        f"{_cents('p_retailprice')} * 60 / 10000D AS cost",
        "p_partkey % 10 AS center", "op", "vday",
    )
    return sold.unionByName(unsold).selectExpr(*_STOCK, *_change("created_at"))


def _visits(events: DataFrame) -> DataFrame:
    """Event rows with the attributes a web visit has; shared by the CDC and the clickstream shape."""
    kinds = events.selectExpr(
        "*",
        "CASE WHEN event_id % 29 = 0 THEN 'cancel' WHEN event_id % 31 = 0 THEN 'department'"
        " WHEN event_type = 'view' THEN 'product' WHEN event_type = 'click' THEN 'category'"
        " WHEN event_type = 'signup' THEN 'home' WHEN event_type = 'error' THEN 'cart' ELSE 'purchase' END AS kind",
        "regexp_extract(props, '([0-9]+)', 1) AS item",
    )
    return kinds.selectExpr(
        "event_id",
        "user_id",
        "ts",
        "event_id % 20 AS sequence_number",
        "concat(user_id, '-', date_format(ts, 'yyyyMMdd')) AS session_id",
        "concat('10.0.0.', user_id % 256) AS ip_address",
        "IF(user_id % 19 <> 0, concat('City ', user_id % 30), NULL) AS city",
        "concat('State ', user_id % 12) AS state",
        "concat('P', user_id % 1000) AS postal_code",
        f"get({BROWSERS}, int(event_id % 5)) AS browser",
        f"IF(user_id % 17 = 0, ' ', get({CHANNELS}, int(user_id % 5))) AS traffic_source",
        "CASE WHEN event_id % 37 = 0 THEN NULL WHEN kind = 'home' THEN '/'"
        " WHEN kind = 'cancel' THEN concat('/cancel/item/', item) WHEN kind = 'category' THEN concat('/category/', item)"
        " WHEN kind = 'department' THEN '/department/Men/category/Jeans%20%26%20Co'"
        " ELSE concat('/product/', item) END AS uri",
        "kind AS event_type",
    )


def events(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    source = table(spark, sf_dir, "events") if events is None else events
    return _with_versions(_visits(source), "event_id").selectExpr(
        "event_id AS id", "user_id", "int(sequence_number) AS sequence_number", "session_id", "ts AS created_at",
        "ip_address", "city", "state", "postal_code", "IF(op = 'c', browser, 'Opera') AS browser", "traffic_source",
        "uri", "event_type", *_change("ts"),
    )


BRONZE = {
    "users": users,
    "products": products,
    "distribution_centers": distribution_centers,
    "orders": orders,
    "order_items": order_items,
    "inventory_items": inventory_items,
    "events": events,
}

# Each 25th event arrives a second time, two hours later.
_DELAYS = "explode(array_compact(array(0, IF(event_id % 25 = 1, 7200, NULL)))) AS delay"


def valid_clicks(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """What parsing :func:`click_messages` must yield, built from typed columns."""
    source = table(spark, sf_dir, "events") if events is None else events
    return _visits(source).where("event_id % 50 <> 0").selectExpr("*", _DELAYS).selectExpr(
        "event_id",
        "IF(event_id % 43 <> 0, user_id, NULL) AS user_id",
        "sequence_number", "session_id", "ip_address", "city", "state", "postal_code", "browser",
        "traffic_source", "uri", "event_type",
        "ts AS event_timestamp",
        "date(ts) AS event_date",
        f"{_seconds('ts', 'event_id % 7 + delay')} AS ingested_at",
    )


def click_messages(
    spark: SparkSession, sf_dir: str, only_bad: bool = False, events: DataFrame | None = None,
    slice_days: int | None = None,
) -> DataFrame:
    """JSON payloads as a broker would deliver them (``value``, transport ``timestamp``): each 7th event
    uses the alias keys, each 25th comes twice, each 50th is broken in one of three ways.

    ``slice_days`` adds the ``slice`` of that many days in which a message is delivered; each 13th event and every
    second copy are delivered a day after their arrival."""
    visits = _visits(table(spark, sf_dir, "events") if events is None else events)
    if only_bad:
        visits = visits.where("event_id % 50 = 0")
    broken = "CASE WHEN event_id % 50 = 0 THEN (event_id div 50) % 3 ELSE -1 END AS flaw"
    rows = visits.selectExpr("*", broken, _DELAYS).selectExpr(
        "*", f"{_seconds('ts', 'event_id % 7 + delay')} AS ingested"
    )

    def stamp(column: str) -> str:
        return f"date_format({column}, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\")"

    common = (
        "'user_id', IF(event_id % 43 <> 0, user_id, NULL), 'sequence_number', sequence_number,"
        " 'session_id', IF(flaw = 1, '', session_id), 'ip_address', ip_address, 'city', city, 'state', state,"
        " 'postal_code', postal_code, 'browser', browser, 'traffic_source', traffic_source, 'uri', uri,"
        f" 'event_type', IF(flaw = 0, 'teleport', event_type), 'ingested_at', {stamp('ingested')}"
    )
    named = f"to_json(named_struct('event_id', event_id, 'event_timestamp', {stamp('ts')}, {common}))"
    aliased = f"to_json(named_struct('id', event_id, 'created_at', {stamp('ts')}, {common}))"
    held = _seconds("ingested", "IF(event_id % 13 = 0 OR delay > 0, 86400, 0)")
    delivered = [] if slice_days is None else [f"unix_seconds({held}) div {slice_days * 86_400} AS slice"]
    return rows.selectExpr(
        "*", f"IF(event_id % 7 = 0, {aliased}, {named}) AS text"
    ).selectExpr(
        "IF(flaw = 2, substring(text, 1, 40), text) AS value",
        f"{_seconds('ingested', '1')} AS timestamp",
        *delivered,
    )


def cdc_messages(spark: SparkSession, sf_dir: str, name: str, rows: DataFrame | None = None) -> DataFrame:
    """Change envelopes of one table in the three shapes seen on the wire (wrapped payload, bare payload,
    envelope inside ``value_json``), deletes carrying the ``before`` image. ``timestamp`` = transport time."""
    frame = BRONZE[name](spark, sf_dir) if rows is None else rows
    fields = [f for f in frame.schema.fields if not f.name.startswith("cdc_")]
    image = "named_struct(" + ", ".join(
        f"'{f.name}', " + (f"unix_micros({f.name})" if isinstance(f.dataType, T.TimestampType) else f.name)
        for f in fields
    ) + ")"
    key = fields[0].name
    payload = (
        f"named_struct('op', cdc_operation, 'ts_ms', IF({key} % 5 <> 0, cdc_timestamp, NULL),"
        f" 'before', IF(cdc_operation = 'd', {image}, NULL), 'after', IF(cdc_operation <> 'd', {image}, NULL),"
        f" 'source', named_struct('table', '{name}', 'schema', 'demo', 'ts_ms', cdc_timestamp))"
    )
    rows = frame.selectExpr(f"abs({key}) % 3 AS shape", "cdc_timestamp", f"{payload} AS payload").selectExpr(
        "*", "to_json(struct(payload)) AS wrapped"
    )
    return rows.selectExpr(
        "CASE shape WHEN 0 THEN wrapped WHEN 1 THEN to_json(payload)"
        " ELSE to_json(named_struct('value_json', wrapped)) END AS value",
        f"'server.demo.{name}' AS topic",
        "timestamp_millis(cdc_timestamp) AS timestamp",
    )
