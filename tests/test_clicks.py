import json

from pyspark.sql import functions as F

from tests.conftest import rows, ts
from tidemark.operators import clicks
from tidemark.sources import sample

GOOD = {
    "event_id": 7, "user_id": 3, "sequence_number": 1, "session_id": "s", "event_type": "product", "uri": "/product/42",
    "event_timestamp": "2024-01-01T10:00:00Z", "ingested_at": "2024-01-01T10:00:05Z", "city": "X",
}


def parse(spark, *payloads):
    texts = [(i, p if isinstance(p, str) else json.dumps(p)) for i, p in enumerate(payloads)]
    return clicks.parse_events(spark.createDataFrame(texts, "i int, value string")).orderBy("i").collect()


def test_valid_event(spark):
    (row,) = parse(spark, GOOD)
    assert row.error_message is None
    assert (row.event_id, row.event_timestamp, row.ingested_at) == (7, ts("2024-01-01 10:00:00"), ts("2024-01-01 10:00:05"))


def test_aliases_defaults_and_offsets(spark):
    aliased = {k: v for k, v in GOOD.items() if k not in ("event_id", "event_timestamp", "ingested_at")}
    aliased |= {"id": "12", "created_at": "2024-01-01T17:00:00+07:00"}
    (row,) = parse(spark, aliased)
    assert (row.event_id, row.event_timestamp, row.ingested_at) == (12, ts("2024-01-01 10:00:00"), ts("2024-01-01 10:00:00"))


def test_errors(spark):
    cases = {
        "Missing required fields: event_id, session_id": {k: v for k, v in GOOD.items() if k not in ("event_id", "session_id")},
        "Missing required fields: session_id": GOOD | {"session_id": ""},
        "Missing required fields: event_id": GOOD | {"event_id": None, "id": 5},
        "Missing required fields: ingested_at": GOOD | {"ingested_at": None},
        "Missing required fields: event_type": GOOD | {"event_type": ""},
        "Unknown event_type: teleport": GOOD | {"event_type": "teleport"},
        "Invalid isoformat string: 'soon'": GOOD | {"event_timestamp": "soon"},
        "invalid literal for int() with base 10: 'x'": GOOD | {"user_id": "x"},
        "Invalid JSON object": '{"event_id": 1, ',
    }
    found = parse(spark, *cases.values())
    assert [r.error_message for r in found] == list(cases)
    assert parse(spark, "[1, 2]")[0].error_message == "Invalid JSON object"
    assert parse(spark, GOOD | {"user_id": None})[0].error_message is None


def test_change_envelope_is_dead_lettered(spark):
    (row,) = parse(spark, {"payload": {"op": "c", "after": GOOD, "source": {"table": "events"}}})
    assert row.error_message.startswith("Missing required fields: event_id, session_id, event_type")


def test_split_loses_nothing(spark):
    parsed = clicks.parse_events(sample.click_messages(spark, "/root/testdata/sf0.001"))
    valid, dead = clicks.valid_events(parsed), clicks.dead_letters(parsed, F.col("timestamp"))
    assert valid.count() + dead.count() == parsed.count() and dead.count() > 0
    typed = sample.valid_clicks(spark, "/root/testdata/sf0.001")
    assert valid.exceptAll(typed.select(valid.columns)).count() == 0 and valid.count() == typed.count()


def events(spark, *records):
    frame = spark.createDataFrame(
        records, "event_id long, uri string, event_type string, event_timestamp timestamp, ingested_at timestamp"
    )
    rest = [c for c in clicks.VALID_COLUMNS if c not in frame.columns]
    return frame.select("*", *[F.lit(None).cast("string").alias(c) for c in rest])


def test_enrichment_accepts_table_and_dimension(spark, as_of):
    at, later = ts("2024-01-01 10:00:00"), ts("2024-01-01 10:00:02.500000")
    visits = events(
        spark, (1, "/product/42", "purchase", at, later), (2, "/product/43", "product", later, at), (3, None, "home", at, at)
    )
    table = spark.createDataFrame([(42, "Jeans", "Men", "Slim")], "id long, category string, department string, name string")
    dimension = table.withColumnRenamed("id", "product_id").withColumnRenamed("name", "product_name")
    for products in (table, dimension):
        found = rows(
            clicks.enrich(visits, products, as_of).select(
                "event_id", "page_type", "product_id", "product_name", "is_conversion", "event_lag_seconds"
            ), "event_id",
        )
        assert found == [
            (1, "product", 42, "Slim", True, 2.5), (2, "product", 43, None, False, 0.0), (3, "unknown", None, None, False, 0.0)
        ]


def test_lookup_id_zero_is_kept(spark):
    frame = spark.createDataFrame([(0, 9), (None, 8)], "product_id long, id long").withColumns(
        {c: F.lit("x") for c in ("category", "department", "name")}
    )
    assert [r[0] for r in rows(clicks.product_lookup(frame).select("_product"), "_product")] == [0, 8]


def test_aggregate_counts_each_visitor_once(spark, as_of):
    at = ts("2024-01-01 10:04:59")
    frame = spark.createDataFrame(
        [("s1", 1, True, 1.0), ("s1", 1, False, None), ("s2", 1, False, 3.0), ("", None, False, 2.0)],
        "session_id string, user_id long, is_conversion boolean, event_lag_seconds double",
    ).select(
        "*", F.lit(at).alias("event_timestamp"), F.lit("2024-01-01").cast("date").alias("event_date"),
        F.lit(None).cast("string").alias("traffic_source"), F.lit("IE").alias("browser"),
        F.lit("home").alias("event_type"), F.lit("home").alias("page_type"),
    )
    (row,) = clicks.aggregate_5m(frame, as_of).collect()
    assert (row.total_events, row.unique_sessions, row.unique_users, row.purchase_events, row.avg_event_lag_seconds) == (4, 2, 1, 1, 2.0)
    assert row.aggregate_id == "2024-01-01T10:00:00+00:00|2024-01-01||IE|home|home"
    assert row.window_end == ts("2024-01-01 10:05:00")


def test_published_payload_parses_back(spark, as_of):
    source = sample.events(spark, "/root/testdata/sf0.001").where("cdc_operation = 'c'")
    parsed = clicks.parse_events(clicks.publish_payload(source, as_of))
    assert parsed.where("error_message IS NOT NULL").count() == 0
    back = parsed.select(F.col("event_id").alias("id"), "event_timestamp", "uri")
    assert back.exceptAll(source.select("id", F.col("created_at").alias("event_timestamp"), "uri")).count() == 0
