import json

from pyspark.sql import functions as F

from tests.conftest import rows, ts
from tidemark.operators import cdc
from tidemark.schemas import SOURCE_TABLES


def parsed(spark, *bodies):
    return cdc.parse_cdc(spark.createDataFrame([(i, json.dumps(b)) for i, b in enumerate(bodies)], "i int, value string"))


PAYLOAD = {"op": "u", "ts_ms": 5, "before": {"id": 1}, "after": {"id": 1, "name": "x"}, "source": {"table": "distribution_centers", "schema": "demo", "ts_ms": 4}}


def test_three_shapes_decode_alike(spark):
    found = rows(
        parsed(
            spark, {"payload": PAYLOAD}, PAYLOAD, {"value_json": json.dumps({"payload": PAYLOAD})},
            {"value_json": json.dumps(PAYLOAD)},
        ).select("i", "table", "schema_name", "op", "cdc_timestamp", "after"), "i",
    )
    assert {r[1:] for r in found} == {("dist_centers", "demo", "u", 5, '{"id":1,"name":"x"}')}


def test_fallbacks(spark):
    bare = {"op": "c", "after": {"id": 1}}
    found = rows(
        parsed(
            spark, bare | {"source": {"ts_ms": 4}}, bare | {"table": "users", "schema": "s"},
            {"event_id": 1, "session_id": "s", "event_type": "home"}, PAYLOAD | {"ts_ms": 0},
        ).select("i", "table", "schema_name", "cdc_timestamp"), "i",
    )
    assert [r[1:] for r in found] == [("unknown", None, 4), ("users", "s", None), ("unknown", None, None), ("dist_centers", "demo", 4)]


def test_delete_carries_before_image(spark):
    deleted = PAYLOAD | {"op": "d", "after": None, "before": {"id": 9, "name": "old"}}
    empty = PAYLOAD | {"after": {}, "before": {"id": 8}}
    frame = cdc.flatten(parsed(spark, {"payload": deleted}, {"payload": empty}), "distribution_centers")
    assert rows(frame.select("id", "name", "cdc_operation"), "id") == [(8, None, "u"), (9, "old", "d")]
    assert frame.columns == [*SOURCE_TABLES["distribution_centers"].fieldNames(), "cdc_timestamp", "cdc_operation"]


def test_time_units_of_an_image(spark):
    def user(key, value):
        return {"op": "c", "ts_ms": 1, "after": {"id": key, "created_at": value}, "source": {"table": "users"}}

    frame = parsed(spark, user(1, 1700000000000000), user(2, 1700000000000), user(3, "2023-11-14T22:13:20Z"), user(4, "x"))
    by_length = rows(cdc.flatten(frame, "users").select("id", "created_at"), "id")
    at = ts("2023-11-14 22:13:20")
    assert [r[1] for r in by_length] == [at, at, at, None]
    micros = rows(cdc.flatten(frame, "users", unit="micros").select("created_at", "id"), "id")
    assert [r[0] for r in micros] == [at, ts("1970-01-20 16:13:20"), at, None]


def test_routing(spark):
    frame = parsed(spark, PAYLOAD, PAYLOAD | {"source": {"table": "events"}}, {"op": "c"})
    assert rows(cdc.route_hot(frame).select("table")) == [("events",)]
    assert rows(cdc.route_cold(frame).select("table"), "table") == [("dist_centers",), ("unknown",)]
    assert cdc.route_hot(frame, ("events", "unknown")).count() == 2
    topics = spark.createDataFrame([("a.demo.events",), ("a.demo.order_items",), ("a.demo.other",)], "t string")
    assert [r[0] for r in topics.select(cdc.topic_of(F.col("t"))).collect()] == [
        "clickstream-events", "cdc-events", "a.demo.other"
    ]


def test_schema_normalisation(spark):
    frame = spark.createDataFrame([(1, "2024-01-01T00:00:00Z", 3)], "b smallint, made_at string, a int").withColumn("z", F.lit(None))
    found = cdc.normalise_schema(frame)
    assert found.dtypes == [("a", "bigint"), ("b", "bigint"), ("made_at", "timestamp"), ("z", "string")]
    other = spark.createDataFrame([(1704067200000000, 1.5)], "made_at long, extra double")
    both = cdc.union_batches(frame, other)
    assert both.count() == 2 and both.select("made_at").distinct().count() == 1 and "extra" in both.columns
