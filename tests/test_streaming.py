import datetime as dt
import json

from pyspark.sql import functions as F

from tests.conftest import rows, ts
from tidemark.operators import clicks, sessions
from tidemark.schemas import EVENTS_RAW
from tidemark.session import work_path
from tidemark.sources import readers
from tidemark.streaming import cdc as cdc_jobs
from tidemark.streaming import clickstream
from tidemark.streaming.sinks import finish, newest_batch, write_batch

START = ts("2024-01-01 10:00:00")
MESSAGE = "value string, topic string, timestamp timestamp"


def event(i, minute, session="s", kind="product", category=None, lag=1.0, user=1):
    at = START + dt.timedelta(minutes=minute)
    given = {
        "event_id": i, "user_id": user, "session_id": session, "event_type": kind, "event_timestamp": at, "event_date": at.date(),
        "ingested_at": at, "page_type": kind, "product_category": category, "is_conversion": kind == "purchase",
        "processing_time": at, "event_lag_seconds": lag, "browser": "IE", "traffic_source": "Search",
    }
    return tuple(given.get(f) for f in EVENTS_RAW.fieldNames())


def put(spark, path, events, schema=EVENTS_RAW):
    spark.createDataFrame(events, schema).coalesce(1).write.mode("append").parquet(path)


def source(spark, path, schema=EVENTS_RAW):
    return readers.file_messages(spark, path, schema)


def batches(spark, path, start, *groups):
    """Feed groups one after the other, each as its own run of the same job."""
    for group in groups:
        put(spark, path, group)
        finish(start())


def test_five_minute_versions_add_up_across_batches(spark):
    root = work_path(spark, "agg")

    def start():
        return clickstream.start_aggregates(source(spark, f"{root}/in"), f"{root}/out", f"{root}/ck")

    first = [event(1, 0), event(2, 1, user=2), event(3, 4, "t")]
    second = [event(4, 2, "t"), event(5, 3, "u", user=3, kind="product"), event(6, 30)]
    too_late = [event(7, 1, "v", user=9), event(8, 31)]
    batches(spark, f"{root}/in", start, first, second, too_late)
    versions = spark.read.parquet(f"{root}/out").drop("batch_id")
    latest = clicks.events_5m_latest(versions)
    counted = rows(latest.select("window_start", "total_events", "unique_sessions", "unique_users"), "window_start")
    # The event of minute 1 in the third batch is more than ten minutes behind minute 30.
    assert counted == [(START, 5, 3, 3), (START + dt.timedelta(minutes=30), 2, 1, 1)]
    assert versions.where(F.col("window_start") == F.lit(START)).count() == 2
    batch = clicks.aggregate_5m(spark.createDataFrame(first + second + too_late[1:], EVENTS_RAW), F.col("window_end"))
    same = [c for c in batch.columns if c != "version_emitted_at"]
    assert latest.select(same).exceptAll(batch.select(same)).count() == 0


def test_estimated_uniques_job(spark):
    root = work_path(spark, "approx")
    put(spark, f"{root}/in", [event(1, 0), event(2, 1, "t", user=2), event(3, 2, "t", user=2)])
    finish(clickstream.start_aggregates(source(spark, f"{root}/in"), f"{root}/out", f"{root}/ck", approximate=True))
    assert rows(spark.read.parquet(f"{root}/out").select("total_events", "unique_sessions", "unique_users")) == [(3, 2, 2)]


def test_sessions_grow_merge_and_close(spark):
    root = work_path(spark, "sess")

    def start():
        return clickstream.start_sessions(source(spark, f"{root}/in"), f"{root}/out", f"{root}/cells", f"{root}/ck", lateness_seconds=7200)

    groups = [
        [event(1, 0, category="a"), event(2, 50, category="b")],  # two windows of one id
        [event(3, 25, category="b"), event(4, 10, "t")],  # joins them
        [event(5, 60, "t"), event(6, 70, kind="purchase")],
        [event(7, 600, "z")],  # far ahead: the others are final
        [event(8, 601, "z")],
    ]
    batches(spark, f"{root}/in", start, *groups)
    versions = spark.read.parquet(f"{root}/out").drop("batch_id")
    latest = sessions.session_window_latest(versions)
    everything = spark.createDataFrame([e for g in groups for e in g], EVENTS_RAW)
    expected = sessions.sessions(everything, F.col("session_end"))
    same = [c for c in expected.columns if c not in ("version_emitted_at", "processed_at")]
    assert expected.select(same).exceptAll(latest.select(same)).count() == 0
    joined = latest.where("session_id = 's' AND event_count = 4").first()
    assert (joined.top_category, joined.purchased) == ("b", True)
    # Only the newest state is kept, and it holds only what can still grow.
    newest = newest_batch(spark, f"{root}/cells", 10**9)
    kept = spark.read.parquet(f"{root}/cells/batch_id={newest}")
    assert {r.session_id for r in kept.select("session_id").distinct().collect()} == {"z"}


def test_native_session_windows_split_at_the_gap(spark):
    root = work_path(spark, "native")
    put(spark, f"{root}/in", [event(1, 0), event(2, 29), event(3, 59), event(4, 59, "t"), event(5, 900, "far")])
    put(spark, f"{root}/in", [event(6, 901, "far")])
    stream = clickstream.session_windows(source(spark, f"{root}/in"))
    query = stream.writeStream.format("memory").queryName("closed").outputMode("append").trigger(availableNow=True)
    finish(query.option("checkpointLocation", f"{root}/ck").start())
    found = rows(spark.table("closed").select("session_id", "event_count"), "session_id", "session_start")
    assert found == [("s", 2), ("s", 1), ("t", 1)]


def test_deduplication_within_and_beyond_the_ttl(spark):
    root = work_path(spark, "dedup")
    columns = clicks.VALID_COLUMNS
    products = spark.createDataFrame([(42, "c", "d", "n")], "id long, category string, department string, name string")

    def start():
        stream = source(spark, f"{root}/in").select(*columns)
        return clickstream.land_events(stream, products, f"{root}/out", f"{root}/ck", ttl_seconds=3600)

    batches(spark, f"{root}/in", start, [event(1, 0), event(1, 0), event(2, 0)], [event(1, 30), event(3, 31)], [event(4, 32)])
    found = rows(spark.read.parquet(f"{root}/out").select("event_id"), "event_id")
    assert found == [(1,), (2,), (3,), (4,)]
    batches(spark, f"{root}/in", start, [event(5, 600)], [event(6, 601)], [event(1, 602)])
    assert spark.read.parquet(f"{root}/out").where("event_id = 1").count() == 2


def test_landing_splits_and_counts(spark):
    root = work_path(spark, "land")
    good = json.dumps({"event_id": 1, "session_id": "s", "event_type": "home", "event_timestamp": "2024-01-01T10:00:00Z"})
    put(spark, f"{root}/in", [(good, "t", START), ("{", "t", START), (good.replace("home", "x"), "t", START)], MESSAGE)
    query = finish(clickstream.land_messages(
        readers.file_messages(spark, f"{root}/in", spark.read.parquet(f"{root}/in").schema), f"{root}/ok", f"{root}/bad", f"{root}/ck"
    ))
    assert spark.read.parquet(f"{root}/ok").count() == 1
    assert rows(spark.read.parquet(f"{root}/bad").select("error_message"), "error_message") == [
        ("Invalid JSON object",), ("Unknown event_type: x",)
    ]
    metrics = [p["observedMetrics"]["clicks"] for p in query.recentProgress if p["observedMetrics"]]
    assert (metrics[0]["valid_events"], metrics[0]["invalid_events"]) == (1, 2)


def test_repeated_batch_replaces_itself(spark):
    path = work_path(spark, "again")
    frame = spark.createDataFrame([(1, "a"), (2, "b")], "k int, p string")
    for _ in range(2):
        write_batch(frame, 4, path, ("p",))
    write_batch(frame.limit(1), 5, path, ("p",))
    assert spark.read.parquet(path).count() == 3


def test_cold_landing_keeps_unknown_tables(spark):
    root = work_path(spark, "cold")

    def change(table, row):
        return json.dumps({"payload": {"op": "c", "ts_ms": 1704103200000, "after": row, "source": {"table": table}}})

    put(
        spark, f"{root}/in",
        [
            (change("users", {"id": 1, "email": "e", "created_at": 1704103200000000}), "m", START),
            (change("distribution_centers", {"id": 2, "name": "d"}), "m", START + dt.timedelta(hours=2)),
            (change("events", {"id": 3}), "m", START), (change("coupons", {"code": "x"}), "m", START),
        ],
        MESSAGE,
    )
    stream = readers.file_messages(spark, f"{root}/in", spark.read.parquet(f"{root}/in").schema)
    finish(cdc_jobs.land_cold(stream, f"{root}/lake", f"{root}/ck"))
    users = readers.read_bronze(spark, f"{root}/lake/users").first()
    assert (users.id, users.created_at, str(users.date), int(users.hour)) == (1, START, "2024-01-01", 10)
    assert readers.read_bronze(spark, f"{root}/lake/dist_centers").first().hour == 12
    assert rows(spark.read.parquet(f"{root}/lake/other").select("table", "after")) == [("coupons", '{"code":"x"}')]
    hot = cdc_jobs.land_hot(stream, f"{root}/hot", f"{root}/ck_hot")
    for query in hot:
        finish(query)
    assert rows(spark.read.parquet(f"{root}/hot/events").select("id")) == [(3,)]
