import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows, ts
from tidemark.operators import clicks
from tidemark.session import work_path
from tidemark.streaming import ingest

START = ts("2024-01-01 10:00:00")
MESSAGE = "value string, timestamp timestamp"
PRODUCTS = "id long, category string, department string, name string"


def message(i, minute, kind="product", session="s", arrived=None):
    def text(at):
        return (START + dt.timedelta(minutes=at)).isoformat() + "Z"

    body = {
        "event_id": i, "session_id": session, "event_type": kind, "event_timestamp": text(minute),
        "ingested_at": text(minute if arrived is None else arrived), "user_id": 1, "browser": "IE",
        "traffic_source": "Search", "uri": "/product/42",
    }
    return json.dumps(body), START


def feed(spark, root, *batches, first=0, ttl=3600, lateness=600):
    products = spark.createDataFrame([(42, "c", "d", "n")], PRODUCTS)
    for number, batch in enumerate(batches, first):
        ingest.ingest_batch(spark.createDataFrame(batch, MESSAGE), number, products, root, ttl, lateness)


def kept(spark, root):
    both = ingest.on_time(spark, root).withColumn("missed_watermark", F.lit(None).cast("timestamp"))
    both = both.unionByName(ingest.late(spark, root))
    return rows(both.select("event_id", "batch_id", F.col("missed_watermark").isNotNull()), "event_id", "batch_id")


BATCHES = (
    [message(1, 0), message(1, 0), message(2, 20), ("{", START)],
    [message(1, 0), message(3, 5), message(4, 15), message(5, 70)],  # 3 is more than ten minutes behind 20, 4 is not
    [message(1, 0), message(2, 20), message(6, 600)],  # the hour of 1 is over, that of 2 is not
)


def test_late_events_are_kept_and_copies_dropped_within_the_time_to_live(spark):
    root = work_path(spark, "ingest")
    feed(spark, root, *BATCHES)
    assert kept(spark, root) == [
        (1, 0, False), (1, 2, True), (2, 0, False), (3, 1, True), (4, 1, False), (5, 1, False), (6, 2, False),
    ]
    found = rows(ingest.counters(spark, root), "batch_id")
    # batch, valid, invalid, enriched, duplicate, late
    assert found == [(0, 3, 1, 2, 1, 0), (1, 4, 0, 3, 1, 1), (2, 3, 0, 2, 1, 1)]
    missed = ingest.late(spark, root).where("event_id = 3").first().missed_watermark
    assert missed == START + dt.timedelta(minutes=10)
    assert ingest.on_time(spark, root).first().product_name == "n"


@pytest.mark.parametrize(("ttl", "lateness", "copies", "late"), [(7200, 600, 0, 1), (3600, 3 * 3600, 1, 0)])
def test_bounds_move_the_result(spark, ttl, lateness, copies, late):
    root = work_path(spark, "ingest")
    feed(spark, root, *BATCHES, ttl=ttl, lateness=lateness)
    found = kept(spark, root)
    assert (found.count((1, 2, False)) + found.count((1, 2, True)), sum(row[2] for row in found)) == (copies, late)


def test_only_living_hours_of_keys_remain(spark):
    root = work_path(spark, "ingest")
    feed(spark, root, *([message(10 * n + k, 60 * n + k) for k in range(3)] for n in range(6)))
    left = spark.read.parquet(f"{root}/keys")
    assert left.select("hour").distinct().count() <= 3
    assert left.where(F.col("event_id") < 30).count() == 0


def test_repeated_batch_changes_nothing(spark):
    """A run that died before its offsets were committed is repeated: also when later files are there already."""
    root, once = work_path(spark, "ingest"), work_path(spark, "ingest")
    feed(spark, once, *BATCHES)
    feed(spark, root, *BATCHES[:2])
    feed(spark, root, BATCHES[1], first=1)
    feed(spark, root, BATCHES[2], first=2)
    feed(spark, root, BATCHES[2], first=2)
    assert kept(spark, root) == kept(spark, once)
    assert rows(ingest.counters(spark, root), "batch_id") == rows(ingest.counters(spark, once), "batch_id")


def test_a_batch_that_dies_at_a_write_is_repeated_whole(spark, monkeypatch):
    root, once = work_path(spark, "ingest"), work_path(spark, "ingest")
    feed(spark, once, *BATCHES)
    real = ingest.write_batch
    feed(spark, root, BATCHES[0])
    for table in ("events", "late", "dead", "keys", "counters"):
        def failing(batch, batch_id, path, *partitions):
            if path.endswith(f"/{table}"):
                raise OSError(table)
            real(batch, batch_id, path, *partitions)

        monkeypatch.setattr(ingest, "write_batch", failing)
        with pytest.raises(OSError, match=table):
            feed(spark, root, BATCHES[1], first=1)
    monkeypatch.setattr(ingest, "write_batch", real)
    feed(spark, root, *BATCHES[1:], first=1)
    assert kept(spark, root) == kept(spark, once)


def test_wrong_clock_does_not_make_the_others_late(spark):
    root = work_path(spark, "ingest")
    feed(spark, root, [message(1, 0), message(2, 10_000_000, arrived=1)], [message(3, 2), message(2, 10_000_000, arrived=2)])
    assert kept(spark, root) == [(1, 0, False), (2, 0, False), (3, 1, False)]


def test_batches_without_valid_or_any_messages(spark):
    root = work_path(spark, "ingest")
    feed(spark, root, [], [("{", START)], [message(1, 0)], [], [message(1, 0)])
    assert kept(spark, root) == [(1, 2, False)]
    assert ingest.late(spark, root).count() == 0
    assert rows(ingest.counters(spark, root).select("valid_events", "duplicate_events"), "batch_id") == [
        (0, 0), (0, 0), (1, 0), (0, 0), (1, 1),
    ]
    assert ingest.repair_5m(spark, root, F.col("window_end")).count() == 0


def test_repair_touches_only_windows_of_late_events(spark):
    root = work_path(spark, "ingest")
    feed(spark, root, [message(1, 0), message(2, 1, session="t"), message(3, 40)], [message(4, 2, session="u"), message(5, 41)])
    repaired = ingest.repair_5m(spark, root, F.col("window_end"))
    assert rows(repaired.select("window_start", "total_events", "unique_sessions")) == [(START, 3, 3)]
    assert ingest.repair_5m(spark, root, F.col("window_end"), since_batch=2).count() == 0
    published = clicks.aggregate_5m(ingest.on_time(spark, root), F.col("window_end") - F.expr("INTERVAL 1 DAY"))
    latest = clicks.events_5m_latest(published.unionByName(repaired))
    assert rows(latest.select("total_events"), "window_start") == [(3,), (2,)]


def test_only_the_products_that_a_batch_names_take_part_in_its_enrichment(spark, monkeypatch):
    root = work_path(spark, "ingest")
    catalog = spark.range(1, 1000).selectExpr("id", "concat('c', id) AS category", "'d' AS department", "CAST(null AS STRING) AS name")
    real, met = clicks.enrich, []
    monkeypatch.setattr(clicks, "enrich", lambda events, products, at: (met.append(products.count()), real(events, products, at))[1])
    unknown = json.dumps(json.loads(message(3, 2)[0]) | {"uri": "/product/5000"}), START
    none = json.dumps(json.loads(message(4, 3)[0]) | {"uri": None}), START
    ingest.ingest_batch(spark.createDataFrame([message(1, 0), message(2, 1), unknown, none], MESSAGE), 0, catalog, root)
    assert met == [1]
    found = ingest.on_time(spark, root).select("event_id", "product_id", "product_category", "product_department", "product_name")
    assert rows(found, "event_id") == [
        (1, 42, "c42", "d", None), (2, 42, "c42", "d", None), (3, 5000, None, None, None), (4, None, None, None, None),
    ]
