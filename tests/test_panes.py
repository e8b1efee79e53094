import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_ingest import MESSAGE, PRODUCTS, START, feed, message
from tidemark.operators import clicks, sessions
from tidemark.session import work_path
from tidemark.streaming import clickstream, ingest, panes

BATCHES = (
    [message(1, 1), message(2, 7)],  # watermark 7: [0, 5) is on time, [5, 10) early
    [message(3, 2), message(4, 8), message(5, 9, kind="home")],  # watermark 9: late event in [0, 5)
    [message(6, 12)],  # passes 10
    [message(7, 26), message(8, 3)],  # 8 is nine minutes behind 12, late; all windows that end by 16 close
    [message(9, 27), message(10, 4)],  # 10 is beyond the lateness: no pane
)


def run(spark, root, *batches, first=0, lateness=600):
    for number, batch in enumerate(batches, first):
        feed(spark, root, batch, first=number, lateness=lateness)
        panes.emit_panes(spark, root, number, F.current_timestamp(), lateness)
        panes.emit_sessions(spark, root, number, F.current_timestamp(), lateness_seconds=lateness)


def seen(spark, root):
    minute = (F.unix_seconds("window_start") - F.unix_seconds(F.lit(START))) / 60
    found = panes.panes(spark, root).select(minute.cast("int"), "event_type", "pane", "kind", "batch_id", "total_events")
    return [tuple(r) for r in found.collect()]


EXPECTED = sorted([
    (0, "product", 0, "on_time", 0, 1), (0, "product", 1, "late", 1, 2), (0, "product", 2, "final", 3, 3),
    (5, "product", 0, "early", 0, 1), (5, "product", 1, "early", 1, 2), (5, "product", 2, "on_time", 2, 2),
    (5, "product", 3, "final", 3, 2),
    (5, "home", 0, "early", 1, 1), (5, "home", 1, "on_time", 2, 1), (5, "home", 2, "final", 3, 1),
    (10, "product", 0, "early", 2, 1), (10, "product", 1, "final", 3, 1),
    (25, "product", 0, "early", 3, 1), (25, "product", 1, "early", 4, 2),
])


def test_panes_follow_the_watermark(spark):
    root = work_path(spark, "panes")
    run(spark, root, *BATCHES)
    assert sorted(seen(spark, root)) == EXPECTED
    panes.emit_panes(spark, root, len(BATCHES), F.current_timestamp(), drain=True)
    drained = [e for e in seen(spark, root) if e[4] == len(BATCHES)]
    assert drained == [(25, "product", 2, "final", 5, 2)]
    # final panes are the batch result over the events on time
    final = panes.panes(spark, root).where("kind = 'final'")
    batch = clicks.aggregate_5m(ingest.on_time(spark, root), F.col("window_end")).drop("version_emitted_at")
    assert batch.exceptAll(final.select(batch.columns)).count() == 0 and final.count() == batch.count()
    assert rows(ingest.late(spark, root).select("event_id")) == [(10,)]


def test_the_lateness_moves_the_kinds(spark):
    root = work_path(spark, "panes")
    run(spark, root, *BATCHES, lateness=1800)
    found = seen(spark, root)
    assert (0, "product", 3, "late", 4, 4) in found  # the event of minute 4 is on time now
    assert not [e for e in found if e[3] == "final"]


def test_a_repeated_batch_writes_the_same(spark):
    root = work_path(spark, "panes")
    run(spark, root, *BATCHES[:3])
    before, state = seen(spark, root), spark.read.parquet(f"{root}/cells").count()
    run(spark, root, BATCHES[2], first=2)
    assert sorted(seen(spark, root)) == sorted(before)
    assert spark.read.parquet(f"{root}/cells").count() == state
    run(spark, root, *BATCHES[3:], first=3)
    assert sorted(e for e in seen(spark, root) if e[0] == 0) == [e for e in EXPECTED if e[0] == 0]


def test_sessions_join_and_only_touched_ones_are_stored(spark):
    root = work_path(spark, "panes")
    others = [message(100 + i, i % 5, session=f"o{i}") for i in range(40)]
    groups = (
        [message(1, 0, session="s"), message(2, 50, session="s"), *others],
        [message(3, 25, session="s"), message(4, 55, session="t")],  # joins the two windows of s
        [message(5, -20, session="s"), message(6, 60, session="t")],  # earlier start
        [message(7, 600, session="z")],
        [message(8, 601, session="s")],  # a new window of s: the old one is out of reach
    )
    run(spark, root, *groups, lateness=7200)
    stored = {r.batch_id: r.n for r in spark.read.parquet(f"{root}/cells").groupBy("batch_id").agg(F.count_distinct("session_id").alias("n")).collect()}
    assert {b: n for b, n in stored.items() if b > 2} == {3: 1, 4: 1}
    versions = panes.session_versions(spark, root)
    written = {r.batch_id: r.n for r in versions.groupBy("batch_id").agg(F.count("*").alias("n")).collect()}
    assert written == {0: 42, 1: 2, 2: 2, 3: 1, 4: 1}
    expected = sessions.sessions(ingest.on_time(spark, root), F.col("session_end"))
    current = sessions.session_windows_current(versions)
    same = [c for c in expected.columns if c not in ("version_emitted_at", "processed_at")]
    assert expected.select(same).exceptAll(current.select(same)).count() == 0
    assert current.count() == expected.count()
    # nothing of the hours before the last batch's reach is left
    left = spark.read.parquet(f"{root}/cells").agg(F.max("last_at"), F.min("last_at")).first()
    assert left[1] >= START + dt.timedelta(minutes=600 - 2 * 150)


def test_empty_batches_and_unknown_outputs(spark):
    root = work_path(spark, "panes")
    run(spark, root, [("{", START)], [message(1, 1)], [("{", START)])
    assert seen(spark, root) == [(0, "product", 0, "early", 1, 1)]
    products = spark.createDataFrame([(42, "c", "d", "n")], PRODUCTS)
    with pytest.raises(ValueError):
        panes.start(spark.createDataFrame([], MESSAGE), products, root, root, outputs=["pane"])
    assert clickstream.EARLY_SECONDS == 60


def test_a_batch_reads_its_events_and_the_stored_cells_once(spark, monkeypatch):
    root = work_path(spark, "panes")
    feed(spark, root, [message(1, 1)], [message(2, 2), message(3, 3, session="t")])
    panes.emit_sessions(spark, root, 0, F.current_timestamp())
    real, read = panes.write_batch, []

    def counting(batch, batch_id, path, partitions):
        read.append(batch._jdf.queryExecution().analyzed().toString().count("Relation ["))
        real(batch, batch_id, path, partitions)

    monkeypatch.setattr(panes, "write_batch", counting)
    panes.emit_sessions(spark, root, 1, F.current_timestamp())
    assert read == [2, 2]
    versions = panes.session_versions(spark, root).select("session_id", "batch_id", "event_count")
    assert rows(versions, "session_id", "batch_id") == [("s", 0, 1), ("s", 1, 2), ("t", 1, 1)]
