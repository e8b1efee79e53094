"""Panes of the five-minute aggregates and versions of the sessions, written by each micro-batch of the ingest job.

A pane is one version of an aggregate. Its kind follows from the watermark, the newest event time, before and after the
micro-batch that writes it:

    early     the watermark has not reached the window's end
    on_time   the watermark passes the window's end: every aggregate of the window, changed or not
    late      an event after that, within the lateness
    final     the watermark passes the window's end by the lateness: every aggregate of the window, the last time

Of several kinds in one micro-batch the last in this list holds. Panes accumulate: each is computed from all events
of its window that the ingest job found on time. Panes of an aggregate are numbered from 0.

What a micro-batch reads and writes follows the batch and the open windows or sessions that it touches, not the
history: a window that is still open ends after the watermark less the lateness, so days before are not opened, and
cells of a session are stored by the span of time in which its last event lies, and read until an event on time cannot
reach that span any more. Spans are as long as an event can be late and still join a session.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import clicks, sessions
from tidemark.session import delete_path
from tidemark.streaming import ingest
from tidemark.streaming.clickstream import DEDUP_SECONDS, EARLY_SECONDS, LATENESS_SECONDS
from tidemark.streaming.sinks import start_batches, write_batch

OUTPUTS = ("panes", "sessions")
EARLY, ON_TIME, LATE, FINAL = "early", "on_time", "late", "final"
_SECOND = 1_000_000
_WINDOW = clicks.WINDOW_SECONDS * _SECOND
_NUMBERS = "aggregate_id string, pane bigint, event_date date, batch_id bigint"


def emit_panes(
    spark: SparkSession, root: str, batch_id: int, emitted_at: Column, lateness_seconds: int = LATENESS_SECONDS,
    drain: bool = False,
) -> None:
    """Write the panes of a micro-batch that the ingest job has taken in.

    ``drain`` ends the stream: the watermark passes every window that is still open. ``batch_id`` is then the number
    after the last one.
    """
    before = ingest.reached(spark, root, batch_id - 1)
    after = before if drain else ingest.reached(spark, root, batch_id)
    if after is None:
        return  # no event so far
    lateness = lateness_seconds * _SECOND
    end = F.col("_window") + _WINDOW
    moment = F.unix_micros("event_timestamp")
    events = ingest.on_time(spark, root).where(F.col("batch_id") <= batch_id).withColumn("_window", moment - F.pmod(moment, F.lit(_WINDOW)))
    if before is not None:
        opened = F.to_date(F.timestamp_micros(F.lit(before - lateness - _WINDOW)))
        events = events.where((F.col("event_date") >= opened) & (end > before - lateness))
    passes = _passed(end, before, after, 0, drain)
    closes = _passed(end, before, after, lateness, drain)
    grouped = ["_window", *clicks.AGGREGATE_DIMENSIONS]
    fresh = events.groupBy(*grouped).agg(F.max("batch_id").alias("_newest"))
    fresh = fresh.where((F.col("_newest") == batch_id) | passes | closes).drop("_newest")
    # null dimensions are equal here
    same = [F.col(f"e.{c}").eqNullSafe(F.col(f"g.{c}")) for c in grouped if c != "_window"]
    wanted = events.alias("e").join(fresh.alias("g"), [F.col("e._window") == F.col("g._window"), *same], "left_semi")
    kind = F.when(closes, FINAL).when(passes, ON_TIME)
    kind = kind.when(F.lit(False) if before is None else end <= before, LATE).otherwise(EARLY)
    rows = clicks.aggregate_5m(wanted, emitted_at).withColumn("_window", F.unix_micros("window_start"))
    rows = rows.withColumn("kind", kind).withColumn("watermark", F.timestamp_micros(F.lit(after))).drop("_window")
    if before is None:
        numbered = rows.withColumn("pane", F.lit(0).cast("bigint"))
    else:
        earlier = spark.read.schema(_NUMBERS).parquet(f"{root}/panes")
        earlier = earlier.where((F.col("batch_id") < batch_id) & (F.col("event_date") >= opened))
        numbers = earlier.groupBy("aggregate_id").agg((F.max("pane") + 1).alias("pane"))
        numbered = rows.join(numbers, "aggregate_id", "left").withColumn("pane", F.coalesce("pane", F.lit(0).cast("bigint")))
    write_batch(numbered.hint("rebalance", "event_date"), batch_id, f"{root}/panes", ("event_date",))


def panes(spark: SparkSession, root: str) -> DataFrame:
    """Every pane so far: the aggregate's columns, ``kind``, ``pane`` (its number), ``watermark`` and ``batch_id``."""
    return spark.read.parquet(f"{root}/panes")


def emit_sessions(
    spark: SparkSession, root: str, batch_id: int, emitted_at: Column, gap_seconds: int = sessions.GAP_SECONDS,
    lateness_seconds: int = LATENESS_SECONDS,
) -> None:
    """Write a version of each session that a micro-batch, which the ingest job has taken in, changes.

    The cells of a session id that the batch touches are stored again, whole, with the batch; those of others stay
    where they are. Sessions that no event on time can reach any more are not read.
    """
    span = (lateness_seconds + gap_seconds) * _SECOND
    before = ingest.reached(spark, root, batch_id - 1)
    events = ingest.on_time(spark, root).where(F.col("batch_id") == batch_id)
    cells = sessions.session_cells(events, gap_seconds).withColumn("fresh", F.lit(True))
    if before is not None:
        # an event on time is at most the lateness behind, and joins a session less than a gap before it
        alive = before - span
        schema = T.StructType([*cells.drop("fresh").schema.fields, *_PLACE.fields])
        old = spark.read.schema(schema).parquet(f"{root}/cells").where((F.col("span_end") > alive) & (F.col("batch_id") < batch_id))
        both = cells.withColumn("batch_id", F.lit(batch_id).cast("bigint")).unionByName(old.drop("span_end").withColumn("fresh", F.lit(False)))
        # all that follows is by session id: one shuffle, in which untouched ids and older copies of cells fall out
        of_id = Window.partitionBy("session_id")
        stored = F.max(F.when(~F.col("fresh"), F.col("batch_id"))).over(of_id)
        marked = both.repartition("session_id").withColumn("_touched", F.max("fresh").over(of_id)).withColumn("_stored", stored)
        current = marked.where(F.col("_touched") & (F.col("fresh") | (F.col("batch_id") == F.col("_stored"))))
        cells = sessions.add_cells(current, "fresh")
    window = Window.partitionBy("session_id", "session_cell")
    assigned = sessions.assign_sessions(cells, gap_seconds)
    assigned = assigned.withColumn("_last", F.max("last_at").over(window)).withColumn("_changed", F.max("fresh").over(window)).persist()
    try:
        rows = sessions.session_metrics(assigned.where("_changed").drop("_last", "_changed", "fresh"), emitted_at)
        write_batch(rows.hint("rebalance", "session_date"), batch_id, f"{root}/sessions", ("session_date",))
        last = F.unix_micros("_last")
        kept = assigned.withColumn("span_end", last - F.pmod(last, F.lit(span)) + span).drop("_last", "_changed", "fresh", "session_cell")
        write_batch(kept.hint("rebalance", "span_end"), batch_id, f"{root}/cells", ("span_end",))
    finally:
        assigned.unpersist()
    if before is not None:
        _forget(spark, root, alive)  # not more: this batch may be repeated


def session_versions(spark: SparkSession, root: str) -> DataFrame:
    """Every version of every session so far, with the ``batch_id`` that wrote it."""
    return spark.read.parquet(f"{root}/sessions")


def start(
    messages: DataFrame, products: DataFrame, root: str, checkpoint: str, ttl_seconds: int = DEDUP_SECONDS,
    lateness_seconds: int = LATENESS_SECONDS, gap_seconds: int = sessions.GAP_SECONDS, processed_at: Column | None = None,
    failed_at: Column | None = None, emitted_at: Column | None = None, every: str | None = f"{EARLY_SECONDS} seconds",
    outputs: Sequence[str] = OUTPUTS,
) -> StreamingQuery:
    """Ingest and the named outputs as one query: a micro-batch, and with it early panes, each ``every`` interval, or
    over what is there now and then stop (None). A micro-batch that dies at any write is repeated whole."""
    if not set(outputs) <= set(OUTPUTS):
        raise ValueError(f"outputs are {OUTPUTS}")
    spark = messages.sparkSession
    when = F.current_timestamp() if emitted_at is None else emitted_at

    def job(batch: DataFrame, batch_id: int) -> None:
        ingest.ingest_batch(batch, batch_id, products, root, ttl_seconds, lateness_seconds, processed_at, failed_at)
        if "panes" in outputs:
            emit_panes(spark, root, batch_id, when, lateness_seconds)
        if "sessions" in outputs:
            emit_sessions(spark, root, batch_id, when, gap_seconds, lateness_seconds)

    return start_batches(messages, job, checkpoint, "click_panes", every=every)


_PLACE = T.StructType([T.StructField("span_end", T.LongType()), T.StructField("batch_id", T.LongType())])


def _passed(end: Column, before: int | None, after: int, delay: int, drain: bool) -> Column:
    """Whether the watermark passes ``end`` by the delay in this micro-batch."""
    not_yet = F.lit(True) if before is None else end > before - delay
    return not_yet if drain else not_yet & (end <= after - delay)


def _forget(spark: SparkSession, root: str, alive: int) -> None:
    """Delete the spans of cells that neither this batch nor a later one reads."""
    stored = spark.read.schema(_PLACE).parquet(f"{root}/cells")
    for row in stored.where(F.col("span_end") <= alive).select("span_end").distinct().collect():  # spans since the last batch
        delete_path(spark, f"{root}/cells/span_end={row.span_end}")
