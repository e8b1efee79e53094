"""Clickstream ingest as one job: messages are parsed once and become, below one folder,

    events/    first copies, enriched, by day
    late/      first copies behind the watermark, enriched, with the watermark they missed
    dead/      messages that are no valid event
    keys/      ids that can still meet a copy, by hour
    counters/  one row per micro-batch

No event that is not a copy is lost: what comes behind the watermark goes to ``late``, and :func:`repair_5m` computes
the windows that it falls in again.

The watermark of a micro-batch is the newest event time of the batches before it; an event time ahead of the event's
own arrival counts as the arrival, so one wrong clock cannot make all others late. An id is remembered until the
watermark passes its event time by the time to live: a copy that comes later is an event again. Only hours that are
still alive are read and kept, so the work of a batch follows the batch and the time to live, not the history.

Of the products only those that a batch names take part in its enrichment, so what is sent for the lookup does not grow
with the catalog.

Every batch reads what earlier batches left and replaces what an earlier attempt of its own wrote; the counters, from
which the next batch takes its watermark, are written last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import clicks
from tidemark.schemas import EVENTS_RAW
from tidemark.session import delete_path
from tidemark.streaming.clickstream import DEDUP_SECONDS, LATENESS_SECONDS
from tidemark.streaming.sinks import start_batches, write_batch

COUNTERS = ("valid_events", "invalid_events", "enriched_events", "duplicate_events", "late_events")
_KEYS = "event_id bigint, first_at timestamp, hour bigint, batch_id bigint"
_EVENTS = T.StructType([*EVENTS_RAW.fields, T.StructField("batch_id", T.LongType())])
_LATE = T.StructType([*_EVENTS.fields, T.StructField("missed_watermark", T.TimestampType())])
_HOUR = 3_600_000_000
_SECOND = 1_000_000


def ingest_batch(
    batch: DataFrame, batch_id: int, products: DataFrame, root: str, ttl_seconds: int = DEDUP_SECONDS,
    lateness_seconds: int = LATENESS_SECONDS, processed_at: Column | None = None, failed_at: Column | None = None,
) -> None:
    """One micro-batch of messages. Of copies within it, the one that arrived first is taken."""
    spark = batch.sparkSession
    processed_at = F.current_timestamp() if processed_at is None else processed_at
    failed_at = F.current_timestamp() if failed_at is None else failed_at
    before = reached(spark, root, batch_id - 1)
    parsed = clicks.parse_events(batch).persist()
    first = clicks.first_seen(clicks.valid_events(parsed))
    if before is not None:
        alive = _alive(spark, root, batch_id, before - ttl_seconds * _SECOND)
        first = first.join(alive, "event_id", "left_anti")
    missed = None if before is None else before - lateness_seconds * _SECOND
    behind = F.lit(False) if missed is None else F.unix_micros("event_timestamp") < missed
    named = clicks.products_named(products, clicks.valid_events(parsed)).coalesce(spark.sparkContext.defaultParallelism).persist()
    named.count()  # Catalyst then chooses the lookup's join by the size of what was found
    events = clicks.enrich(first, named, processed_at).withColumn("_late", behind).persist()
    try:
        seen = _seen(parsed)
        newest = max((n for n in (seen.newest, before) if n is not None), default=None)
        by_day = events.drop("_late").hint("rebalance", "event_date")
        write_batch(by_day.where(~behind), batch_id, f"{root}/events", ("event_date",))
        watermark = F.timestamp_micros(F.lit(missed).cast("bigint"))
        write_batch(by_day.where(behind).withColumn("missed_watermark", watermark), batch_id, f"{root}/late", ("event_date",))
        write_batch(clicks.dead_letters(parsed, failed_at), batch_id, f"{root}/dead")
        if newest is not None:
            expired = newest - ttl_seconds * _SECOND
            keys = events.select("event_id", F.col("event_timestamp").alias("first_at"), _hour("event_timestamp").alias("hour"))
            keys = keys.where(F.unix_micros("first_at") > expired).hint("rebalance", "hour")
            write_batch(keys, batch_id, f"{root}/keys", ("hour",))
        made = events.agg(F.count("*").alias("events"), F.count_if("_late").alias("late")).first()
        _count(spark, batch_id, root, newest, seen.valid, seen.invalid, made.events, seen.valid - made.events, made.late)
        if before is not None:
            _forget(spark, root, before - ttl_seconds * _SECOND)  # not more: this batch may be repeated
    finally:
        events.unpersist()
        named.unpersist()
        parsed.unpersist()


def ingest(
    messages: DataFrame, products: DataFrame, root: str, checkpoint: str, ttl_seconds: int = DEDUP_SECONDS,
    lateness_seconds: int = LATENESS_SECONDS, processed_at: Column | None = None, failed_at: Column | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Run :func:`ingest_batch` per micro-batch of a stream of messages.

    The product side is read per batch. Another ``ttl_seconds`` holds from the next batch on, a longer one for ids
    that are not forgotten yet.
    """
    def job(batch: DataFrame, batch_id: int) -> None:
        ingest_batch(batch, batch_id, products, root, ttl_seconds, lateness_seconds, processed_at, failed_at)

    return start_batches(messages, job, checkpoint, "click_ingest", every=every)


def on_time(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(_EVENTS).parquet(f"{root}/events")


def late(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(_LATE).parquet(f"{root}/late")


def counters(spark: SparkSession, root: str) -> DataFrame:
    """The counters of every micro-batch; their sums are the totals, however many batches there were."""
    return spark.read.parquet(f"{root}/counters").select("batch_id", *COUNTERS)


def reached(spark: SparkSession, root: str, batch_id: int) -> int | None:
    """Newest event time, in microseconds, after a batch; batches are numbered without gaps."""
    if batch_id < 0:
        return None
    return spark.read.parquet(f"{root}/counters/batch_id={batch_id}").first().newest


def repair_5m(spark: SparkSession, root: str, emitted_at: Column, since_batch: int = 0) -> DataFrame:
    """New versions of the five-minute aggregates that the late events of the batches from ``since_batch`` on change.

    Only days that hold such an event are read, and only its windows are computed again, from all their events.
    ``emitted_at`` may refer to ``window_end``; it must be later than that of the versions to be replaced.
    """
    moment = F.unix_micros("event_timestamp")
    window = moment - F.pmod(moment, F.lit(clicks.WINDOW_SECONDS * _SECOND))
    behind = late(spark, root)
    touched = behind.where(F.col("batch_id") >= since_batch).select("event_date", window.alias("_window")).distinct()
    both = on_time(spark, root).unionByName(behind.drop("missed_watermark")).withColumn("_window", window)
    return clicks.aggregate_5m(both.join(touched, ["event_date", "_window"], "left_semi"), emitted_at)


def _hour(instant: str) -> Column:
    return F.floor(F.unix_micros(instant) / F.lit(_HOUR)).cast("bigint")


def _seen(parsed: DataFrame) -> Row:
    valid = F.col("error_message").isNull()
    arrived = F.least(F.unix_micros("event_timestamp"), F.unix_micros("ingested_at"))
    return parsed.agg(
        F.count_if(valid).alias("valid"), F.count_if(~valid).alias("invalid"),
        F.max(F.when(valid, arrived)).alias("newest"),
    ).first()  # three numbers


def _count(spark: SparkSession, batch_id: int, root: str, newest: int | None, *counts: int) -> None:
    row = [F.lit(n).cast("bigint").alias(name) for name, n in zip(COUNTERS, counts, strict=True)]
    write_batch(spark.range(1, numPartitions=1).select(*row, F.lit(newest).cast("bigint").alias("newest")), batch_id, f"{root}/counters")


def _alive(spark: SparkSession, root: str, batch_id: int, expired: int) -> DataFrame:
    """Ids of earlier batches whose time to live is not over; whole hours before it are not read."""
    keys = spark.read.schema(_KEYS).parquet(f"{root}/keys").where(F.col("batch_id") < batch_id)
    keys = keys.where((F.col("hour") >= expired // _HOUR) & (F.unix_micros("first_at") > expired))
    return keys.select("event_id")


def _forget(spark: SparkSession, root: str, expired: int) -> None:
    """Delete the hours that neither this batch nor a later one reads."""
    keys = spark.read.schema(_KEYS).parquet(f"{root}/keys")
    for row in keys.where(F.col("hour") < expired // _HOUR).select("hour").distinct().collect():  # hours since the last batch
        delete_path(spark, f"{root}/keys/hour={row.hour}")
