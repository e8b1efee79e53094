"""Clickstream jobs, one query per table:

    messages → landing (+ dead letters) → events_raw → events_5m
                                                     → session_metrics

Lateness: the five-minute and session jobs drop events later than ``lateness`` behind the newest one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import clicks, sessions
from tidemark.operators.shape import latest_by
from tidemark.streaming.sinks import drop_batches, newest_batch, start_batches, start_table, write_batch

# Job defaults.
DEDUP_SECONDS = 3600
LATENESS_SECONDS = 600
EARLY_SECONDS = 60


def land_messages(
    messages: DataFrame, landing: str, dead: str, checkpoint: str, failed_at: Column | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Split messages into valid events and dead letters; counts both (metric ``clicks``)."""
    parsed = clicks.parse_events(messages).observe(
        "clicks",
        F.count_if(F.col("error_message").isNull()).alias("valid_events"),
        F.count_if(F.col("error_message").isNotNull()).alias("invalid_events"),
    )
    when = F.current_timestamp() if failed_at is None else failed_at

    def split(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            write_batch(clicks.valid_events(batch), batch_id, landing, ("event_date",))
            letters = clicks.dead_letters(batch, when)
            write_batch(letters.withColumn("date", F.to_date("failed_at")), batch_id, dead, ("date",))
        finally:
            batch.unpersist()

    return start_batches(parsed, split, checkpoint, "click_landing", every=every)


def deduplicate(events: DataFrame, ttl_seconds: int = DEDUP_SECONDS) -> DataFrame:
    """First copy of each event id within the time to live; state is dropped by the watermark."""
    return events.withWatermark("event_timestamp", f"{ttl_seconds} seconds").dropDuplicatesWithinWatermark(["event_id"])


def land_events(
    events: DataFrame, products: DataFrame, path: str, checkpoint: str, ttl_seconds: int = DEDUP_SECONDS,
    processed_at: Column | None = None, every: str | None = None,
) -> StreamingQuery:
    """Deduplicated and enriched events, appended by day; counts them (metric ``enriched``).

    The product side is read when the query starts; restart to refresh it.
    """
    when = F.current_timestamp() if processed_at is None else processed_at
    enriched = clicks.enrich(deduplicate(events, ttl_seconds), products, when).observe(
        "enriched", F.count("*").alias("enriched_events")
    )
    return start_table(enriched, path, checkpoint, "events_raw", ("event_date",), every)


def aggregate_5m(
    events: DataFrame, lateness_seconds: int = LATENESS_SECONDS, seconds: int = clicks.WINDOW_SECONDS
) -> DataFrame:
    """Counters per window and dimensions, exact in update mode.

    Distinct sessions and users are counted as first sightings: streaming deduplication per window spreads
    its state over all (window, dimensions, id) keys, where a collected set would grow inside one row.
    """
    dims = [*clicks.AGGREGATE_DIMENSIONS]
    rows = events.withWatermark("event_timestamp", f"{lateness_seconds} seconds").select(
        F.window("event_timestamp", f"{seconds} seconds").alias("window"),
        *dims, "session_id", "user_id", "is_conversion", "event_lag_seconds",
    )
    zero = F.lit(0).cast("bigint")

    def counters(frame: DataFrame, **given: Column) -> DataFrame:
        names = ("n", "sessions", "users", "purchases", "lagged")
        counted = [given.get(name, zero).cast("bigint").alias(name) for name in names]
        return frame.select("window", *dims, *counted, given.get("lag", F.lit(0.0)).alias("lag"))

    one = F.lit(1)
    has_lag = F.col("event_lag_seconds").isNotNull()
    all_events = counters(
        rows, n=one, purchases=F.when(F.col("is_conversion"), 1).otherwise(0),
        lagged=F.when(has_lag, 1).otherwise(0), lag=F.coalesce("event_lag_seconds", F.lit(0.0)),
    )
    by_session = rows.where("session_id <> ''").dropDuplicates(["window", *dims, "session_id"])
    by_user = rows.where("user_id IS NOT NULL").dropDuplicates(["window", *dims, "user_id"])
    stacked = all_events.union(counters(by_session, sessions=one)).union(counters(by_user, users=one))
    return stacked.groupBy("window", *dims).agg(
        F.sum("n").alias("total_events"),
        F.sum("sessions").alias("unique_sessions"),
        F.sum("users").alias("unique_users"),
        F.sum("purchases").alias("purchase_events"),
        F.sum("lag").alias("lag_sum"),
        F.sum("lagged").alias("lag_count"),
    ).withColumn("window_start", F.col("window.start")).drop("window")


def aggregate_5m_approx(
    events: DataFrame, lateness_seconds: int = LATENESS_SECONDS, seconds: int = clicks.WINDOW_SECONDS
) -> DataFrame:
    """The same counters with estimated distinct counts, whose state is one sketch per group."""
    window = F.window("event_timestamp", f"{seconds} seconds").alias("window")
    late = events.withWatermark("event_timestamp", f"{lateness_seconds} seconds")
    return late.groupBy(window, *clicks.AGGREGATE_DIMENSIONS).agg(
        F.count("*").alias("total_events"),
        F.approx_count_distinct("session_id").alias("unique_sessions"),
        F.approx_count_distinct("user_id").alias("unique_users"),
        F.count_if("is_conversion").alias("purchase_events"),
        F.sum("event_lag_seconds").alias("lag_sum"),
        F.count("event_lag_seconds").alias("lag_count"),
    ).withColumn("window_start", F.col("window.start")).drop("window")


def start_aggregates(
    events: DataFrame, path: str, checkpoint: str, lateness_seconds: int = LATENESS_SECONDS,
    approximate: bool = False, every: str | None = None,
) -> StreamingQuery:
    """Versions of the five-minute aggregates: every trigger appends the windows that changed."""
    grouped = (aggregate_5m_approx if approximate else aggregate_5m)(events, lateness_seconds)

    def emit(batch: DataFrame, batch_id: int) -> None:
        versions = clicks.aggregate_rows(batch, F.current_timestamp())
        write_batch(versions, batch_id, path, ("event_date",))

    return start_batches(grouped, emit, checkpoint, "events_5m", "update", every)


def session_windows(
    events: DataFrame, gap_seconds: int = sessions.GAP_SECONDS, lateness_seconds: int = LATENESS_SECONDS
) -> DataFrame:
    """Closed session windows with Spark's own session window (append mode). The gap is one microsecond
    short, because Spark merges events exactly a gap apart and sessions here do not."""
    gap = f"{gap_seconds - 1} seconds 999 milliseconds 999 microseconds"
    late = events.withWatermark("event_timestamp", f"{lateness_seconds} seconds")
    return late.groupBy(F.session_window("event_timestamp", gap).alias("window"), "session_id").agg(
        F.min("event_timestamp").alias("session_start"),
        F.max("event_timestamp").alias("session_end"),
        F.count("*").alias("event_count"),
        F.count_if(F.col("event_type") == "cart").alias("cart_count"),
        F.count_if(F.col("event_type") == "purchase").alias("purchase_count"),
    ).drop("window")


def cells(
    events: DataFrame, gap_seconds: int = sessions.GAP_SECONDS, lateness_seconds: int = LATENESS_SECONDS
) -> DataFrame:
    """Session cells as a stream (update mode): a changed cell is emitted whole."""
    late = events.withWatermark("event_timestamp", f"{lateness_seconds} seconds")
    window = F.window("event_timestamp", f"{gap_seconds} seconds")
    return sessions.cells_by(late, window.alias("window")).withColumn(
        "cell", F.unix_micros("window.start")
    ).drop("window")


def start_sessions(
    events: DataFrame, path: str, state: str, checkpoint: str, gap_seconds: int = sessions.GAP_SECONDS,
    lateness_seconds: int = LATENESS_SECONDS, every: str | None = None,
) -> StreamingQuery:
    """Versions of the session metrics: every trigger appends the sessions that changed.

    ``state`` keeps, per batch, the cells of sessions that can still grow. A batch reads the state of the
    one before and writes its own, so it can be repeated after a failure.
    """
    def emit(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        current = _merge(spark, batch, state, batch_id, gap_seconds, lateness_seconds).persist()
        try:
            moved = current.where("touched").drop("touched", "open")
            rows = sessions.session_metrics(moved, F.current_timestamp())
            write_batch(rows, batch_id, path, ("session_date",))
            write_batch(current.where("open").drop("touched", "open", "session_cell"), batch_id, state)
            drop_batches(spark, state, batch_id - 1)
        finally:
            current.unpersist()

    return start_batches(
        cells(events, gap_seconds, lateness_seconds), emit, checkpoint, "session_metrics", "update", every
    )


def _merge(
    spark: SparkSession, changed: DataFrame, state: str, batch_id: int, gap_seconds: int, lateness_seconds: int
) -> DataFrame:
    """Open cells of the batch before, overlaid with the changed ones; marks which sessions were touched
    and which can still grow."""
    fresh = changed.withColumn("touched", F.lit(True))
    previous = newest_batch(spark, state, batch_id)
    if previous is not None:
        old = spark.read.schema(changed.schema).parquet(f"{state}/batch_id={previous}")
        both = fresh.unionByName(old.withColumn("touched", F.lit(False)))
        fresh = latest_by(both, [*sessions.CELL_KEYS], ["touched"], ties=["event_count"])
    newest = fresh.agg(F.max("last_at")).first()[0]  # one instant
    session = Window.partitionBy("session_id", "session_cell")
    # An accepted event can lie up to a cell behind the watermark, and must be a gap away.
    silence = F.expr(f"INTERVAL {2 * gap_seconds + lateness_seconds} SECONDS")
    return sessions.assign_sessions(fresh, gap_seconds).withColumns(
        {
            "touched": F.bool_or("touched").over(session),
            "open": F.max("last_at").over(session) + silence >= F.lit(newest),
        }
    )
