"""Registered queries that run a job: sinks, sources and streams over the sample tables.

Every run works in a fresh folder below the shared one.
"""

from __future__ import annotations

import datetime as dt
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import clicks, incremental, sessions
from tidemark.plans import refresh, staging
from tidemark.session import work_path
from tidemark.sources import readers, sample
from tidemark.streaming import cdc as cdc_jobs
from tidemark.streaming import clickstream, ingest, panes
from tidemark.streaming.sinks import finish, start_batches, write_batch

INCREMENT_FROM = dt.datetime(1999, 1, 1)
SNAPSHOT_MS = 1_700_000_000_000
SLICE_DAYS = 4
PANE_LATENESS = 2 * 86_400  # half a slice, so that windows end early, on time, late and final
LONG_AGO = 400 * 86_400  # lateness that lets a finished table through as one unordered backlog


def _change_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = sample.events(spark, sf_dir, sample.event_stream(spark, sf_dir))
    return sample.cdc_messages(spark, sf_dir, "events", changes)


def _click_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = sample.click_messages(spark, sf_dir, events=sample.event_stream(spark, sf_dir))
    return clicks.valid_events(clicks.parse_events(messages))


def _enriched_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = staging.stg_products(sample.products(spark, sf_dir))
    processed = F.col("ingested_at") + F.expr("INTERVAL 2 SECONDS")
    return clicks.enrich(_click_stream(spark, sf_dir), products, processed)


def _first_events(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    """Messages parsed, deduplicated, enriched and landed; the landed table as a stream."""
    products = staging.stg_products(sample.products(spark, sf_dir))
    processed = F.col("ingested_at") + F.expr("INTERVAL 2 SECONDS")
    events, path = _click_stream(spark, sf_dir), f"{root}/raw"
    finish(clickstream.land_events(events, products, path, f"{root}/raw-state", LONG_AGO, processed))
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)


def _land(spark: SparkSession, stream: DataFrame, label: str) -> DataFrame:
    """A stream's rows after one run over what is there."""
    root = work_path(spark, label)
    finish(start_batches(stream, lambda batch, n: write_batch(batch, n, f"{root}/t"), f"{root}/state", label))
    return spark.read.parquet(f"{root}/t").drop("batch_id")


def src_cdc_stream(spark, sf_dir):
    """Change messages as read from the stream, by topic and day of transport."""
    landed = _land(spark, _change_stream(spark, sf_dir), "src_cdc")
    return landed.groupBy("topic", F.to_date("timestamp").alias("day")).agg(F.count("value").alias("messages"))


def src_clickstream(spark, sf_dir):
    """Clickstream messages as read from the stream, by day of transport."""
    messages = sample.click_messages(spark, sf_dir, events=sample.event_stream(spark, sf_dir))
    landed = _land(spark, messages, "src_clicks")
    return landed.groupBy(F.to_date("timestamp").alias("day")).agg(F.count("value").alias("messages"))


def sink_hot_events(spark, sf_dir):
    root = work_path(spark, "hot")
    for query in cdc_jobs.land_hot(_change_stream(spark, sf_dir), f"{root}/lake", f"{root}/state", unit="micros"):
        finish(query)
    return spark.read.parquet(f"{root}/lake/events").drop("date")


def sink_cold_parquet(spark, sf_dir):
    """The event changes routed to the cold path, read back through partition discovery."""
    root = work_path(spark, "cold")
    finish(cdc_jobs.land_cold(_change_stream(spark, sf_dir), f"{root}/lake", f"{root}/state", hot=(), unit="micros"))
    return readers.read_bronze(spark, f"{root}/lake/events").drop("date", "hour", "batch_id")


def src_hive_parquet(spark, sf_dir):
    """Order changes laid out by date and hour of a monthly flush, read back with discovered partitions."""
    root = work_path(spark, "hive")
    flushed = F.date_trunc("month", F.timestamp_millis("cdc_timestamp"))
    moments = {"date": F.to_date(flushed), "hour": F.date_format(flushed, "HH")}
    rows = sample.orders(spark, sf_dir).withColumns(moments)
    rows.hint("rebalance", "date", "hour").write.partitionBy("date", "hour").parquet(root)
    found = readers.read_bronze(spark, root)
    return found.groupBy("date").agg(F.count("*").alias("changes"), F.count_distinct("order_id").alias("orders"))


def sink_raw_replay(spark, sf_dir):
    root = work_path(spark, "raw")
    stream = _change_stream(spark, sf_dir)
    finish(cdc_jobs.land_raw(stream, f"{root}/table", f"{root}/archive", f"{root}/state"))
    copies = [
        spark.read.parquet(f"{root}/{name}").select(F.lit(name).alias("copy"), "topic", "value_json")
        for name in ("table", "archive")
    ]
    both = copies[0].unionByName(copies[1])
    return both.groupBy("copy", "topic").agg(F.count("value_json").alias("messages"))


def sink_append_table(spark, sf_dir):
    """Enriched events appended by day; one week read back through the partition filter."""
    root = work_path(spark, "append")
    query = start_batches(
        _enriched_stream(spark, sf_dir), lambda batch, n: write_batch(batch, n, f"{root}/t", ("event_date",)),
        f"{root}/state", "append_table",
    )
    finish(query)
    week = spark.read.parquet(f"{root}/t").where("event_date BETWEEN DATE'2024-01-08' AND DATE'2024-01-14'")
    return week.groupBy("event_date", "event_type").agg(F.count("*").alias("events"))


def st_stream_split(spark, sf_dir):
    """Messages through the landing job: valid events and dead letters per reason."""
    root = work_path(spark, "landing")
    messages = sample.click_messages(spark, sf_dir, events=sample.event_stream(spark, sf_dir))
    finish(
        clickstream.land_messages(
            messages, f"{root}/events", f"{root}/dead", f"{root}/state", failed_at=F.col("timestamp")
        )
    )
    valid = spark.read.parquet(f"{root}/events").select(F.lit("valid").alias("outcome"))
    dead = spark.read.parquet(f"{root}/dead").select(F.col("error_message").alias("outcome"))
    return valid.unionByName(dead).groupBy("outcome").agg(F.count("*").alias("messages"))


def _ingested(
    spark: SparkSession, sf_dir: str, label: str, ttl_seconds: int, lateness_seconds: int, start=ingest.ingest
) -> str:
    """All messages through the ingest job in the order of their delivery, one micro-batch a slice of days."""
    root = work_path(spark, label)
    messages = sample.click_messages(spark, sf_dir, slice_days=SLICE_DAYS)
    messages.write.partitionBy("slice").parquet(f"{root}/delivered")
    delivered = spark.read.parquet(f"{root}/delivered")
    slices = [row.slice for row in delivered.select("slice").distinct().orderBy("slice").collect()]  # a few days
    products = staging.stg_products(sample.products(spark, sf_dir))
    processed = F.col("ingested_at") + F.expr("INTERVAL 2 SECONDS")
    for number in slices:
        part = delivered.where(F.col("slice") == number).drop("slice")
        part.write.mode("append").parquet(f"{root}/in")
        stream = readers.file_messages(spark, f"{root}/in", part.schema, per_batch=1_000_000)
        finish(
            start(
                stream, products, f"{root}/t", f"{root}/state", ttl_seconds, lateness_seconds, processed_at=processed,
                failed_at=F.col("timestamp"), every=None,
            )
        )
    return f"{root}/t"


def st_counters(spark, sf_dir):
    """Totals of the counters the ingest job stores with every micro-batch."""
    root = _ingested(spark, sf_dir, "counters", clickstream.DEDUP_SECONDS, clickstream.LATENESS_SECONDS)
    return ingest.counters(spark, root).agg(
        F.sum("valid_events").alias("valid_events"), F.sum("invalid_events").alias("invalid_events")
    )


def st_counters_by_batch(spark, sf_dir):
    """All counters of the ingest job per micro-batch, with three days to live."""
    root = _ingested(spark, sf_dir, "counters-batch", 3 * 86_400, clickstream.LATENESS_SECONDS)
    return ingest.counters(spark, root)


def st_lateness(spark, sf_dir):
    """What the ingest job keeps with the configured time to live and lateness: each event's micro-batch, and the
    watermark that a late one missed. Copies after the time to live are events again."""
    root = _ingested(spark, sf_dir, "lateness", clickstream.DEDUP_SECONDS, clickstream.LATENESS_SECONDS)
    columns = ("event_id", "ingested_at", "batch_id", "missed_watermark")
    kept = ingest.on_time(spark, root).withColumn("missed_watermark", F.lit(None).cast("timestamp"))
    return kept.select(*columns).unionByName(ingest.late(spark, root).select(*columns))


def st_late_repair(spark, sf_dir):
    """Five-minute aggregates of the events on time, repaired by the windows that late events touch."""
    root = _ingested(spark, sf_dir, "repair", LONG_AGO, clickstream.LATENESS_SECONDS)
    published = clicks.aggregate_5m(ingest.on_time(spark, root), F.col("window_end"))
    repaired = ingest.repair_5m(spark, root, F.col("window_end") + F.expr("INTERVAL 10 DAYS"))
    return clicks.events_5m_latest(published.unionByName(repaired)).drop("version_emitted_at")


def st_panes(spark, sf_dir):
    """Every pane of the five-minute aggregates, with its number and kind, over ordered micro-batches with two days of
    lateness; the stream is drained at the end, so each aggregate has a final pane."""
    root = _ingested(spark, sf_dir, "panes", LONG_AGO, PANE_LATENESS, partial(panes.start, outputs=["panes"]))
    batches = ingest.counters(spark, root).count()
    panes.emit_panes(spark, root, batches, F.current_timestamp(), PANE_LATENESS, drain=True)
    return panes.panes(spark, root).drop("version_emitted_at")


def st_session_batches(spark, sf_dir):
    """Session metrics of the events on time, kept up by ordered micro-batches that store touched sessions only."""
    root = _ingested(spark, sf_dir, "session-batches", LONG_AGO, PANE_LATENESS, partial(panes.start, outputs=["sessions"]))
    current = sessions.session_windows_current(panes.session_versions(spark, root))
    return current.drop("version_emitted_at", "processed_at", "batch_id")


def st_stream_dedup(spark, sf_dir):
    """Deduplicated, enriched events from the stream; which copy of an event survives is not fixed."""
    root = work_path(spark, "dedup")
    products = staging.stg_products(sample.products(spark, sf_dir))
    query = clickstream.land_events(
        _click_stream(spark, sf_dir), products, f"{root}/t", f"{root}/state", ttl_seconds=LONG_AGO
    )
    finish(query)
    return spark.read.parquet(f"{root}/t").select(
        "event_id", "session_id", "event_type", "page_type", "product_id", "product_name", "is_conversion"
    )


def st_stream_5m(spark, sf_dir):
    """Five-minute aggregates from the stream, latest version of each."""
    root = work_path(spark, "agg")
    finish(clickstream.start_aggregates(_first_events(spark, sf_dir, root), f"{root}/t", f"{root}/state", LONG_AGO))
    versions = spark.read.parquet(f"{root}/t").drop("batch_id")
    return clicks.events_5m_latest(versions).drop("version_emitted_at")


def st_session_early(spark, sf_dir):
    """Session metrics from the stream, latest version of each window."""
    root = work_path(spark, "sessions")
    finish(
        clickstream.start_sessions(
            _first_events(spark, sf_dir, root), f"{root}/t", f"{root}/cells", f"{root}/state", lateness_seconds=LONG_AGO
        )
    )
    versions = spark.read.parquet(f"{root}/t").drop("batch_id")
    return sessions.session_window_latest(versions).drop("version_emitted_at", "processed_at")


def inc_upsert(spark, sf_dir):
    """A stored order table of lower-case statuses upserted with the orders created from mid-2000 on."""
    path = work_path(spark, "upsert-target")
    rows = staging.stg_orders(sample.orders(spark, sf_dir)).select("order_id", "status", "created_at", "num_of_item")
    target = rows.where("created_at < TIMESTAMP'2001-01-01'").withColumn("status", F.lower("status"))
    incremental.write_table(target, path, day="created_at", cluster=("order_id",), grain="month")
    delta = rows.where("created_at >= TIMESTAMP'2000-07-01'")
    incremental.upsert_table(delta, path, ("order_id",), day="created_at", grain="month")
    return incremental.read_table(spark, path).drop("part_date")


def _refreshed(name: str):
    """A mart built from the changes before 1999 and refreshed with all later ones."""

    def run(spark, sf_dir):
        from tidemark.plans.catalog import plain, warehouse

        lake = refresh.Lake(spark, work_path(spark, f"lake-{name}"), [name], grain="year", keep_old=False)
        current = warehouse(spark, sf_dir)
        lake.build(refresh.sources_until(current, INCREMENT_FROM))
        lake.refresh(current)
        return plain(lake[name].drop("part_date"))

    run.__doc__ = f"{name}: {_refreshed.__doc__[2:]}"
    return run


def snap_replace(spark, sf_dir):
    """A snapshot written twice: the second replaces the first."""
    path = work_path(spark, "snapshot")
    rows = readers.snapshot_rows(sample.products(spark, sf_dir).where("cdc_operation = 'c'"), "products", SNAPSHOT_MS)
    rows.where("id % 2 = 0").write.parquet(path)
    rows.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path).select("id", "retail_price", "cdc_timestamp", "cdc_operation")


def src_jdbc_full(spark, sf_dir):
    """Rows of a full export, from the order headers standing in for the database table."""
    rows = sample.orders(spark, sf_dir).where("cdc_operation = 'c'")
    return readers.snapshot_rows(rows, "orders", SNAPSHOT_MS)


def src_jdbc_initial(spark, sf_dir):
    """Rows of an initial load with text dates, some missing."""
    rows = sample.orders(spark, sf_dir).where("cdc_operation = 'c'").select(
        "order_id", "status",
        F.when(F.col("order_id") % 10 != 0, F.date_format("created_at", "yyyy-MM-dd HH:mm:ss")).alias("created_at"),
        F.when(F.col("order_id") % 4 == 0, "n/a").otherwise(F.date_format("shipped_at", "yyyy-MM-dd")).alias("shipped_at"),
    )
    return readers.initial_rows(rows, F.lit("2024-02-01 00:00:00").cast("timestamp"), SNAPSHOT_MS)


def src_csv_shift(spark, sf_dir):
    """Orders written as CSV, read back typed and moved by five years."""
    path = work_path(spark, "csv")
    columns = ("order_id", "user_id", "status", "created_at", "shipped_at")
    rows = sample.orders(spark, sf_dir).where("cdc_operation = 'c'").select(*columns)
    rows.write.option("header", "true").option("timestampFormat", "yyyy-MM-dd HH:mm:ss").csv(path)
    return readers.read_csv(spark, path, "orders", years=5)


def src_product_lookup(spark, sf_dir):
    """The lookup side of the enrichment, from the CSV because the table is missing."""
    path = work_path(spark, "products")
    rows = sample.products(spark, sf_dir).where("cdc_operation = 'c'").select("id", "category", "department", "name")
    rows.write.option("header", "true").csv(f"{path}/csv")
    found = readers.read_products(spark, f"{path}/table", f"{path}/csv")
    return clicks.product_lookup(found).withColumnRenamed("_product", "product_id")


JOBS = {
    "src_cdc_stream": src_cdc_stream,
    "src_clickstream": src_clickstream,
    "sink_hot_events": sink_hot_events,
    "sink_cold_parquet": sink_cold_parquet,
    "src_hive_parquet": src_hive_parquet,
    "sink_raw_replay": sink_raw_replay,
    "sink_append_table": sink_append_table,
    "st_stream_split": st_stream_split,
    "st_counters": st_counters,
    "st_counters_by_batch": st_counters_by_batch,
    "st_lateness": st_lateness,
    "st_late_repair": st_late_repair,
    "st_panes": st_panes,
    "st_session_batches": st_session_batches,
    "st_stream_dedup": st_stream_dedup,
    "st_stream_5m": st_stream_5m,
    "st_session_early": st_session_early,
    "inc_upsert": inc_upsert,
    **{f"inc_{name}": _refreshed(name) for name in refresh.MARTS if not name.startswith("dim_")},
    "snap_replace": snap_replace,
    "src_jdbc_full": src_jdbc_full,
    "src_jdbc_initial": src_jdbc_initial,
    "src_csv_shift": src_csv_shift,
    "src_product_lookup": src_product_lookup,
}
