"""Clickstream monitoring queries.

Inputs: ``raw`` = enriched events, ``clean`` = the same without duplicate ids, ``windows`` = latest
five-minute aggregates, ``dead`` = dead letters. ``sources`` restricts to traffic sources; none = all.
Distinct counts next to plain counts run over one row per visitor and session.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import between_dates, in_list, on_dates, safe_divide, whole_seconds
from tidemark.operators.clicks import WINDOW_SECONDS
from tidemark.operators.shape import one_row, top

Sources = Sequence[str] | None


def _scope(frame: DataFrame, start, end, sources: Sources, date: str = "event_date") -> DataFrame:
    return frame.where(on_dates(date, start, end) & in_list("traffic_source", sources))


def _failed(dead: DataFrame, start, end) -> DataFrame:
    return dead.where(between_dates("failed_at", start, end))


def _purchases() -> Column:
    return F.count_if(F.col("event_type") == "purchase")


def _or_unknown(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit("Unknown"))


def _blank(column: str) -> Column:
    return F.col(column).isNull() | (F.trim(column) == "")


def p95(column: str) -> Column:
    return F.percentile_approx(column, 0.95)


def traffic_sources(clean, start, end) -> DataFrame:
    found = _scope(clean, start, end, None).where(F.col("traffic_source").isNotNull())
    return found.select("traffic_source").distinct().orderBy("traffic_source")


def overview_metrics(clean, start, end, sources: Sources = None) -> DataFrame:
    visits = (
        _scope(clean, start, end, sources)
        .groupBy("session_id", "user_id")
        .agg(F.count("*").alias("n"), _purchases().alias("buys"))
    )
    sessions, buys = F.count_distinct("session_id"), F.coalesce(F.sum("buys"), F.lit(0))
    return visits.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_events"),
        sessions.alias("total_sessions"),
        F.count_distinct("user_id").alias("total_users"),
        buys.alias("purchase_events"),
        safe_divide(buys, sessions).alias("conversion_rate"),
    )


def daily_events_purchases(clean, start, end, sources: Sources = None) -> DataFrame:
    daily = _scope(clean, start, end, sources).groupBy("event_date")
    return daily.agg(F.count("*").alias("total_events"), _purchases().alias("purchase_events")).orderBy("event_date")


def channel_distribution(clean, start, end, sources: Sources = None) -> DataFrame:
    return (
        _scope(clean, start, end, sources)
        .groupBy("traffic_source")
        .agg(
            F.count("*").alias("total_events"),
            F.count_distinct("session_id").alias("sessions"),
            _purchases().alias("purchases"),
        )
        .orderBy(F.col("total_events").desc(), "traffic_source")
    )


def _per_window(windows, start, end, sources: Sources, **measures: Column) -> DataFrame:
    grouped = _scope(windows, start, end, sources).groupBy("window_start")
    return grouped.agg(*[m.alias(name) for name, m in measures.items()]).orderBy("window_start")


def realtime_windows(windows, start, end, sources: Sources = None) -> DataFrame:
    return _per_window(
        windows, start, end, sources,
        total_events=F.sum("total_events"),
        purchase_events=F.sum("purchase_events"),
        avg_event_lag_seconds=F.avg("avg_event_lag_seconds"),
    )


def event_lag_timeseries(windows, start, end, sources: Sources = None) -> DataFrame:
    return _per_window(
        windows, start, end, sources,
        avg_event_lag_seconds=F.avg("avg_event_lag_seconds"),
        total_events=F.sum("total_events"),
    )


def throughput_by_window(windows, start, end, sources: Sources = None) -> DataFrame:
    """Totals per window; unique counts are sums over the window's groups, not distinct counts."""
    return _per_window(
        windows, start, end, sources,
        total_events=F.sum("total_events"),
        unique_sessions=F.sum("unique_sessions"),
        unique_users=F.sum("unique_users"),
        avg_event_lag_seconds=F.avg("avg_event_lag_seconds"),
        events_per_second=safe_divide(F.sum("total_events"), F.lit(WINDOW_SECONDS)),
        version_emitted_at=F.max("version_emitted_at"),
    )


def approx_uniques_by_window(clean, start, end, sources: Sources = None) -> DataFrame:
    """Estimated distinct sessions and users per window, from sketches that can be merged."""
    window = F.window("event_timestamp", f"{WINDOW_SECONDS} seconds").start.alias("window_start")
    grouped = _scope(clean, start, end, sources).groupBy(window)
    return grouped.agg(
        F.approx_count_distinct("session_id", 0.01).alias("unique_sessions"),
        F.approx_count_distinct("user_id", 0.01).alias("unique_users"),
    ).orderBy("window_start")


def event_type_windows(windows, start, end, sources: Sources = None) -> DataFrame:
    return (
        _scope(windows, start, end, sources)
        .groupBy("window_start", _or_unknown("event_type").alias("event_type"))
        .agg(F.sum("total_events").alias("total_events"))
        .orderBy("window_start", "event_type")
    )


def event_type_breakdown(clean, start, end, sources: Sources = None) -> DataFrame:
    return (
        _scope(clean, start, end, sources)
        .groupBy("event_type")
        .agg(F.count("*").alias("total_events"))
        .orderBy(F.col("total_events").desc(), "event_type")
    )


def deadletter_monitor(dead, start, end, as_of: Column) -> DataFrame:
    return _failed(dead, start, end).agg(
        F.count("*").alias("deadletter_count"),
        F.count_if(F.to_date("failed_at") == F.to_date(as_of)).alias("deadletter_today"),
        F.max("failed_at").alias("latest_failure_at"),
    )


def deadletter_samples(dead, start, end, limit: int = 8) -> DataFrame:
    newest = top(_failed(dead, start, end), int(limit), F.col("failed_at").desc(), "raw_message")
    return newest.select("failed_at", "error_message", "raw_message")


def deadletter_timeseries(dead, start, end) -> DataFrame:
    hour = F.date_trunc("hour", "failed_at").alias("failed_hour")
    return _failed(dead, start, end).groupBy(hour).agg(F.count("*").alias("deadletter_count")).orderBy("failed_hour")


def flow_health(windows, clean, dead, start, end, sources: Sources = None) -> DataFrame:
    """Aggregates, events and dead letters of the range side by side."""
    aggregated = _scope(windows, start, end, sources).agg(
        F.sum("total_events").alias("realtime_events"),
        F.sum("purchase_events").alias("realtime_purchases"),
        F.avg("avg_event_lag_seconds").alias("avg_event_lag_seconds"),
        F.max("window_start").alias("latest_window_start"),
    )
    events = _scope(clean, start, end, sources).agg(
        F.count("*").alias("raw_events"),
        F.max("event_timestamp").alias("latest_event_timestamp"),
        F.max("processing_time").alias("latest_processing_time"),
    )
    failures = _failed(dead, start, end).agg(F.count("*").alias("deadletter_count"))
    return one_row(aggregated, events, failures).withColumn(
        "deadletter_rate", safe_divide(F.col("deadletter_count"), F.col("raw_events"))
    )


def source_event_flow(clean, start_at: str, end_at: str, sources: Sources = None, limit: int | None = None) -> DataFrame:
    """Events per (source, type) between two instants, both included."""
    first, last = F.lit(start_at).cast("timestamp"), F.lit(end_at).cast("timestamp")
    grouped = (
        clean.where(
            F.col("event_date").between(F.to_date(first), F.to_date(last))
            & F.col("event_timestamp").between(first, last)
            & in_list("traffic_source", sources)
        )
        .groupBy(_or_unknown("traffic_source").alias("traffic_source"), _or_unknown("event_type").alias("event_type"))
        .agg(F.count("*").alias("total_events"))
        .where("total_events > 0")
    )
    return top(grouped, limit, F.col("total_events").desc(), "traffic_source", "event_type")


def ingestion_freshness(clean, windows, start, end, as_of: Column, sources: Sources = None) -> DataFrame:
    events = _scope(clean, start, end, sources).agg(
        F.count("*").alias("dedup_events"),
        F.max("event_timestamp").alias("latest_event_timestamp"),
        F.max("ingested_at").alias("latest_ingested_at"),
        F.max("processing_time").alias("latest_processing_time"),
        F.avg("event_lag_seconds").alias("avg_event_lag_seconds"),
        p95("event_lag_seconds").alias("p95_event_lag_seconds"),
    )
    aggregated = _scope(windows, start, end, sources).agg(
        F.max("window_start").alias("latest_window_start"),
        F.max("version_emitted_at").alias("latest_window_emitted_at"),
        F.count_distinct("window_start").alias("emitted_windows"),
        F.sum("total_events").alias("window_events"),
    )
    return one_row(events, aggregated).select(
        "*",
        whole_seconds(F.col("latest_processing_time"), as_of).alias("processing_freshness_seconds"),
        whole_seconds(F.col("latest_window_emitted_at"), as_of).alias("aggregate_freshness_seconds"),
    )


def event_quality_summary(raw, clean, dead, start, end, sources: Sources = None) -> DataFrame:
    checks = _scope(raw, start, end, sources).agg(
        F.count("*").alias("raw_rows"),
        F.count_distinct("event_id").alias("distinct_event_ids"),
        F.count_if(_blank("session_id")).alias("missing_session_id"),
        F.count_if(F.col("user_id").isNull()).alias("missing_user_id"),
        F.count_if(_blank("event_type")).alias("missing_event_type"),
        F.count_if(F.col("event_timestamp").isNull()).alias("missing_event_timestamp"),
        F.count_if(F.col("event_lag_seconds") < 0).alias("negative_lag_events"),
    )
    kept = _scope(clean, start, end, sources).agg(F.count("*").alias("dedup_rows"))
    failures = _failed(dead, start, end).agg(F.count("*").alias("deadletter_rows"))
    rows, removed, failed = F.col("raw_rows"), F.col("raw_rows") - F.col("dedup_rows"), F.col("deadletter_rows")
    return one_row(checks, kept, failures).select(
        "*",
        removed.alias("duplicate_rows_removed"),
        safe_divide(removed, rows).alias("duplicate_rate"),
        safe_divide(failed, rows + failed).alias("reject_rate"),
    )


def quality_by_event_type(clean, start, end, sources: Sources = None) -> DataFrame:
    return (
        _scope(clean, start, end, sources)
        .groupBy(_or_unknown("event_type").alias("event_type"))
        .agg(
            F.count("*").alias("total_events"),
            F.count_if(_blank("session_id")).alias("missing_session_id"),
            F.count_if(F.col("user_id").isNull()).alias("missing_user_id"),
            F.avg("event_lag_seconds").alias("avg_event_lag_seconds"),
            p95("event_lag_seconds").alias("p95_event_lag_seconds"),
        )
        .orderBy(F.col("total_events").desc(), "event_type")
    )


def source_browser_matrix(windows, start, end, sources: Sources = None, limit: int | None = None) -> DataFrame:
    grouped = (
        _scope(windows, start, end, sources)
        .groupBy(_or_unknown("traffic_source").alias("traffic_source"), _or_unknown("browser").alias("browser"))
        .agg(
            F.sum("total_events").alias("total_events"),
            F.sum("unique_sessions").alias("unique_sessions"),
            F.avg("avg_event_lag_seconds").alias("avg_event_lag_seconds"),
        )
    )
    return top(grouped, limit, F.col("total_events").desc(), "traffic_source", "browser")


def popular_pages(clean, start, end, sources: Sources = None, limit: int = 12) -> DataFrame:
    grouped = (
        _scope(clean, start, end, sources)
        .groupBy("uri", "page_type")
        .agg(
            F.count("*").alias("total_events"),
            F.count_distinct("session_id").alias("sessions"),
            _purchases().alias("purchases"),
        )
    )
    return top(grouped, limit, F.col("total_events").desc(), "uri", "page_type")
