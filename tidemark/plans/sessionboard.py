"""Session queries. Inputs: ``sessions`` = latest version per session id, ``versions`` = every emitted one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import band, safe_divide, whole_seconds
from tidemark.operators.shape import one_row, top
from tidemark.plans.clickboard import Sources, _blank, _or_unknown, _scope, p95

# Upper edges of the length bands in seconds, and the length of an unusually long session.
LENGTH_BANDS = (
    (60, "0-1m"), (180, "1-3m"), (300, "3-5m"), (600, "5-10m"), (900, "10-15m"), (1800, "15-30m"),
)
LONGEST_BAND = "30m+"
LONG_SECONDS = 1800
FUNNEL = (("Home", "saw_home"), ("Product", "saw_product"), ("Cart", "added_to_cart"), ("Purchase", "purchased"))


def _in_range(frame: DataFrame, start, end, sources: Sources) -> DataFrame:
    return _scope(frame, start, end, sources, date="session_date")


def _bought() -> Column:
    return F.count_if("purchased")


def _conversion() -> Column:
    return safe_divide(_bought(), F.count("*"))


def _avg_length() -> Column:
    return F.avg("session_duration_seconds")


def session_flow_health(sessions, versions, start, end, as_of: Column, sources: Sources = None) -> DataFrame:
    checks = _in_range(sessions, start, end, sources).agg(
        F.count("*").alias("latest_sessions"),
        F.count_if(_blank("session_id")).alias("missing_session_id"),
        F.count_if(F.col("session_duration_seconds") < 0).alias("negative_duration_sessions"),
        F.count_if(F.col("event_count") == 0).alias("zero_event_sessions"),
        F.avg("event_count").alias("avg_events_per_session"),
        p95("event_count").alias("p95_events_per_session"),
        _avg_length().alias("avg_session_seconds"),
        p95("session_duration_seconds").alias("p95_session_seconds"),
        F.max("session_end").alias("latest_session_end"),
        F.max("version_emitted_at").alias("latest_version_emitted_at"),
        F.max("processed_at").alias("latest_processed_at"),
    )
    emitted = _in_range(versions, start, end, sources).agg(
        F.count("*").alias("session_metric_versions"), F.count_distinct("session_id").alias("distinct_sessions")
    )
    replaced = F.col("session_metric_versions") - F.col("distinct_sessions")
    return one_row(checks, emitted).select(
        "*",
        replaced.alias("superseded_versions"),
        safe_divide(replaced, F.col("session_metric_versions")).alias("superseded_version_rate"),
        whole_seconds(F.col("latest_processed_at"), as_of).alias("session_freshness_seconds"),
    )


def _hourly(frame, start, end, sources: Sources, **measures: Column) -> DataFrame:
    hour = F.date_trunc("hour", "session_start").alias("session_hour")
    grouped = _in_range(frame, start, end, sources).groupBy(hour)
    return grouped.agg(*[m.alias(name) for name, m in measures.items()]).orderBy("session_hour")


def sessionization_timeseries(sessions, start, end, sources: Sources = None) -> DataFrame:
    return _hourly(
        sessions, start, end, sources,
        sessions=F.count("*"),
        events_in_sessions=F.sum("event_count"),
        avg_events_per_session=F.avg("event_count"),
        avg_session_seconds=_avg_length(),
        latest_version_emitted_at=F.max("version_emitted_at"),
    )


def session_timeseries(sessions, start, end, sources: Sources = None) -> DataFrame:
    return _hourly(
        sessions, start, end, sources,
        sessions=F.count("*"), purchased_sessions=_bought(), avg_session_seconds=_avg_length(),
    )


def _stacked(counted: DataFrame, label: str, value: str) -> DataFrame:
    """One row of counters → one row per counter."""
    return counted.unpivot([], counted.columns, label, value)


def session_anomaly_buckets(sessions, start, end, sources: Sources = None) -> DataFrame:
    events, length = F.col("event_count"), F.col("session_duration_seconds")
    counted = _in_range(sessions, start, end, sources).agg(
        F.count_if(events == 0).alias("zero_event_sessions"),
        F.count_if(events == 1).alias("single_event_sessions"),
        F.count_if(length < 0).alias("negative_duration_sessions"),
        F.count_if(length > LONG_SECONDS).alias("long_sessions_over_30m"),
    )
    return _stacked(counted, "check_name", "sessions")


def session_versions_by_hour(versions, start, end, sources: Sources = None) -> DataFrame:
    hour = F.date_trunc("hour", "version_emitted_at").alias("emitted_hour")
    return (
        _in_range(versions, start, end, sources)
        .groupBy(hour)
        .agg(F.count("*").alias("emitted_versions"), F.count_distinct("session_id").alias("distinct_sessions"))
        .withColumn("superseded_versions", F.col("emitted_versions") - F.col("distinct_sessions"))
        .orderBy("emitted_hour")
    )


def session_summary(sessions, start, end, sources: Sources = None) -> DataFrame:
    return _in_range(sessions, start, end, sources).agg(
        F.count("*").alias("total_sessions"),
        _avg_length().alias("avg_session_seconds"),
        F.percentile_approx("session_duration_seconds", 0.5).alias("median_session_seconds"),
        F.avg("event_count").alias("avg_event_count"),
        F.avg("pageview_count").alias("avg_pageviews"),
        F.avg("product_view_count").alias("avg_product_views"),
        safe_divide(F.count_if("added_to_cart"), F.count("*")).alias("cart_rate"),
        _conversion().alias("conversion_rate"),
    )


def _funnel_counts(sessions, start, end, sources: Sources) -> DataFrame:
    return _in_range(sessions, start, end, sources).agg(*[F.count_if(flag).alias(stage) for stage, flag in FUNNEL])


def conversion_funnel(sessions, start, end, sources: Sources = None) -> DataFrame:
    return _stacked(_funnel_counts(sessions, start, end, sources), "stage", "sessions")


def funnel_dropoff(sessions, start, end, sources: Sources = None) -> DataFrame:
    steps = [
        F.struct(
            F.lit(f"{a} -> {b}").alias("transition"), F.col(a).alias("from_sessions"), F.col(b).alias("to_sessions")
        )
        for (a, _), (b, _) in zip(FUNNEL, FUNNEL[1:])
    ]
    return _funnel_counts(sessions, start, end, sources).select(F.inline(F.array(*steps)))


def session_duration_histogram(sessions, start, end, sources: Sources = None) -> DataFrame:
    label, rank = band(F.col("session_duration_seconds"), LENGTH_BANDS, LONGEST_BAND)
    return (
        _in_range(sessions, start, end, sources)
        .groupBy(label.alias("duration_bucket"), rank.alias("bucket_order"))
        .agg(F.count("*").alias("sessions"))
        .orderBy("bucket_order")
    )


def _cvr_by(column: str, sessions, start, end, sources: Sources) -> DataFrame:
    return (
        _in_range(sessions, start, end, sources)
        .groupBy(column)
        .agg(
            F.count("*").alias("sessions"),
            _bought().alias("purchased_sessions"),
            _conversion().alias("conversion_rate"),
            _avg_length().alias("avg_session_seconds"),
        )
        .orderBy(F.col("sessions").desc(), column)
    )


def cvr_by_channel(sessions, start, end, sources: Sources = None) -> DataFrame:
    return _cvr_by("traffic_source", sessions, start, end, sources)


def cvr_by_browser(sessions, start, end, sources: Sources = None) -> DataFrame:
    return _cvr_by("browser", sessions, start, end, sources)


def top_categories(sessions, start, end, sources: Sources = None, limit: int = 12) -> DataFrame:
    grouped = (
        _in_range(sessions, start, end, sources)
        .groupBy(_or_unknown("top_category").alias("top_category"))
        .agg(
            F.count("*").alias("sessions"),
            _bought().alias("purchased_sessions"),
            _conversion().alias("conversion_rate"),
            _avg_length().alias("avg_session_seconds"),
            F.avg("product_view_count").alias("avg_product_views"),
        )
    )
    return top(grouped, limit, F.col("sessions").desc(), "top_category")


def session_quality(sessions, start, end, sources: Sources = None, limit: int = 20) -> DataFrame:
    grouped = (
        _in_range(sessions, start, end, sources)
        .groupBy("traffic_source", "browser")
        .agg(
            F.count("*").alias("sessions"),
            _avg_length().alias("avg_session_seconds"),
            F.avg("event_count").alias("avg_event_count"),
            F.avg("pageview_count").alias("avg_pageviews"),
            _conversion().alias("conversion_rate"),
        )
    )
    return top(grouped, limit, F.col("sessions").desc(), "traffic_source", "browser")
