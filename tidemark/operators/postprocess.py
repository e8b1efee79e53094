"""Reshaping of report frames for display: long form, trimming, scaling, map weights, funnel edges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import floor_to_bucket, safe_divide

# Amounts above a million at the 95th percentile are stored in billionths.
RAW_MONEY_LIMIT = 1_000_000
RAW_MONEY_SCALE = 1_000_000_000


def melt(frame: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "metric", value: str = "value"):
    return frame.unpivot(list(ids), list(values), name, value)


def filter_time(frame: DataFrame, column: str, start: Column, end: Column, bucket_seconds: int | None = None):
    """Rows with ``column`` between two instants; with a bucket length the start is floored, so that the
    bucket it falls into is kept."""
    first = start if bucket_seconds is None else floor_to_bucket(start, bucket_seconds)
    return frame.where(F.col(column).between(first, end))


def scaled_money(frame: DataFrame, column: str, name: str) -> DataFrame:
    """Adds ``name``: the amount, divided by a billion when the 95th percentile says it is unscaled."""
    amount = F.coalesce(F.col(column).cast("double"), F.lit(0.0))
    p95 = frame.agg(F.percentile_approx(amount, 0.95, 10_000).alias("p95")).scalar()
    return frame.withColumn(
        name, F.when(p95 > RAW_MONEY_LIMIT, amount / F.lit(float(RAW_MONEY_SCALE))).otherwise(amount)
    )


def trimmed_histogram(frame: DataFrame, column: str, bins: int = 30, top_share: float = 0.99) -> DataFrame:
    """Positive values up to the given percentile in ``bins`` equal-width bins: bin, low, high, rows.

    The percentile is approximate (an element of the table), so that tasks pre-aggregate bounded sketches.
    """
    value = F.col(column).cast("double")
    positive = frame.where(value > 0).select(value.alias("v"))
    kept = positive.where(F.col("v") <= positive.agg(F.percentile_approx("v", top_share, 10_000).alias("cut")).scalar())
    ends = kept.agg(F.min("v").alias("low"), F.max("v").alias("high"))
    low, high = ends.select("low").scalar(), ends.select("high").scalar()
    width = (high - low) / F.lit(bins)
    number = F.when(high == low, F.lit(0)).otherwise(
        F.least(F.floor((F.col("v") - low) / width), F.lit(bins - 1))
    )
    return (
        kept.select(number.cast("int").alias("bin"), low.alias("_low"), width.alias("_width"))
        .groupBy("bin")
        .agg(F.count("*").alias("rows"), F.first("_low").alias("_low"), F.first("_width").alias("_width"))
        .select(
            "bin",
            (F.col("_low") + F.col("bin") * F.col("_width")).alias("low"),
            (F.col("_low") + (F.col("bin") + 1) * F.col("_width")).alias("high"),
            "rows",
        )
    )


def _located(frame: DataFrame) -> DataFrame:
    return frame.where("latitude IS NOT NULL AND longitude IS NOT NULL AND latitude <> 0 AND longitude <> 0")


def city_weights(cities: DataFrame) -> DataFrame:
    """Places with coordinates, weighted by orders plus users (fixed radius curve)."""
    score = F.greatest((F.col("order_count") + F.col("user_count")).cast("double"), F.lit(1.0))
    scored = _located(cities).withColumn("heat_score", score)
    share = F.col("heat_score") / scored.agg(F.max("heat_score").alias("m")).scalar()
    return scored.select(
        "city", F.col("latitude").alias("lat"), F.col("longitude").alias("lon"), "user_count", "order_count",
        "heat_score",
        (45000 + F.pow(share, F.lit(0.52)) * 260000).alias("radius"),
        (95 + 145 * F.pow(share, F.lit(0.35))).cast("int").alias("alpha"),
    )


def center_weights(centers: DataFrame) -> DataFrame:
    """Distribution centers with coordinates, weighted by available items (fixed radius curve)."""
    located = _located(centers)
    most = located.agg(F.max("available_items").cast("double").alias("m")).scalar()
    most = F.coalesce(F.nullif(most, F.lit(0.0)), F.lit(1.0))
    slow_share = F.least(F.col("slow_moving_items") / most, F.lit(1.0))
    return located.withColumn(
        "radius", 35000 + F.pow(F.col("available_items") / most, F.lit(0.55)) * 180000
    ).withColumn("alpha", (95 + 145 * slow_share).cast("int"))


def top_trend(trend: DataFrame, performance: DataFrame, label: str, n: int) -> DataFrame:
    """Trend rows of the ``n`` best labels by revenue."""
    best = performance.orderBy(F.col("revenue").desc(), label).limit(n).select(label)
    return trend.join(best, label).select(*trend.columns)


def with_margin_pct(frame: DataFrame) -> DataFrame:
    share = safe_divide(F.col("margin"), F.col("revenue"))
    return frame.withColumn("margin_pct", F.coalesce(share, F.lit(0.0)))


def window_rollup(windows: DataFrame, start: Column, end: Column, bucket_seconds: int = 300) -> DataFrame:
    """Per event type totals of the windows in a time range."""
    kept = filter_time(windows, "window_start", start, end, bucket_seconds)
    grouped = kept.groupBy("event_type").agg(F.sum("total_events").alias("total_events"))
    return grouped.orderBy(F.col("total_events").desc(), "event_type")


def funnel_links(funnel: DataFrame, stages: Sequence[str]) -> DataFrame:
    """Edges between consecutive stages, weighted by the later stage. The frame has one row per stage."""
    position = F.array_position(F.array(*[F.lit(s) for s in stages]), F.col("stage")).cast("int")
    ordered = Window.partitionBy(F.lit(0)).orderBy("_at")
    return (
        funnel.withColumn("_at", position)
        .select(
            F.col("stage").alias("source"),
            F.lead("stage").over(ordered).alias("target"),
            F.lead("sessions").over(ordered).alias("value"),
        )
        .where("target IS NOT NULL")
    )
