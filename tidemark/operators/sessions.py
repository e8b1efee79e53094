"""Session windows and their metrics, from time cells.

A cell holds the events of one session id inside one aligned interval as long as the session gap. Two
events of a cell are less than a gap apart, so a cell never spans two sessions, and sessions follow from
the cells' first and last instants alone. Cells are ordinary partial aggregates: however many events one
session id has, what reaches its sort is one row per interval and category. Cells of separate batches add
up, which is what the streaming job keeps as state.

Two events exactly one gap apart belong to different sessions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.shape import latest_by
from tidemark.schemas import PAGEVIEW_TYPES, SESSION_METRICS

GAP_SECONDS = 1800
CELL_KEYS = ("session_id", "cell", "product_category")
_COUNTS = ("event_count", "pageview_count", "product_view_count", "cart_count", "purchase_count", "home_count")


def _first_event() -> Column:
    """Attributes of the earliest event; the id settles equal instants."""
    return F.min(F.struct("event_timestamp", "event_id", "user_id", "traffic_source", "browser"))


def cell_start(instant: Column, gap_seconds: int = GAP_SECONDS) -> Column:
    micros = F.unix_micros(instant)
    return micros - F.pmod(micros, F.lit(gap_seconds * 1_000_000))


def session_cells(events: DataFrame, gap_seconds: int = GAP_SECONDS) -> DataFrame:
    return cells_by(events, cell_start(F.col("event_timestamp"), gap_seconds).alias("cell"))


def cells_by(events: DataFrame, cell: Column) -> DataFrame:
    """Counters per session id, interval and category; ``cell`` is the interval's grouping column."""
    kind, page = F.col("event_type"), F.col("page_type")
    category = F.nullif(F.col("product_category"), F.lit(""))
    return events.groupBy("session_id", cell, category.alias("product_category")).agg(
        F.min("event_timestamp").alias("first_at"),
        F.max("event_timestamp").alias("last_at"),
        _first_event().alias("first_event"),
        F.count("*").alias("event_count"),
        F.count_if(page.isin(*PAGEVIEW_TYPES)).alias("pageview_count"),
        F.count_if(page == "product").alias("product_view_count"),
        F.count_if(kind == "cart").alias("cart_count"),
        F.count_if(kind == "purchase").alias("purchase_count"),
        F.count_if(page == "home").alias("home_count"),
    )


def add_cells(cells: DataFrame, fresh: str) -> DataFrame:
    """Cells of separate batches added up; ``fresh`` marks those of the newest and holds for the sum."""
    return cells.groupBy(*CELL_KEYS).agg(
        F.min("first_at").alias("first_at"),
        F.max("last_at").alias("last_at"),
        F.min("first_event").alias("first_event"),
        *[F.sum(c).alias(c) for c in _COUNTS],
        F.bool_or(fresh).alias(fresh),
    )


def assign_sessions(cells: DataFrame, gap_seconds: int = GAP_SECONDS) -> DataFrame:
    """Adds ``session_cell``: the first cell of the session a cell belongs to."""
    ordered = Window.partitionBy("session_id").orderBy("cell")
    earlier = ordered.rangeBetween(Window.unboundedPreceding, -1)
    so_far = ordered.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    opens_at = F.min("first_at").over(Window.partitionBy("session_id", "cell"))
    silence = F.unix_micros(opens_at) - F.unix_micros(F.max("last_at").over(earlier))
    opens = F.coalesce(silence >= F.lit(gap_seconds * 1_000_000), F.lit(True))
    return (
        cells.withColumn("_opens", F.when(opens, F.col("cell")))
        .withColumn("session_cell", F.max("_opens").over(so_far))
        .drop("_opens")
    )


def session_metrics(assigned: DataFrame, emitted_at: Column, processed_at: Column | None = None) -> DataFrame:
    """One row per session window from cells with a ``session_cell``; ``emitted_at`` may refer to
    ``session_end``. The most frequent category wins, of equals the one seen first."""
    by_category = assigned.groupBy("session_id", "session_cell", "product_category").agg(
        F.min("first_at").alias("first_at"),
        F.max("last_at").alias("last_at"),
        F.min("first_event").alias("first_event"),
        *[F.sum(c).alias(c) for c in _COUNTS],
    )
    rank = F.when(
        F.col("product_category").isNotNull(),
        F.struct(
            F.col("event_count").alias("n"),
            (-F.unix_micros("first_at")).alias("earliness"),
            F.col("product_category").alias("category"),
        ),
    )
    merged = by_category.groupBy("session_id", "session_cell").agg(
        F.min("first_at").alias("session_start"),
        F.max("last_at").alias("session_end"),
        F.min("first_event").alias("first_event"),
        F.max(rank).alias("top"),
        *[F.sum(c).alias(c) for c in _COUNTS],
    )
    duration = (F.unix_micros("session_end") - F.unix_micros("session_start")) / F.lit(1_000_000.0)
    rows = merged.select(
        F.col("session_id").alias("session_record_id"),
        "session_id",
        F.col("first_event.user_id").alias("user_id"),
        F.col("first_event.traffic_source").alias("traffic_source"),
        F.col("first_event.browser").alias("browser"),
        "session_start", "session_end",
        duration.alias("session_duration_seconds"),
        *_COUNTS,
        (F.col("home_count") > 0).alias("saw_home"),
        (F.col("product_view_count") > 0).alias("saw_product"),
        (F.col("cart_count") > 0).alias("added_to_cart"),
        (F.col("purchase_count") > 0).alias("purchased"),
        F.col("top.category").alias("top_category"),
        F.to_date("session_start").alias("session_date"),
    )
    emitted = rows.withColumn("version_emitted_at", emitted_at)
    processed = F.col("version_emitted_at") if processed_at is None else processed_at
    return emitted.withColumn("processed_at", processed).select(*SESSION_METRICS.fieldNames())


def sessions(
    events: DataFrame,
    emitted_at: Column,
    processed_at: Column | None = None,
    gap_seconds: int = GAP_SECONDS,
) -> DataFrame:
    """Session metrics over a batch of enriched events; sessions are measured whole."""
    assigned = assign_sessions(session_cells(events, gap_seconds), gap_seconds)
    return session_metrics(assigned, emitted_at, processed_at)


def session_metrics_latest(versions: DataFrame) -> DataFrame:
    """Latest version per session id; if a gap split the id, the later window wins a tie."""
    return latest_by(versions, ["session_id"], ["version_emitted_at", "session_start"])


def session_window_latest(versions: DataFrame) -> DataFrame:
    """Latest version per session window, so that every window of a split id survives."""
    return latest_by(versions, ["session_id", "session_start"], ["version_emitted_at"])


def session_windows_current(versions: DataFrame) -> DataFrame:
    """The sessions as they stand: versions that a later one contains are left out. Sessions only grow and join, so an
    older version lies inside the window that took it in, also where that window starts earlier."""
    ordered = Window.partitionBy("session_id").orderBy("session_start", F.desc("session_end"), F.desc("event_count"))
    before = F.max("session_end").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    marked = versions.withColumn("_before", before)
    return marked.where(F.col("_before").isNull() | (F.col("session_end") > F.col("_before"))).drop("_before")
