"""Wires bronze tables to staging, marts and clickstream tables.

``Warehouse`` builds each model as a lazy frame on first use, so a query over it is one plan in which
Catalyst prunes columns and pushes filters through every layer. ``publish`` writes models as Parquet
tables in dependency order and continues from the written ones, as a scheduled build would.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import between_dates, on_dates
from tidemark.operators import clicks, incremental, sessions
from tidemark.plans import aggregates, dimensions, facts
from tidemark.plans.staging import STAGING
from tidemark.session import freeing_shuffles, work_path

# Tables written by a build, each with the column whose day partitions it and the columns it is
# clustered by within a day.
LAYOUT: dict[str, tuple[str | None, tuple[str, ...]]] = {
    "dim_date": (None, ()),
    "dim_distribution_centers": (None, ()),
    "dim_products": (None, ()),
    "dim_users": (None, ()),
    "fact_events": ("created_at", ("event_id",)),
    "fact_inventory": ("created_at", ("inventory_item_id",)),
    "fact_order_items": ("created_at", ("order_item_id",)),
    "fact_orders": ("created_at", ("order_id",)),
    "agg_dashboard_daily": (None, ()),
    "agg_user_stats": (None, ()),
    "events_raw": ("event_date", ("event_type", "traffic_source", "browser")),
    "events_5m": ("event_date", ("aggregate_id",)),
    "session_metrics": ("session_date", ("session_record_id",)),
    "events_deadletter": ("failed_at", ()),
}

# Thinner layers a stored fact stands in for.
LAYERS = {
    "fact_events": ("event_visits",),
    "fact_inventory": ("stock_measures",),
    "fact_order_items": ("item_lines", "item_measures", "item_money"),
    "fact_orders": ("order_headers", "order_revenue", "order_measures"),
}

Model = Callable[["Warehouse"], DataFrame]


class Warehouse(Mapping[str, DataFrame]):
    """Models by name over a set of input frames.

    ``inputs`` holds the bronze tables by source name and, for the clickstream, ``clicks`` (valid events)
    and ``dead_letters``. ``as_of`` is the instant that counts as now.
    """

    def __init__(
        self,
        inputs: Mapping[str, Callable[[], DataFrame]],
        as_of: Column,
        processed_at: Column | None = None,
        deletes: str = "ignore",
        clustering_gap: int = sessions.GAP_SECONDS,
    ) -> None:
        self._inputs = inputs
        self.as_of = as_of
        self.processed_at = as_of if processed_at is None else processed_at
        self.deletes = deletes
        self.gap = clustering_gap
        self._frames: dict[str, DataFrame] = {}
        self._stored: dict[str, DataFrame] = {}  # tables, with the day of their folders

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name in self._inputs:
                self._frames[name] = self._inputs[name]()
            elif name in STAGING:
                stage, source = STAGING[name]
                self._frames[name] = stage(self[source], self.deletes)
            else:
                self._frames[name] = MODELS[name](self)
        return self._frames[name]

    def current(self, name: str, *columns: str) -> DataFrame:
        """The key and the given columns of a staged table, without shuffling columns that cannot change them. The
        staged table itself is read where it is at hand."""
        if name in self._frames:
            return self._frames[name]
        stage, source = STAGING[name]
        return stage(self[source], self.deletes, wanted=columns)

    def __iter__(self):
        return iter([*self._inputs, *STAGING, *MODELS])

    def __len__(self) -> int:
        return len(list(iter(self)))

    def publish(self, spark: SparkSession, root: str, names: Iterable[str] = LAYOUT) -> Warehouse:
        """Write ``names`` below ``root`` in the given order; later models read the written tables."""
        for name in names:
            day, cluster = LAYOUT[name]
            path = f"{root}/{name}"
            incremental.write_table(self[name], path, day, cluster)
            self._store(name, incremental.read_table(spark, path))
        return self

    def aside(self, columns: Mapping[str, Iterable[str]]) -> Warehouse:
        """A warehouse over the given columns of models, each computed once, in the given order, and kept below the
        shared folder; later ones read those before them. For a job that needs the same models many times."""
        out = Warehouse(self._inputs, self.as_of, self.processed_at, self.deletes, self.gap)
        for name, wanted in columns.items():
            frame = out[name].select(*wanted)
            path = work_path(frame.sparkSession, f"aside-{name}")
            with freeing_shuffles(frame.sparkSession):
                frame.write.parquet(path)
            table = frame.sparkSession.read.schema(frame.schema).parquet(path)
            out._frames |= {model: table for model in (name, *LAYERS.get(name, ()))}
            if name == "fact_inventory":  # every staged item under the same key; what its order items ask for
                out._frames["stg_inventory_items"] = table.withColumnRenamed("distribution_center_id", "product_distribution_center_id")
        return out

    def _store(self, name: str, table: DataFrame) -> None:
        for model in (name, *LAYERS.get(name, ())):
            self._stored[model] = table
            self._frames[model] = table.drop("part_date")

    def days(self, name: str, start, end) -> DataFrame:
        """A model for a report over the instants ``created_at`` of whole days, which the report still filters: of a
        stored table only the folders of those days are read."""
        table = self._stored.get(name)
        if table is None or "part_date" not in table.columns:
            return self[name]
        return table.where(on_dates("part_date", start, end)).drop("part_date")

    def daily(self, start, end, side: str = "both") -> DataFrame:
        """The daily aggregate between two days. Where it is no stored table, the range is applied to orders and
        events before they are aggregated, and with one ``side`` (``orders``, ``audience``) the other is not read:
        its days would add nothing to a sum."""
        if "agg_dashboard_daily" in self._stored:
            return self["agg_dashboard_daily"].where(on_dates("date", start, end))
        ranged = between_dates("created_at", start, end)

        def orders() -> DataFrame:
            return self.days("order_measures", start, end).where(ranged)

        def visits() -> DataFrame:
            return self.days("event_visits", start, end).where(ranged)

        if side == "orders":
            return aggregates.daily_orders(orders())
        if side == "audience":
            return aggregates.daily_audience(visits())
        return aggregates.agg_dashboard_daily(orders(), visits(), self.as_of)

    @classmethod
    def open(cls, spark: SparkSession, root: str, as_of: Column, names: Iterable[str] = LAYOUT) -> Warehouse:
        """A warehouse over tables written earlier."""
        opened = cls({}, as_of)
        for name in names:
            opened._store(name, incremental.read_table(spark, f"{root}/{name}"))
        return opened


def _calendar(w: Warehouse) -> DataFrame:
    bounds = dimensions.date_bounds(
        (w["orders"], "created_at"), (w["order_items"], "created_at"), (w["events"], "created_at")
    )
    return dimensions.dim_date(bounds, w.as_of)


def _five_minutes(w: Warehouse) -> DataFrame:
    emitted = F.col("window_end") + F.expr("INTERVAL 10 MINUTES")
    return clicks.aggregate_5m(w["events_first"], emitted)


def _session_versions(w: Warehouse) -> DataFrame:
    emitted = F.timestamp_micros(F.unix_micros("session_end") + w.gap * 1_000_000)
    return sessions.sessions(w["events_first"], emitted, gap_seconds=w.gap)


# Columns of staged rows that the thin layers of the facts are made of.
_MOMENTS = ("created_at", "shipped_at", "delivered_at", "returned_at")
LINE = ("order_id", "user_id", "product_id", "inventory_item_id", "status", *_MOMENTS, "sale_price")
HEADER = ("user_id", "status", *_MOMENTS, "num_of_item", "cdc_timestamp")
VISIT = (
    "user_id", "sequence_number", "session_id", "ip_address", "city", "state", "postal_code", "browser",
    "traffic_source", "event_type", "uri", "created_at",
)

MODELS: dict[str, Model] = {
    "dim_date": _calendar,
    "dim_distribution_centers": lambda w: dimensions.dim_distribution_centers(w["stg_distribution_centers"], w.as_of),
    "dim_products": lambda w: dimensions.dim_products(w["stg_products"], w.as_of),
    "dim_users": lambda w: dimensions.dim_users(w["stg_users"], w.as_of),
    "event_visits": lambda w: facts.event_visits(w.current("stg_events", *VISIT), w.as_of),
    "stock_measures": lambda w: facts.stock_measures(w["stg_inventory_items"], w.as_of),
    "item_lines": lambda w: facts.item_lines(w.current("stg_order_items", *LINE), w.as_of),
    "item_measures": lambda w: facts.item_measures(
        w.current("stg_order_items", *LINE), w.current("stg_inventory_items", "cost", "_place"), w["dim_products"], w.as_of
    ),
    "item_money": lambda w: facts.item_money(
        w.current("stg_order_items", *LINE), w.current("stg_inventory_items", "cost", "_place"), w["dim_products"]
    ),
    "order_headers": lambda w: facts.order_headers(w.current("stg_orders", *HEADER), w.as_of),
    "order_revenue": lambda w: facts.order_revenue(w.current("stg_orders", *HEADER), w["item_lines"], w.as_of),
    "order_measures": lambda w: facts.order_measures(w.current("stg_orders", *HEADER), w["item_money"], w.as_of),
    "fact_events": lambda w: facts.fact_events(w["stg_events"], w["dim_users"], w.as_of),
    "fact_inventory": lambda w: facts.fact_inventory(
        w["stg_inventory_items"], w["dim_products"], w["dim_distribution_centers"], w.as_of
    ),
    "fact_order_items": lambda w: facts.fact_order_items(
        w.current("stg_order_items", *LINE), w.current("stg_inventory_items", "cost", "product_distribution_center_id", "_place"),
        w["dim_users"], w["dim_products"], w["dim_distribution_centers"], w.as_of,
    ),
    "fact_orders": lambda w: facts.fact_orders(w.current("stg_orders", *HEADER), w["item_money"], w["dim_users"], w.as_of),
    "agg_dashboard_daily": lambda w: aggregates.agg_dashboard_daily(w["order_measures"], w["event_visits"], w.as_of),
    "agg_user_stats": lambda w: aggregates.agg_user_stats(w["dim_users"], w["order_revenue"], w.as_of),
    "events_raw": lambda w: clicks.enrich(w["clicks"], w["stg_products"], w.processed_at),
    "events_first": lambda w: clicks.first_seen(w["events_raw"]),
    "events_5m": _five_minutes,
    "session_metrics": _session_versions,
    "events_deadletter": lambda w: w["dead_letters"],
    "v_events_raw_dedup": lambda w: clicks.events_raw_dedup(w["events_raw"]),
    "v_events_5m_latest": lambda w: clicks.events_5m_latest(w["events_5m"]),
    "v_session_metrics_latest": lambda w: sessions.session_metrics_latest(w["session_metrics"]),
    "v_session_funnel": lambda w: clicks.session_funnel(w["v_session_metrics_latest"]),
    "v_daily_channel_kpis": lambda w: clicks.daily_channel_kpis(w["v_events_raw_dedup"]),
    "v_product_interest": lambda w: clicks.product_interest(w["v_events_raw_dedup"]),
}
