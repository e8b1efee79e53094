"""Incremental builds: from the changes of the source tables to the rows of every mart that they reach.

A build stores, beside its marts, how far each source was read. A refresh takes the source rows that changed since,
carries their keys from table to table (an inventory item to its order items, these to their orders, these to their
days and users), and computes each mart again for its impacted keys alone, with the models of the full build. Keys are
collected before the first mart changes and are stored until the last one has: a refresh that dies half way is repeated
with the same keys, and ends with the tables of one full build.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import UNKNOWN_ID
from tidemark.functions.times import cdc_millis
from tidemark.operators import versioned
from tidemark.plans import aggregates
from tidemark.plans.facts import SLOW_MOVING_DAYS
from tidemark.plans.warehouse import LAYERS, LAYOUT, Warehouse
from tidemark.session import delete_path, freeing_shuffles, work_path

#: Key of each source table.
SOURCES = {
    "distribution_centers": "id", "products": "id", "users": "id", "inventory_items": "id", "order_items": "id",
    "orders": "order_id", "events": "id",
}
#: Key of each table that a refresh keeps up to date, in the order of its steps.
MARTS = {
    "dim_distribution_centers": "distribution_center_id", "dim_products": "product_id", "dim_users": "user_id",
    "fact_inventory": "inventory_item_id", "fact_events": "event_id", "fact_order_items": "order_item_id",
    "fact_orders": "order_id", "agg_dashboard_daily": "date", "agg_user_stats": "user_id",
}
#: Tables that a mart is computed from, or that its keys are carried over.
NEEDS = {
    "fact_inventory": ("dim_products", "dim_distribution_centers"),
    "fact_events": ("dim_users",),
    "fact_order_items": ("dim_products", "dim_distribution_centers", "dim_users", "fact_inventory"),
    "fact_orders": ("fact_order_items",),
    "agg_dashboard_daily": ("fact_orders", "fact_events"),
    "agg_user_stats": ("fact_orders", "dim_users"),
}
#: Source that each table's own rows come from.
SOURCE_OF = {
    "dim_distribution_centers": "distribution_centers", "dim_products": "products", "dim_users": "users",
    "fact_inventory": "inventory_items", "fact_events": "events", "fact_order_items": "order_items", "fact_orders": "orders",
}
#: Days before the newest change seen that are read again, for changes that arrive late.
LATE_DAYS = 3


def closure(names: Iterable[str]) -> list[str]:
    """The tables and all they need, in the order of a refresh."""
    found: set[str] = set()
    waiting = list(names)
    while waiting:
        name = waiting.pop()
        if name not in found:
            found.add(name)
            waiting += NEEDS.get(name, ())
    return [m for m in MARTS if m in found]


def place(name: str, grain: str) -> versioned.Place | None:
    day = "date" if name == "agg_dashboard_daily" else LAYOUT[name][0]
    return versioned.by_day(day, grain) if day else None


class Lake:
    """Marts below one folder, kept up to date with the source tables of a warehouse.

    ``grain`` is the span of one partition (day, month), ``names`` the marts wanted; what they need is kept with them.
    ``keep_old`` keeps the versions before a refresh, for readers that still use them; without it each goes as soon as
    the next one of its mart is there.
    """

    def __init__(
        self, spark: SparkSession, root: str, names: Iterable[str] = MARTS, grain: str = "day", late_days: int = LATE_DAYS,
        keep_old: bool = True,
    ):
        self.spark, self.root, self.grain, self.late_days, self.keep_old = spark, root, grain, late_days, keep_old
        self._asides: list[str] = []  # folders of the step at work
        self.names = closure(names)
        self.sources = [SOURCE_OF[n] for n in self.names if n in SOURCE_OF]

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def __getitem__(self, name: str) -> DataFrame:
        """A mart as it is stored; its partition column is kept, so that filters on it prune."""
        return versioned.read(self.spark, self.path(name))

    def build(self, w: Warehouse) -> None:
        """Every mart in full, and how far the sources were read."""
        with freeing_shuffles(self.spark):
            state = self._state(w)
            stored = w
            for name in self.names:
                if name == "fact_order_items":  # the inventory fact was just made of every staged item
                    stored._frames["stg_inventory_items"] = self._stock()
                versioned.write(stored[name], self.path(name), place(name, self.grain), (MARTS[name],))
                stored = self._over(stored, {name: self._plain(name)})
            versioned.write(state, self.path("_state"))

    def refresh(self, w: Warehouse) -> dict[str, int]:
        """Bring every mart to the state of the warehouse's sources; partitions rewritten, by mart.

        ``w`` offers the sources whole; its rows are read for changed keys only.
        """
        with freeing_shuffles(self.spark):
            state = self._state(w)
            keys = self._journal(self._impacted(w))
            self._clear_asides()
            written = {}
            for name in self.names:
                written[name] = self._apply(w, name, keys)
                self._clear_asides()
                if not self.keep_old:
                    versioned.expire(self.spark, self.path(name))
            versioned.write(state, self.path("_state"))
            for name in self.names:
                versioned.write(keys[name].limit(0), self.path(f"_keys/{name}"))
        return written

    # --- what changed -------------------------------------------------------------------------------------

    def _state(self, w: Warehouse) -> DataFrame:
        """(source, newest): the newest change of each source in ms, and the build's instant, fixed before it starts."""
        seen = [w[s].agg(F.max(cdc_millis(w[s])).alias("newest")).select(F.lit(s).alias("source"), "newest") for s in self.sources]
        now = self.spark.range(1).select(F.lit("as_of").alias("source"), F.unix_millis(w.as_of).alias("newest"))
        rows = [tuple(r) for r in reduce(DataFrame.union, seen, now).collect()]
        return self.spark.createDataFrame(rows, "source string, newest long")

    def _changed(self, w: Warehouse, source: str, since: dict[str, int | None]) -> DataFrame:
        """Keys of a source with a change since the last run, less the days that changes may be late."""
        start = since.get(source)
        rows = w[source]
        if start is not None:
            rows = rows.where(cdc_millis(rows) >= start - self.late_days * 86_400_000)
        return self._aside(rows.select(F.col(SOURCES[source]).cast("bigint").alias("key")).where("key IS NOT NULL").distinct(), source)

    def _impacted(self, w: Warehouse) -> dict[str, DataFrame]:
        """Keys of every mart that the changes reach, over what is stored and over what is new."""
        since = {r.source: r.newest for r in versioned.read(self.spark, self.path("_state")).collect()}
        changed = {s: self._changed(w, s, since) for s in self.sources}
        keys = {n: changed[SOURCE_OF[n]] for n in self.names if n.startswith("dim_")}
        # A fact holds a dimension's surrogate key as long as the member exists: only members that come or go reach it.
        flips = {n: self._aside(self._come_or_gone(w, n, keys[n]), "flips") for n in keys}
        if "fact_inventory" in self.names:
            stock = self._plain("fact_inventory")
            old = F.timestamp_millis(F.lit(since["as_of"])) - F.expr(f"INTERVAL {SLOW_MOVING_DAYS} DAYS")
            new = w.as_of - F.expr(f"INTERVAL {SLOW_MOVING_DAYS} DAYS")
            aged = stock.where((~F.col("is_sold")) & (F.col("created_at") >= F.least(old, new)) & (F.col("created_at") < F.greatest(old, new)))
            keys["fact_inventory"] = self._union(
                changed["inventory_items"],
                self._reach(stock, "inventory_item_id", product_id=flips["dim_products"], distribution_center_id=flips["dim_distribution_centers"]),
                aged.select(F.col("inventory_item_id").alias("key")),
            )
        if "fact_events" in self.names:
            visits = self._plain("fact_events")
            keys["fact_events"] = self._union(changed["events"], self._reach(visits, "event_id", user_id=flips["dim_users"]))
        if "fact_order_items" in self.names:
            lines = self._plain("fact_order_items")
            moved = self._reach(stock, "inventory_item_id", distribution_center_id=flips["dim_distribution_centers"])
            stock_keys = self._union(changed["inventory_items"], moved)
            reached = self._reach(lines, "order_item_id", inventory_item_id=stock_keys, product_id=keys["dim_products"], user_id=flips["dim_users"])
            keys["fact_order_items"] = self._aside(self._union(changed["order_items"], reached), "items")
        if "fact_orders" in self.names:
            # Orders of any version of a changed item: too many do no harm, and no version has to be picked.
            fresh = self._some(w, "order_items", keys["fact_order_items"])
            orders = self._plain("fact_orders")
            keys["fact_orders"] = self._aside(
                self._union(
                    changed["orders"], self._reach(lines, "order_id", order_item_id=keys["fact_order_items"]),
                    fresh.select(F.col("order_id").cast("bigint").alias("key")), self._reach(orders, "order_id", user_id=flips["dim_users"]),
                ),
                "orders",
            )
            headers = self._fresh(w, {"orders": keys["fact_orders"]})["stg_orders"]
        if "agg_dashboard_daily" in self.names:
            fresh_events = self._fresh(w, {"events": keys["fact_events"]})["stg_events"]
            day = F.to_date("created_at").alias("key")
            keys["agg_dashboard_daily"] = self._union(
                self._reach(orders, day, order_id=keys["fact_orders"]), headers.select(day),
                self._reach(visits, day, event_id=keys["fact_events"]), fresh_events.select(day),
            )
        if "agg_user_stats" in self.names:
            keys["agg_user_stats"] = self._union(
                changed["users"], self._reach(orders, "user_id", order_id=keys["fact_orders"]), headers.select(F.col("user_id").alias("key"))
            )
        return {n: keys[n] for n in self.names}

    def _come_or_gone(self, w: Warehouse, name: str, keys: DataFrame) -> DataFrame:
        """Of the changed members of a dimension those that are stored and no longer there, or there and not stored."""
        source, key = SOURCE_OF[name], MARTS[name]
        there = self._fresh(w, {source: keys})[f"stg_{source}"].select(F.col(key).alias("key"), F.lit(1).alias("new"))
        stored = self._plain(name).select(F.col(key).alias("key"), F.lit(1).alias("old"))
        met = keys.join(there, "key", "left").join(stored, "key", "left")
        return met.where(F.col("new").isNull() != F.col("old").isNull()).select("key")

    def _reach(self, table: DataFrame, key: str | Column, **by: DataFrame) -> DataFrame:
        """Keys of the stored rows that hold one of the given keys in the named column."""
        column = F.col(key).alias("key") if isinstance(key, str) else key
        found = [table.join(keys.withColumnRenamed("key", "_key"), F.col(c) == F.col("_key"), "left_semi").select(column) for c, keys in by.items()]
        return reduce(DataFrame.union, found)

    def _union(self, *frames: DataFrame) -> DataFrame:
        return reduce(DataFrame.union, [f.select("key") for f in frames]).where("key IS NOT NULL").distinct()

    def _aside(self, frame: DataFrame, label: str) -> DataFrame:
        path = work_path(self.spark, f"refresh-{label}")
        self._asides.append(path)
        frame.write.parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def _clear_asides(self) -> None:
        """Delete what was put aside for a step; its results are stored."""
        while self._asides:
            delete_path(self.spark, self._asides.pop())

    def _journal(self, keys: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """The keys, with those that a refresh that died before its end had stored, stored in turn."""
        out = {}
        for name, frame in keys.items():
            path = self.path(f"_keys/{name}")
            if versioned.version(self.spark, path) is not None:
                frame = self._union(frame, versioned.read(self.spark, path))
            versioned.write(frame, path)
            out[name] = versioned.read(self.spark, path)
        return out

    # --- what becomes of it -------------------------------------------------------------------------------

    def _plain(self, name: str) -> DataFrame:
        return self[name].drop("part_date")

    def _over(self, w: Warehouse, frames: dict[str, DataFrame]) -> Warehouse:
        """The warehouse with stored tables in place of models, and of the layers they stand in for."""
        out = Warehouse(w._inputs, w.as_of, w.processed_at, w.deletes, w.gap)
        out._frames = {k: v for k, v in w._frames.items() if k in w._inputs} | {k: v for k, v in w._frames.items() if k in LAYOUT}
        out._frames |= frames
        for name, frame in list(out._frames.items()):
            out._frames |= {layer: frame for layer in LAYERS.get(name, ())}
        return out

    def _fresh(self, w: Warehouse, keys: dict[str, DataFrame], stored: Iterable[str] = ()) -> Warehouse:
        """The warehouse over the sources' rows of the given keys alone, and over stored tables."""

        inputs = dict(w._inputs) | {source: partial(self._some, w, source, found) for source, found in keys.items()}
        out = Warehouse(inputs, w.as_of, w.processed_at, w.deletes, w.gap)
        return self._over(out, {name: self._plain(name) for name in stored})

    def _some(self, w: Warehouse, source: str, keys: DataFrame) -> DataFrame:
        rows = w[source]
        return rows.join(keys.select(F.col("key").alias("_key")), rows[SOURCES[source]].cast("bigint") == F.col("_key"), "left_semi")

    def _stock(self) -> DataFrame:
        """What order items ask of the staged stock, from the stored fact."""
        return self._plain("fact_inventory").withColumnRenamed("distribution_center_id", "product_distribution_center_id")

    def _apply(self, w: Warehouse, name: str, keys: dict[str, DataFrame]) -> int:
        """One mart's rows for its impacted keys, in place of those it has."""
        own, key = keys[name], MARTS[name]
        dims = [d for d in ("dim_users", "dim_products", "dim_distribution_centers") if d in self.names and d != name]
        if name.startswith("dim_"):
            fresh = self._fresh(w, {SOURCE_OF[name]: own})[name]
        elif name == "fact_inventory":
            fresh = self._fresh(w, {"inventory_items": own}, dims)[name]
        elif name == "fact_events":
            fresh = self._fresh(w, {"events": own}, dims)[name]
        elif name == "fact_order_items":
            lines = self._aside(self._fresh(w, {"order_items": own})["stg_order_items"], "lines")  # read twice
            stock = lines.select(F.col("inventory_item_id").alias("key")).where("key IS NOT NULL").distinct()
            over = self._fresh(w, {"inventory_items": self._aside(stock, "stock")}, dims)
            over._frames["stg_order_items"] = lines
            fresh = over[name]
        elif name == "fact_orders":
            over = self._fresh(w, {"orders": own}, dims)
            lines = self._plain("fact_order_items").join(own.select(F.col("key").alias("order_id")), "order_id", "left_semi")
            fresh = self._over(over, {"fact_order_items": lines})[name]
        elif name == "agg_dashboard_daily":
            over = self._over(w, {n: self._days(n, own) for n in ("fact_orders", "fact_events")})
            fresh = over[name]
        else:
            some = own.select(F.col("key").alias("user_id"))
            stats = aggregates.agg_user_stats(self._plain("dim_users"), self._plain("fact_orders"), w.as_of, some)
            fresh = stats.where((F.col("user_id") != UNKNOWN_ID) | (F.col("total_orders") > 0))
        return versioned.replace(fresh, self.path(name), (key,), place(name, self.grain), (key,), gone=own.select(F.col("key").alias(key)))

    def _days(self, name: str, days: DataFrame) -> DataFrame:
        """A fact's rows of the given days; other partitions are not read."""
        parts = days.select(F.to_date(F.date_trunc(self.grain, "key")).alias("part_date")).distinct()
        wanted = [r.part_date for r in parts.collect()]  # partitions, not rows
        table = self[name]
        table = table.where(F.col("part_date").isin(wanted)) if wanted else table.limit(0)
        return table.join(days, F.to_date("created_at") == F.col("key"), "left_semi").drop("part_date")


def sources_until(w: Warehouse, cut: dt.datetime) -> Warehouse:
    """The warehouse as it was when no change after ``cut`` had arrived."""

    def older(source: str) -> DataFrame:
        return w[source].where(cdc_millis(w[source]) < F.unix_millis(F.lit(cut).cast("timestamp")))

    inputs = dict(w._inputs) | {s: partial(older, s) for s in SOURCES}
    return Warehouse(inputs, w.as_of, w.processed_at, w.deletes, w.gap)
