"""Declared column tests of the staging models and marts (fixed values)."""

from __future__ import annotations

from collections.abc import Iterable

from tidemark.operators.quality import Check
from tidemark.schemas import CUSTOMER_STATUSES, STAGED_STATUSES


def _required(model: str, columns: str, severity: str = "error") -> list[Check]:
    return [Check(model, c, "not_null", severity) for c in columns.split()]


def _unique(model: str, column: str, severity: str = "error") -> list[Check]:
    return [Check(model, column, "unique", severity), Check(model, column, "not_null")]


def _foreign(model: str, column: str, parent: str, parent_column: str = "", severity: str = "error") -> list[Check]:
    return [Check(model, column, "foreign", severity, parent=parent, parent_column=parent_column or column)]


def _dates(model: str, columns: str, severity: str = "warn") -> list[Check]:
    return [x for c in columns.split() for x in _foreign(model, c, "dim_date", "date_key", severity)]


STAGING_CHECKS: list[Check] = [
    *_unique("stg_orders", "order_id"),
    *_required("stg_orders", "user_id created_at"),
    *_foreign("stg_orders", "user_id", "stg_users", severity="warn"),
    Check("stg_orders", "status", "accepted", accepted=STAGED_STATUSES),
    *_unique("stg_order_items", "order_item_id"),
    *_required("stg_order_items", "order_id user_id product_id inventory_item_id sale_price created_at"),
    *_foreign("stg_order_items", "order_id", "stg_orders", severity="warn"),
    *_foreign("stg_order_items", "user_id", "stg_users", severity="warn"),
    *_foreign("stg_order_items", "product_id", "stg_products", severity="warn"),
    *_foreign("stg_order_items", "inventory_item_id", "stg_inventory_items", severity="warn"),
    *_unique("stg_products", "product_id"),
    *_required("stg_products", "cost retail_price product_name category"),
    *_unique("stg_users", "user_id", "warn"),
    *_required("stg_users", "email gender country"),
    *_unique("stg_distribution_centers", "distribution_center_id"),
    *_required("stg_distribution_centers", "distribution_center_name"),
    *_unique("stg_inventory_items", "inventory_item_id", "warn"),
    *_required("stg_inventory_items", "product_id created_at"),
    *_unique("stg_events", "event_id"),
    *_required("stg_events", "user_id event_type"),
    *_required("stg_events", "created_at", "warn"),
]

MART_CHECKS: list[Check] = [
    *_unique("dim_date", "date_key"),
    *_unique("dim_date", "full_date"),
    *_unique("dim_distribution_centers", "dc_key"),
    *_unique("dim_distribution_centers", "distribution_center_id"),
    *_unique("dim_products", "product_key"),
    *_unique("dim_products", "product_id"),
    *_foreign("dim_products", "distribution_center_id", "dim_distribution_centers"),
    *_unique("dim_users", "user_key"),
    *_unique("dim_users", "user_id"),
    *_unique("fact_orders", "order_id"),
    *_required("fact_orders", "user_key created_date_key"),
    *_foreign("fact_orders", "user_key", "dim_users", severity="warn"),
    *_dates("fact_orders", "created_date_key", "error"),
    *_dates("fact_orders", "shipped_date_key delivered_date_key returned_date_key"),
    *_unique("fact_order_items", "order_item_id"),
    *_required("fact_order_items", "user_key product_key dc_key created_date_key"),
    *_foreign("fact_order_items", "user_key", "dim_users", severity="warn"),
    *_foreign("fact_order_items", "product_key", "dim_products"),
    *_foreign("fact_order_items", "dc_key", "dim_distribution_centers"),
    *_dates("fact_order_items", "created_date_key", "error"),
    *_dates("fact_order_items", "shipped_date_key delivered_date_key returned_date_key"),
    *_unique("fact_events", "event_id"),
    *_required("fact_events", "user_key created_date_key"),
    *_foreign("fact_events", "user_key", "dim_users"),
    *_dates("fact_events", "created_date_key", "error"),
    *_unique("fact_inventory", "inventory_item_id"),
    *_required("fact_inventory", "product_key dc_key created_date_key"),
    *_foreign("fact_inventory", "product_key", "dim_products"),
    *_foreign("fact_inventory", "dc_key", "dim_distribution_centers"),
    *_dates("fact_inventory", "created_date_key sold_date_key", "error"),
    *_unique("agg_dashboard_daily", "date"),
    *_required("agg_dashboard_daily", "revenue purchase_cvr"),
    *_unique("agg_user_stats", "user_id"),
    Check("agg_user_stats", "customer_status", "accepted", accepted=CUSTOMER_STATUSES),
]

# Columns that marts take from those before them, beside the checked ones.
FEEDS = {
    "dim_distribution_centers": "distribution_center_id",
    "dim_products": "product_id cost",
    "dim_users": "user_id source_updated_at",
    "fact_events": "user_id session_id is_checkout_event created_at source_updated_at",
    "fact_inventory": "inventory_item_id cost distribution_center_id",
    "fact_order_items": "order_id sale_price cost profit",
    "fact_orders": "order_id user_id created_at total_revenue total_cost gross_margin source_updated_at",
}


def columns(checks: Iterable[Check], order: Iterable[str]) -> dict[str, list[str]]:
    """Columns of every model that the checks read, as child or parent, and that later models are made from; the models
    in the given order."""
    found: dict[str, dict[str, None]] = {}
    for check in checks:
        found.setdefault(check.model, {})[check.column] = None
        if check.parent:
            found.setdefault(check.parent, {})[check.parent_column] = None
    return {m: list(dict.fromkeys([*found[m], *FEEDS.get(m, "").split()])) for m in order if m in found}
