import re

import pytest

from tests.conftest import rows
from tidemark.plans import catalog
from tidemark.session import work_path

SF = "/root/testdata/sf0.001"
TABLES = ("dim_products", "dim_users", "fact_events", "fact_order_items", "fact_orders")
PRUNED = (
    "q_sales_kpis", "q_marketing_kpis", "q_order_status_stats", "q_order_value_distribution", "q_traffic_cvr",
    "q_brand_performance", "q_category_trend", "q_ops_kpis", "q_delivery_histogram",
)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lazy(spark):
    return catalog.warehouse(spark, SF)


@pytest.fixture(scope="module")
def stored(spark):
    return catalog.warehouse(spark, SF).publish(spark, work_path(spark, "ranges"), TABLES)


@pytest.mark.parametrize(("name", "unread"), [
    ("q_sales_kpis", ["events"]), ("q_marketing_kpis", ["orders", "lineitem", "part"]),
    ("agg_user_stats", ["part", "events"]), ("q_user_segments", ["part", "events"]),
])
def test_reports_read_only_their_side(lazy, name, unread):
    text = plan(catalog.OVER_WAREHOUSE[name](lazy))
    assert ".parquet" in text
    assert [table for table in unread if f"/{table}.parquet" in text] == []
    assert text.count("/lineitem.parquet") <= 1 or name == "q_sales_kpis"


@pytest.mark.parametrize("name", PRUNED)
def test_stored_tables_are_pruned_by_day_and_answer_alike(lazy, stored, name):
    query = catalog.OVER_WAREHOUSE[name]
    found = query(stored)
    scans = [line for line in plan(found).splitlines() if "FileScan" in line and "created_at" in line]
    assert scans and all(re.search(r"PartitionFilters: \[[^]]*part_date", line) for line in scans)
    expected = query(lazy)
    assert rows(found, *found.columns) == rows(expected, *expected.columns)


def test_the_stored_daily_aggregate_answers_by_itself(spark, lazy):
    whole = catalog.warehouse(spark, SF).publish(spark, work_path(spark, "daily"), ("agg_dashboard_daily",))
    for name in ("q_sales_kpis", "q_marketing_kpis", "q_revenue_trend"):
        found = catalog.OVER_WAREHOUSE[name](whole)
        assert "lineitem.parquet" not in plan(found) and "events.parquet" not in plan(found)
        assert rows(found) == rows(catalog.OVER_WAREHOUSE[name](lazy))
