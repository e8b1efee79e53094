import os

import pytest

import __spark_entry__ as entry
from tidemark.plans.catalog import DIRECT, OVER_WAREHOUSE
from tidemark.plans.jobs import JOBS
from verification.compare import connect, difference

SF = "/root/testdata/sf0.001"
#: Without those of the removable subpackage, which has tests of its own.
QUERIES = {k: v for k, v in entry.queries().items() if k not in entry.LLM_QUERIES}
ORACLES = {k: v for k, v in entry.oracle_sql().items() if k not in entry.LLM_QUERIES}
# One per family by default; ORACLE_ALL=1 compares every query.
SAMPLE = [
    "cdc_flatten", "ev_parse_validate", "f_scalars", "publish_payload", "stg_order_items", "stg_tombstones", "dim_date",
    "fact_order_items", "fact_orders", "agg_dashboard_daily", "agg_user_stats", "events_5m", "v_session_metrics_latest",
    "inc_impacted_users", "q_sales_kpis", "q_brand_performance_by_brand", "q_inventory_kpis", "q_ingestion_freshness",
    "q_session_stream_health", "q_funnel_dropoff", "pp_p99_trim", "dq_staging_report", "st_stream_5m", "src_csv_shift",
]


@pytest.fixture(scope="module")
def oracle():
    return connect(SF)


@pytest.mark.parametrize("name", list(ORACLES) if os.environ.get("ORACLE_ALL") else SAMPLE)
def test_matches_oracle(spark, oracle, name):
    assert difference(QUERIES[name](spark, SF), oracle, ORACLES[name]) is None


def test_registry_is_consistent():
    assert set(QUERIES) == set(DIRECT) | set(OVER_WAREHOUSE) | set(JOBS)
    assert set(QUERIES) - set(ORACLES) == {"q_approx_uniques_by_window"}
    assert not set(ORACLES) - set(QUERIES)


def test_estimates_are_close(spark):
    exact = QUERIES["q_throughput_by_window"](spark, SF).count()
    found = QUERIES["q_approx_uniques_by_window"](spark, SF).collect()
    assert len(found) == exact and all(1 <= r.unique_sessions <= 50 for r in found)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["q_stream_health", "q_brand_performance", "dim_users", "q_session_stream_health", "fact_orders", "q_product_brands",
     "pp_topn_trend_category"])
def test_no_cross_or_nested_loop_join(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_columns_are_pruned_to_the_scan(spark):
    plan = QUERIES["q_order_status_stats"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "o_totalprice" not in plan and "o_orderpriority" not in plan
