from pyspark.sql import functions as F

from tests.conftest import rows, ts
from tidemark.operators import quality
from tidemark.operators.quality import Check
from tidemark.plans import catalog, checks

DAY = ts("2024-01-10 00:00:00")


def test_column_checks_report_each_kind(spark):
    child = spark.createDataFrame([(1, 7, "a"), (1, 8, "b"), (2, None, None)], "id int, ref int, kind string")
    parent = spark.createDataFrame([(7,)], "key int")
    report = quality.run_checks(
        {"child": child, "parent": parent},
        [
            Check("child", "id", "unique"), Check("child", "ref", "not_null", "warn"),
            Check("child", "kind", "accepted", accepted=("a",)),
            Check("child", "ref", "foreign", "warn", parent="parent", parent_column="key"),
            Check("parent", "key", "not_null"),
        ],
    )
    assert rows(report.select("check_name", "violations", "status"), "check_name") == [
        ("accepted_child_kind", 1, "error"), ("foreign_child_ref", 1, "warn"), ("not_null_child_ref", 1, "warn"),
        ("not_null_parent_key", 0, "pass"), ("unique_child_id", 1, "error"),
    ]
    assert len({c.name for c in checks.STAGING_CHECKS + checks.MART_CHECKS}) == len(checks.STAGING_CHECKS + checks.MART_CHECKS)


def test_status_rules(spark):
    early, late = ts("2024-01-09 00:00:00"), ts("2024-01-11 00:00:00")
    frame = spark.createDataFrame(
        [
            (1, "Shipped", DAY, early, None, None), (2, "Shipped", DAY, late, DAY, None), (3, "Returned", DAY, DAY, late, DAY),
            (4, "Complete", DAY, DAY, None, None), (5, "Returned", DAY, DAY, late, None), (6, "Complete", DAY, DAY, late, None),
            (7, "Processing", DAY, None, None, None),
        ],
        "order_id int, status string, created_at timestamp, shipped_at timestamp, delivered_at timestamp, returned_at timestamp",
    )
    assert [r.order_id for r in quality.status_violations(frame).orderBy("order_id").collect()] == [1, 2, 3, 4, 5]


def test_seeded_violations(spark, as_of):
    orders = spark.createDataFrame([(1, ts("2025-01-01 00:00:00"), 2, 10.0), (2, DAY, 1, 5.0)], "order_id long, created_at timestamp, num_of_item long, total_revenue double")
    orders = orders.withColumn("total_revenue", F.col("total_revenue").cast("decimal(38,9)"))
    items = spark.createDataFrame([(1, 1, DAY, 9.0), (2, 2, DAY, -1.0), (3, 2, DAY, 6.005)], "order_item_id long, order_id long, created_at timestamp, sale_price double")
    items = items.withColumn("sale_price", F.col("sale_price").cast("decimal(38,9)"))
    users = spark.createDataFrame([(1, DAY)], "user_id long, created_at timestamp")
    products = spark.createDataFrame([(1, -1.0, 2.0), (2, 1.0, -2.0)], "product_id long, cost double, retail_price double")
    assert rows(quality.future_dates(orders, items, users, as_of).select("source_table", "record_id")) == [("orders", 1)]
    assert rows(quality.item_count_mismatches(orders, items).select("order_id", "discrepancy"), "order_id") == [(1, 1), (2, -1)]
    assert quality.negative_prices(items, products).count() == 3
    assert rows(quality.revenue_mismatches(items, orders).select("order_id")) == [(1,)]


def test_freshness_levels(spark, as_of):
    now = 1717200000000  # as_of in milliseconds
    hour = 3_600_000

    def log(hours):
        return spark.createDataFrame([(now - hours * hour,)], "cdc_timestamp long")

    found = quality.freshness({"users": log(3), "orders": log(5), "events": log(30), "distribution_centers": log(900)}, as_of)
    assert rows(found.select("source_table", "status"), "source_table") == [("events", "error"), ("orders", "pass"), ("users", "warn")]


def test_reports_read_models_that_were_made_once(spark):
    """Every test of a report reads stored columns; none makes a model again."""
    w = catalog.warehouse(spark, "/root/testdata/sf0.001")
    for report in (catalog.dq_report(w), catalog.dq_mart_report(w)):
        files = report.inputFiles()
        assert files and all("/aside-" in f for f in files)
