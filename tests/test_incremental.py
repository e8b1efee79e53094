import uuid

from pyspark.sql import functions as F

from tests.conftest import rows, ts
from tidemark.operators import incremental
from tidemark.plans import catalog
from tidemark.session import work_path

SF = "/root/testdata/sf0.001"


def test_watermarks_on_empty_and_filled_target(spark):
    target = spark.createDataFrame([(ts("2024-01-10 00:00:00"), 5)], "at timestamp, n long")
    source = spark.createDataFrame([(1, ts("2024-01-06 23:59:59"), 4), (2, ts("2024-01-07 00:00:00"), 5)], "i int, at timestamp, n long")
    assert [r.i for r in incremental.since(source, "at", target, "at", 3).collect()] == [2]
    assert incremental.since(source, "at", target.limit(0), "at", 3).count() == 2
    assert [r.i for r in source.where(F.col("n") >= incremental.number_watermark(target, "n")).collect()] == [2]


def test_event_lookback_is_a_parameter(spark):
    target = spark.createDataFrame([(ts("2024-01-10 00:00:00"),)], "created_at timestamp")
    late = spark.createDataFrame([(ts("2024-01-09 12:00:00"),)], "created_at timestamp")
    assert incremental.since(late, "created_at", target, "created_at").count() == 0
    assert incremental.since(late, "created_at", target, "created_at", days=1).count() == 1


def test_upsert_moves_rows_between_days_and_can_repeat(spark):
    path = work_path(spark, "t" + uuid.uuid4().hex)
    day = [ts(f"2024-01-0{d} 05:00:00") for d in (1, 2, 3)]
    target = spark.createDataFrame([(1, day[0], "a"), (2, day[0], "b"), (3, day[1], "c")], "k int, at timestamp, v string")
    incremental.write_table(target, path, day="at", cluster=("k",))
    delta = spark.createDataFrame([(3, day[2], "c2"), (1, day[0], "a2"), (4, day[2], "d")], "k int, at timestamp, v string")
    expected = [(1, "a2"), (2, "b"), (3, "c2"), (4, "d")]
    for _ in range(2):
        assert incremental.upsert_table(delta, path, ("k",), "at") > 0
        table = incremental.read_table(spark, path)
        assert rows(table.select("k", "v"), "k") == expected
        assert [str(r.part_date) for r in table.select("part_date").distinct().orderBy("part_date").collect()] == ["2024-01-01", "2024-01-03"]
    assert incremental.upsert_table(delta.limit(0), path, ("k",), "at") == 0


def test_incremental_orders_equal_full_build(spark):
    """First build over the older log, then a run over what changed: same table as one full build."""
    full = catalog.warehouse(spark, SF)
    cut = ts("1999-01-01 00:00:00")
    old = catalog.warehouse(spark, SF)
    for name in ("orders", "order_items", "inventory_items"):
        source = full[name]
        old._inputs[name] = lambda source=source: source.where(F.col("cdc_timestamp") < F.unix_millis(F.lit(cut)))
    columns = ["order_id", "status", "total_revenue", "gross_margin", "created_at", "cdc_timestamp"]
    path = work_path(spark, "orders")
    incremental.write_table(old["order_measures"].select(columns), path, day="created_at", grain="month")
    target = incremental.read_table(spark, path)
    # Items can be older than their order here, so every order with a changed item counts as touched.
    touched = incremental.impacted_keys(
        full["stg_orders"].where(F.col("cdc_timestamp") >= incremental.number_watermark(target, "cdc_timestamp")).select("order_id"),
        full["stg_order_items"].where(F.col("cdc_timestamp") >= F.unix_millis(F.lit(cut))).select("order_id"),
        full["stg_inventory_items"].where(F.col("cdc_timestamp") >= F.unix_millis(F.lit(cut)))
        .join(full["stg_order_items"], "inventory_item_id").select("order_id"),
        full["order_items"].where(F.col("cdc_timestamp") >= F.unix_millis(F.lit(cut))).select("order_id"),
    )
    delta = full["order_measures"].join(touched, "order_id", "left_semi").select(columns)
    incremental.upsert_table(delta, path, ("order_id",), "created_at", grain="month")
    result = incremental.read_table(spark, path).select(columns)
    expected = full["order_measures"].select(columns)
    assert result.count() == expected.count()
    assert result.exceptAll(expected).count() == 0


def test_published_tables_answer_like_the_lazy_plan(spark):
    lazy = catalog.warehouse(spark, SF)
    names = ("dim_products", "dim_users", "fact_order_items", "fact_orders")
    root = work_path(spark, "published")
    stored = catalog.warehouse(spark, SF).publish(spark, root, names)
    reopened = type(stored).open(spark, root, catalog.instant(catalog.AS_OF), names)
    for query in ("q_brand_performance", "q_order_status_stats", "q_top_products_by_brand"):
        build = catalog.OVER_WAREHOUSE[query]
        expected = rows(catalog.plain(build(lazy)))
        assert rows(catalog.plain(build(stored))) == expected == rows(catalog.plain(build(reopened)))
    scan = catalog.OVER_WAREHOUSE["q_order_status_stats"](reopened)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(created_at), GreaterThanOrEqual(created_at" in scan
    assert "ReadSchema: struct<status:string,created_at:timestamp>" in scan
