from tests.conftest import rows, ts
from tidemark.plans import staging
from tidemark.schemas import SOURCE_TABLES, bronze_schema

T1 = ts("2024-01-01 00:00:00")


def bronze(spark, table, *records):
    schema = bronze_schema(table)
    return spark.createDataFrame([tuple(r.get(f) for f in schema.fieldNames()) for r in records], schema)


def order(key, op, at, **more):
    return {"order_id": key, "user_id": 1, "status": "Shipped", "created_at": T1, "num_of_item": 1,
            "cdc_timestamp": at, "cdc_operation": op} | more


def test_deleted_order_falls_back_to_live_version(spark):
    log = bronze(spark, "orders", order(1, "c", 10), order(1, "u", 20, status="Complete"), order(1, "d", 30))
    assert rows(staging.stg_orders(log).select("order_id", "status")) == [(1, "Complete")]
    assert staging.stg_orders(log, deletes="tombstone").count() == 0


def test_deleted_user_keeps_last_image(spark):
    log = bronze(
        spark, "users",
        {"id": 1, "email": "a", "created_at": T1, "cdc_timestamp": 10, "cdc_operation": "c"},
        {"id": 1, "email": "b", "created_at": T1, "cdc_timestamp": 20, "cdc_operation": "d"},
    )
    assert rows(staging.stg_users(log).select("email", "updated_at")) == [("b", T1)]
    assert staging.stg_users(log, deletes="tombstone").count() == 0


def test_equal_change_times_are_settled_the_same_way(spark):
    records = [order(1, "u", 10, status=s) for s in ("Complete", "Processing", "Shipped")]
    picks = {rows(staging.stg_orders(bronze(spark, "orders", *p)).select("status"))[0]
             for p in (records, records[::-1], records[1:] + records[:1])}
    assert len(picks) == 1


def test_order_filters_and_defaults(spark):
    log = bronze(
        spark, "orders", order(1, "c", 10, status=None, created_at=None), order(2, "c", 10, num_of_item=-1),
        order(None, "c", 10), order(3, None, 10, user_id=None),
    )
    found = rows(staging.stg_orders(log).select("order_id", "status", "gender", "created_at"))
    assert found == [(1, "Unknown", "Unknown", ts("1970-01-01 00:00:00.010"))]


def test_order_item_validity(spark):
    def item(key, **more):
        return {"id": key, "order_id": 1, "user_id": 1, "product_id": 1, "sale_price": 5.0, "created_at": T1,
                "cdc_timestamp": 1, "cdc_operation": "c"} | more

    log = bronze(
        spark, "order_items", item(1), item(2, sale_price=-0.01), item(3, sale_price=None), item(4, product_id=None),
        item(5, created_at=None), item(6, cdc_operation="d"), item(7, order_id=None), item(8, user_id=None),
        item(9, sale_price=0.0), item(9, sale_price=7.0, created_at=ts("2024-01-02 00:00:00")),
    )
    found = rows(staging.stg_order_items(log).select("order_item_id", "sale_price"), "order_item_id")
    assert [(k, float(p)) for k, p in found] == [(1, 5.0), (9, 7.0)]


def test_events_defaults_and_fallback_time(spark):
    log = bronze(
        spark, "events",
        {"id": 1, "user_id": 1, "sequence_number": 0, "cdc_timestamp": 1700000000000, "cdc_operation": "c"},
        {"id": 2, "user_id": 1, "sequence_number": -1, "cdc_timestamp": 1, "cdc_operation": "c"},
    )
    found = staging.stg_events(log).first()
    assert (found.session_id, found.city, found.uri, found.created_at) == (
        "N/A", "Unknown", "N/A", ts("2023-11-14 22:13:20")
    )
    assert staging.stg_events(log).count() == 1


def test_text_bronze_is_typed(spark):
    names = [*SOURCE_TABLES["products"].fieldNames(), "cdc_timestamp", "cdc_operation"]
    record = ("7", "1.5", "c", None, "b", "2.25", "Men", "s", "3", "1700000000", "1700000000123", "c")
    log = spark.createDataFrame([record, (None, *record[1:])], ", ".join(f"{n} string" for n in names))
    found = staging.stg_products(log).collect()
    assert len(found) == 1 and "rn" not in found[0].asDict()
    assert (found[0].product_id, found[0].product_name, float(found[0].retail_price)) == (7, "Unknown Product", 2.25)
    assert found[0].source_updated_at == ts("2023-11-14 22:13:20.123")


def test_very_many_copies_of_one_key(spark):
    log = spark.range(20000).selectExpr(
        "if(id < 7000, 1, id) AS order_id", "1L AS user_id", "'Shipped' AS status", "'F' AS gender",
        "timestamp_seconds(id) AS created_at", "timestamp_seconds(id) AS updated_at", "NULL AS returned_at",
        "timestamp_seconds(id) AS shipped_at", "NULL AS delivered_at", "1 AS num_of_item", "id AS cdc_timestamp",
        "'u' AS cdc_operation",
    )
    log = log.selectExpr(*[f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in bronze_schema("orders").fields])
    staged = staging.stg_orders(log)
    assert staged.count() == 13001
    assert rows(staged.where("order_id = 1").select("cdc_timestamp")) == [(6999,)]
    plan = staged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # one row per key leaves each task


def test_wanted_columns_pick_the_same_rows_and_move_no_others(spark):
    """Three versions tie on the change and on product and center; the cost decides, texts behind it cannot."""
    names = (
        "id long, product_id long, created_at timestamp, sold_at timestamp, cost double, product_category string, product_name string,"
        " product_brand string, product_retail_price double, product_department string, product_sku string,"
        " product_distribution_center_id long, cdc_timestamp long, cdc_operation string"
    )
    day = ts("2024-01-01 00:00:00")
    versions = [
        (key, 7, day, None, cost, "c", name, "b", 1.0, "d", "s", center, 1000, "c")
        for key in (1, 2, None)
        for cost, name, center in ((5.0, "a", 3), (5.0, "z", 4), (4.0, "zz", 9))
    ]
    bronze = spark.createDataFrame(versions, names)
    whole = staging.stg_inventory_items(bronze)
    thin = staging.stg_inventory_items(bronze, wanted=("cost", "_place"))
    assert rows(thin.select("inventory_item_id", "cost")) == rows(whole.select("inventory_item_id", "cost"))
    shuffled = [line for line in thin._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window [" in line]
    assert shuffled and not any("product_sku" in line or "product_name" in line for line in shuffled)
    live = staging.stg_inventory_items(bronze, deletes="tombstone", wanted=("cost",))
    assert live.columns == ["inventory_item_id", "cost"] and live.count() == 3


def test_moments_are_shuffled_as_spans_and_come_back(spark):
    """Ties are settled by the moments as before, also without a start; the shuffle carries the time since the start."""
    early, late = ts("2023-12-30 00:00:00"), ts("2024-01-03 12:00:00.000001")
    log = bronze(spark, "orders", order(1, "u", 10, shipped_at=early), order(1, "u", 10, shipped_at=late), order(1, "u", 10),
                 order(2, "c", 10, shipped_at=early, delivered_at=late), order(2, "c", 10, shipped_at=early))
    staged = staging.stg_orders(log)
    columns = ("order_id", "created_at", "shipped_at", "delivered_at", "returned_at")
    assert sorted(rows(staged.select(*columns))) == [(1, T1, late, None, None), (2, T1, early, late, None)]
    assert staging.stg_orders(log, wanted=("shipped_at",)).columns == ["order_id", "shipped_at"]
    assert sorted(rows(staging.stg_orders(log, wanted=("shipped_at",)))) == [(1, late), (2, early)]
    ranked = staged._jdf.queryExecution().optimizedPlan().toString()
    assert "(unix_micros(shipped_at" in ranked and "(unix_micros(returned_at" in ranked

    item = {"id": 7, "product_id": 1, "cost": 1.5, "cdc_timestamp": None, "cdc_operation": "c"}
    stock = bronze(spark, "inventory_items", item | {"sold_at": early}, item | {"sold_at": late}, item | {"id": 8})
    got = staging.stg_inventory_items(stock).select("inventory_item_id", "created_at", "sold_at")
    assert sorted(rows(got)) == [(7, None, late), (8, None, None)]
    assert sorted(rows(staging.stg_inventory_items(stock, wanted=("sold_at",)))) == [(7, late), (8, None)]
