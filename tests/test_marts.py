import datetime as dt
import re

from pyspark.sql import functions as F

from tests.conftest import rows, ts
from tidemark.operators.shape import place_of
from tidemark.plans import aggregates, dimensions, facts
from tidemark.plans.staging import MONEY

DAY = ts("2024-01-10 00:00:00")


def users(spark, *records):
    names = (
        "user_id long, first_name string, last_name string, email string, age long, gender string, street_address string,"
        " postal_code string, city string, state string, country string, latitude double, longitude double,"
        " traffic_source string, created_at timestamp, updated_at timestamp"
    )
    return spark.createDataFrame(
        [(u, "f", "l", "e", age, "F", "s", "p", "c", "s", "k", 1.0, 2.0, "Search", DAY, DAY) for u, age in records], names
    )


def products(spark, *records):
    frame = spark.createDataFrame(
        [(p, "n", "cat", "b", "Men", "s", float(price), float(cost), 1, DAY) for p, price, cost in records],
        "product_id long, product_name string, category string, brand string, department string, sku string,"
        " retail_price double, cost double, distribution_center_id long, source_updated_at timestamp",
    )
    return frame.withColumns({c: F.col(c).cast(MONEY) for c in ("retail_price", "cost")})


def centers(spark, *ids):
    return spark.createDataFrame(
        [(i, f"dc{i}", 1.0, 2.0) for i in ids],
        "distribution_center_id long, distribution_center_name string, latitude double, longitude double",
    )


def inventory(spark, *records):
    frame = spark.createDataFrame(
        records,
        "inventory_item_id long, product_id long, created_at timestamp, sold_at timestamp, cost double,"
        " product_distribution_center_id long",
    )
    return frame.withColumn("cost", F.col("cost").cast(MONEY))


def items(spark, *records):
    frame = spark.createDataFrame(
        records,
        "order_item_id long, order_id long, user_id long, product_id long, inventory_item_id long, status string,"
        " created_at timestamp, shipped_at timestamp, delivered_at timestamp, returned_at timestamp, sale_price double",
    )
    return frame.withColumn("sale_price", F.col("sale_price").cast(MONEY))


def test_calendar_matches_python(spark, as_of):
    frame = dimensions.dim_date(dimensions.fixed_bounds(spark), as_of)
    found = {r.full_date: r for r in frame.collect()}
    assert len(found) == (dt.date(2027, 12, 31) - dt.date(2019, 1, 1)).days + 2
    for day in (dt.date(2019, 1, 1), dt.date(2020, 2, 29), dt.date(2021, 1, 3), dt.date(2022, 12, 31), dt.date(2023, 1, 1),
                dt.date(2024, 12, 30), dt.date(2027, 12, 31)):
        r, iso = found[day], day.isocalendar()
        assert r.week_of_year == int(day.strftime("%U"))
        assert (r.iso_year_number, r.iso_week_of_year) == (iso.year, iso.week)
        assert r.day_of_week == iso.weekday % 7 + 1 and r.is_weekend == (iso.weekday > 5)
        assert (r.day_name, r.month_name) == (day.strftime("%A"), day.strftime("%B"))
    zero = found[dt.date(1970, 1, 1)]
    assert (zero.date_key, zero.day_name, zero.quarter_of_year, zero.is_weekend) == (0, "Unknown", 0, False)
    early = dimensions.dim_date(dimensions.fixed_bounds(spark, "1969-12-30", "1970-01-02"), as_of)
    assert early.count() == 4


def test_unknown_member_is_added_once(spark, as_of):
    frame = dimensions.dim_users(users(spark, (1, 17), (2, 59), (3, 60), (4, None)), as_of)
    found = rows(frame.select("user_id", "age_group"), "user_id")
    assert found == [(-1, "Unknown"), (1, "Under 18"), (2, "Adult"), (3, "Senior"), (4, "Unknown")]
    assert dimensions.dim_users(users(spark, (-1, 30), (1, 20)), as_of).count() == 2
    assert dimensions.dim_users(users(spark, (1, 20), (1, 30)), as_of, unique_input=False).count() == 2
    assert dimensions.dim_distribution_centers(centers(spark, 5), as_of).count() == 2
    margin = dimensions.dim_products(products(spark, (1, 10, 4)), as_of).where("product_id = 1").first()
    assert float(margin.margin_value) == 6


def test_order_items_keys_costs_and_margin(spark, as_of):
    du = dimensions.dim_users(users(spark, (1, 20)), as_of)
    dp = dimensions.dim_products(products(spark, (1, 10, 4)), as_of)
    dc = dimensions.dim_distribution_centers(centers(spark, 5), as_of)
    stock = inventory(spark, (100, 1, DAY, DAY, 3.0, 5), (101, 1, DAY, None, 2.0, 99))
    fact = facts.fact_order_items(
        items(
            spark,
            (1, 1, 1, 1, 100, "Complete", DAY, DAY, None, None, 10.0),
            (2, 1, 1, 1, None, "Returned", DAY, None, None, None, 10.0),
            (3, 2, 9, 9, 101, "Cancelled", DAY, None, None, None, 0.0),
            (4, 2, 9, 9, 777, "Shipped", DAY, None, None, None, 8.0),
        ),
        stock, du, dp, dc, as_of,
    )
    unknown = spark.range(1).select(F.md5(F.lit("c0:-1"))).first()[0]
    found = {r.order_item_id: r for r in fact.collect()}
    assert [float(found[i].cost) for i in (1, 2, 3, 4)] == [3, 4, 2, 0]
    assert [found[i].margin_percentage for i in (1, 2, 3, 4)] == [0.7, 0.6, 0.0, 1.0]
    assert [found[i].is_returned for i in (1, 2, 3, 4)] == [False, True, True, False]
    assert found[3].user_key == found[3].product_key == found[3].dc_key == unknown
    assert found[1].dc_key != unknown and found[2].dc_key == unknown and found[2].inventory_item_id == -1
    assert (found[1].created_date_key, found[1].shipped_date_key, found[1].delivered_date_key) == (20240110, 20240110, 0)


def test_orders_durations_and_money(spark, as_of):
    orders = spark.createDataFrame(
        [
            (1, 1, "Complete", DAY, ts("2024-01-12 12:00:00"), ts("2024-01-18 13:00:00"), None, 1, 5),
            (2, 9, "Processing", DAY, None, None, None, 3, 6),
        ],
        "order_id long, user_id long, status string, created_at timestamp, shipped_at timestamp, delivered_at timestamp,"
        " returned_at timestamp, num_of_item long, cdc_timestamp long",
    )
    lines = spark.createDataFrame([(1, 10.0, 4.0, 6.0), (1, 10.0, 6.0, 4.0)], "order_id long, sale_price double, cost double, profit double")
    lines = lines.withColumns({c: F.col(c).cast(MONEY) for c in ("sale_price", "cost", "profit")})
    du = dimensions.dim_users(users(spark, (1, 20)), as_of)
    one, two = facts.fact_orders(orders, lines, du, as_of).orderBy("order_id").collect()
    assert (float(one.total_revenue), one.margin_percentage, one.order_type, one.is_delayed) == (20, 0.5, "Single", True)
    assert (one.shipping_duration_days, one.delivery_duration_days, one.order_duration_days) == (2, 6, 8)
    assert (float(two.total_revenue), two.margin_percentage, two.order_type, two.is_delayed) == (0, 0.0, "Multi", False)
    assert two.shipping_duration_days is None and two.cdc_timestamp == 6
    stats = aggregates.agg_user_stats(du, facts.fact_orders(orders, lines, du, as_of), as_of)
    assert rows(stats.select("user_id", "total_orders", "customer_status")) == [(1, 1, "New")]


def test_inventory_age_edges(spark, as_of):
    now = ts("2024-06-01 00:00:00")
    stock = inventory(
        spark, *[(d, 1, now - dt.timedelta(days=d), None, 1.0, 5) for d in (179, 180, 181)],
        (1, None, DAY, ts("2024-01-12 06:00:00"), 1.0, None),
    )
    dp = dimensions.dim_products(products(spark, (1, 10, 4)), as_of)
    dc = dimensions.dim_distribution_centers(centers(spark, 5), as_of)
    found = rows(facts.fact_inventory(stock, dp, dc, as_of).select("inventory_item_id", "inventory_status", "days_in_inventory"), "inventory_item_id")
    assert found == [(1, "Sold", 2), (179, "Available", None), (180, "Available", None), (181, "Slow-Moving", None)]


def test_daily_aggregate_keeps_both_sides(spark, as_of):
    orders = spark.createDataFrame([(1, DAY, 5.0, 2.0, 3.0, DAY)], "order_id long, created_at timestamp, total_revenue double, total_cost double, gross_margin double, source_updated_at timestamp")
    orders = orders.withColumns({c: F.col(c).cast(MONEY) for c in ("total_revenue", "total_cost", "gross_margin")})
    later = ts("2024-01-11 00:00:00")
    events = spark.createDataFrame(
        [(1, "s1", True, later, later), (1, "s2", False, later, later), (2, "s2", False, later, later)],
        "user_id long, session_id string, is_checkout_event boolean, created_at timestamp, source_updated_at timestamp",
    )
    found = aggregates.agg_dashboard_daily(orders, events, as_of).orderBy("date").collect()
    assert [(float(r.revenue), r.orders, r.total_users, r.total_sessions, r.purchase_sessions, r.purchase_cvr) for r in found] == [
        (5, 1, 0, 0, 0, 0.0), (0, 0, 2, 2, 1, 0.5)
    ]


def test_lookups_of_order_items_shuffle_ids_alone(spark, capsys):
    from tidemark.plans.catalog import warehouse

    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        capsys.readouterr()
        warehouse(spark, "/root/testdata/sf0.001")["fact_order_items"].explain("formatted")
        plan = capsys.readouterr().out
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    moved = re.findall(r"\) Exchange\nInput \[\d+\]: \[([^\]]*)\]\nArguments: hashpartitioning\((\w+)", plan)
    wide = [by for columns, by in moved if "status#" in columns]
    assert len(moved) > 6 and set(wide) == {"order_item_id"}
    assert not [by for columns, by in moved if "_key#" in columns]


def test_item_money_is_the_money_of_the_item_measures(spark, as_of):
    """Cost of the stock, of the product, or none; stock without cost, missing keys and a stock that brings its place."""
    made = items(
        spark,
        (1, 10, 1, 5, 100, "Complete", DAY, None, None, None, 9.0), (2, 10, 1, 5, None, "Complete", DAY, None, None, None, 8.0),
        (3, 10, 1, 6, 101, "Complete", DAY, None, None, None, 7.0), (4, 11, 1, 77, None, "Complete", DAY, None, None, None, 6.0),
        (5, 11, 1, 5, 999, "Complete", DAY, None, None, None, 5.0),
    )
    stock = inventory(spark, (100, 5, DAY, None, 1.0, 1), (101, 6, DAY, None, None, 1), (None, 5, DAY, None, 50.0, 1))
    sold = products(spark, (5, 3.0, 2.0), (6, 3.0, 2.5))
    wanted = rows(facts.item_measures(made, stock, sold, as_of).select("order_id", "sale_price", "cost", "profit"), "sale_price")
    assert sorted(float(r[2]) for r in wanted) == [0.0, 1.0, 2.0, 2.0, 2.5]
    for side in (stock, stock.withColumn("_place", place_of(F.col("inventory_item_id")))):
        assert rows(facts.item_money(made, side, sold), "sale_price") == wanted
