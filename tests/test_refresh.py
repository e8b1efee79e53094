import datetime as dt
import pathlib
from functools import partial

import pytest
from pyspark.sql import functions as F

from tidemark.plans import catalog, refresh
from tidemark.plans.staging import STAGING
from tidemark.session import work_path

SF = "/root/testdata/sf0.001"


class Killed(Exception):
    pass


def with_changes(w):
    """Long after everything else: an item from years ago moves to another order, gets a status and a price, a stock
    item a new cost, and a user unknown so far turns up, whose orders were there."""
    late = dt.datetime(2005, 1, 1)
    stamp = F.unix_millis(F.lit(late).cast("timestamp"))
    more = {
        "order_items": w["order_items"].where("order_id = 7 AND cdc_operation = 'c'").withColumns(
            {"order_id": F.lit(33).cast(w["order_items"].schema["order_id"].dataType), "status": F.lit("Returned"),
             "sale_price": (F.col("sale_price") + 5).cast(w["order_items"].schema["sale_price"].dataType)}
        ),
        "inventory_items": w["inventory_items"].where("cdc_operation = 'c' AND id % 211 = 5").withColumn(
            "cost", (F.col("cost") + 1).cast(w["inventory_items"].schema["cost"].dataType)
        ),
        "users": w["users"].where("id = 11 AND cdc_operation = 'c'"),
    }
    inputs = dict(w._inputs)
    for name, rows in more.items():
        changed = rows.withColumns({"cdc_timestamp": stamp.cast(rows.schema["cdc_timestamp"].dataType), "cdc_operation": F.lit("u")})
        inputs[name] = partial(lambda source, plus: source.unionByName(plus), w[name], changed)
    return type(w)(inputs, w.as_of, w.processed_at, w.deletes, w.gap)


def test_old_items_reach_their_orders_and_users(spark, monkeypatch):
    """A build, a refresh that dies on its way, and its repeat: the tables of one full build over all changes."""
    before = catalog.warehouse(spark, SF)
    first = dict(before._inputs) | {"users": lambda: before["users"].where("id <> 11")}
    lake = refresh.Lake(spark, work_path(spark, "lake"), ["fact_orders", "agg_user_stats"], grain="year")
    assert lake.names == [n for n in refresh.MARTS if n not in ("fact_events", "agg_dashboard_daily")]
    lake.build(type(before)(first, before.as_of))
    current = with_changes(before)
    apply = refresh.Lake._apply

    def dies(self, w, name, keys):
        if name == "fact_orders":
            raise Killed
        return apply(self, w, name, keys)

    with monkeypatch.context() as patch:
        patch.setattr(refresh.Lake, "_apply", dies)
        with pytest.raises(Killed):
            lake.refresh(current)
    lake.refresh(current)
    full = with_changes(catalog.warehouse(spark, SF))
    for name in ("fact_order_items", "fact_orders", "agg_user_stats"):
        stored, want = lake[name].drop("part_date").select(full[name].columns), full[name]
        assert stored.exceptAll(want).count() == 0 and want.exceptAll(stored).count() == 0, name
    # the items moved: their old order lost money too
    assert lake["fact_orders"].where("order_id = 7").first().total_revenue == 0
    assert lake["agg_user_stats"].where("user_id = 11").count() == 1


def test_a_build_stages_stock_once_and_frees_each_steps_shuffles(spark, monkeypatch):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, seen, staged = spark.conf.get(key), [], []
    write, stage = refresh.versioned.write, STAGING["stg_inventory_items"]

    def watched(*args):
        seen.append(spark.conf.get(key))
        write(*args)

    def counted(*args):
        staged.append(args)
        return stage[0](*args)

    monkeypatch.setattr(refresh.versioned, "write", watched)
    monkeypatch.setitem(STAGING, "stg_inventory_items", (counted, stage[1]))
    refresh.Lake(spark, work_path(spark, "freed"), ["fact_order_items"], grain="year").build(catalog.warehouse(spark, SF))
    assert set(seen) == {"true"} and spark.conf.get(key) == before
    assert len(staged) == 1


def test_a_refresh_without_old_versions_leaves_one_copy_of_each_row(spark, tmp_path):
    """No replaced run or folder, and nothing put aside, stays on disk; the rows are those of a full build."""
    asides = f"{work_path(spark, 'x').rsplit('/', 1)[0]}"
    before = {p.name for p in pathlib.Path(asides).glob("re*")}
    current = catalog.warehouse(spark, SF)
    lake = refresh.Lake(spark, str(tmp_path / "lake"), ["fact_inventory"], grain="year", keep_old=False)
    lake.build(refresh.sources_until(current, dt.datetime(1999, 1, 1)))
    lake.refresh(current)
    stored, want = lake["fact_inventory"].drop("part_date").select(current["fact_inventory"].columns), current["fact_inventory"]
    assert stored.exceptAll(want).count() == 0 and want.exceptAll(stored).count() == 0
    on_disk = spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path / "lake" / "fact_inventory" / "data"))
    assert on_disk.count() == want.count()
    assert {p.name for p in pathlib.Path(asides).glob("re*")} <= before
