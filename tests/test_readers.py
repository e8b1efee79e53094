import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tests.conftest import rows, ts
from tidemark.schemas import SOURCE_TABLES
from tidemark.session import work_path
from tidemark.sources import readers


def test_shift_covers_every_time_column(spark):
    frame = spark.createDataFrame(
        [(1, "2020-02-29 10:00:00", ts("2021-05-01 00:00:00"), None), (2, "junk", None, "2020-01-01")],
        "id int, created_at string, ship_date timestamp, some_timestamp string",
    )
    found = rows(readers.shift_years(frame, 5), "id")
    assert found[0] == (1, ts("2025-02-28 10:00:00"), ts("2026-05-01 00:00:00"), None)
    assert found[1][1:] == (None, None, ts("2025-01-01 00:00:00"))


def test_snapshot_and_initial_rows(spark):
    products = spark.createDataFrame([], SOURCE_TABLES["products"])
    assert readers.snapshot_rows(products, "products", 7).columns[-3:] == ["distribution_center_id", "cdc_timestamp", "cdc_operation"]
    frame = spark.createDataFrame([(1, None, "2024-01-02"), (2, "2024-01-01 00:00:00", "?")], "id int, created_at string, due_date string")
    found = rows(readers.initial_rows(frame, F.lit("2024-06-01").cast("timestamp"), 9).select("created_at", "due_date", "cdc_operation", "cdc_timestamp"), "id")
    assert found == [(ts("2024-06-01 00:00:00"), ts("2024-01-02 00:00:00"), "c", 9), (ts("2024-01-01 00:00:00"), None, "c", 9)]
    assert "events" not in readers.SNAPSHOT_TABLES and readers.lake_name("distribution_centers") == "dist_centers"


def test_product_table_first_csv_second(spark):
    path = work_path(spark, "lookup")
    spark.createDataFrame([("1", "n")], "id string, name string").write.option("header", "true").csv(f"{path}/csv")
    assert rows(readers.read_products(spark, f"{path}/none", f"{path}/csv")) == [(1, "n")]
    with pytest.raises(AnalysisException):
        readers.read_products(spark, f"{path}/none")
    spark.createDataFrame([(2, "t")], "id long, name string").write.parquet(f"{path}/table")
    assert rows(readers.read_products(spark, f"{path}/table", f"{path}/csv")) == [(2, "t")]
    spark.createDataFrame([], "x int, d int").write.partitionBy("d").parquet(f"{path}/broken")
    with pytest.raises(AnalysisException):  # there, but no table: not silently the CSV
        readers.read_products(spark, f"{path}/broken", f"{path}/csv")


def test_bronze_files_with_different_columns(spark):
    path = work_path(spark, "bronze")
    spark.range(2).withColumn("a", F.lit(1)).write.parquet(f"{path}/date=2024-01-01/hour=05")
    spark.range(3).withColumn("b", F.lit("x")).write.parquet(f"{path}/date=2024-01-02/hour=06")
    found = readers.read_bronze(spark, path)
    assert set(found.columns) == {"id", "a", "b", "date", "hour"} and found.count() == 5
    assert found.where("date = DATE'2024-01-01'").count() == 2
