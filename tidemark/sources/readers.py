"""Batch and stream readers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import LAKE_NAMES, LOAD_ORDER, PRIMARY_KEYS, SOURCE_TABLES

# Name parts that mark a column as a point in time, and the columns a full export leaves out.
TIME_MARKS = ("_at", "_date", "timestamp")
NOT_EXPORTED = {"products": ("updated_at",)}
# Fixed value: tables of the full export and of the initial load (events arrive by stream only).
SNAPSHOT_TABLES = tuple(t for t in LOAD_ORDER if t != "events")


def kafka_messages(spark: SparkSession, servers: str, topics: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """Messages of one or several topics (comma-separated) as text."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topics)
    return reader.options(**(options or {})).load().select(
        "topic", "partition", "offset", F.col("key").cast("string"), F.col("value").cast("string"), "timestamp"
    )


def file_messages(spark: SparkSession, path: str, schema: T.StructType, kind: str = "parquet", per_batch: int = 1000):
    """Messages landed as files, as a stream of at most ``per_batch`` files a batch."""
    return spark.readStream.format(kind).schema(schema).option("maxFilesPerTrigger", per_batch).load(path)


def read_bronze(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A lake table partitioned by ``date=/hour=``. Without a schema the columns of all files are merged."""
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    return spark.read.option("mergeSchema", "true").parquet(path)


def jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    schema: str = "public",
    properties: Mapping[str, str] | None = None,
    partitions: int = 32,
    fetch_rows: int = 50_000,
) -> DataFrame:
    """A source table read in parallel ranges of its primary key; the bounds come from the database."""
    key, name = PRIMARY_KEYS[table], f"{schema}.{table}"
    options = dict(properties or {})
    bounds = (
        spark.read.format("jdbc").options(url=url, **options)
        .option("query", f"SELECT min({key}) AS lo, max({key}) AS hi FROM {name}").load().first()
    )
    reader = spark.read.format("jdbc").options(url=url, dbtable=name, **options).option("fetchsize", fetch_rows)
    if bounds is None or bounds[0] is None:
        return reader.load()
    ranges = {"partitionColumn": key, "lowerBound": bounds[0], "upperBound": bounds[1] + 1, "numPartitions": partitions}
    return reader.options(**ranges).load()


def snapshot_rows(frame: DataFrame, table: str, at_ms: int) -> DataFrame:
    """Full-export rows: the table's columns in order, operation ``r`` and one change time for all."""
    names = [c for c in SOURCE_TABLES[table].fieldNames() if c not in NOT_EXPORTED.get(table, ())]
    return frame.select(*names, F.lit(at_ms).cast("bigint").alias("cdc_timestamp"), F.lit("r").alias("cdc_operation"))


def time_columns(frame: DataFrame) -> list[str]:
    return [c for c in frame.columns if c != "cdc_timestamp" and any(mark in c for mark in TIME_MARKS)]


def _instants(frame: DataFrame, columns: list[str]) -> DataFrame:
    """The given columns as instants, junk text null."""
    kinds = {f.name: f.dataType for f in frame.schema.fields}

    def typed(name: str) -> Column:
        column = F.col(name)
        return column.try_cast("timestamp") if isinstance(kinds[name], T.StringType) else column.cast("timestamp")

    return frame.withColumns({c: typed(c) for c in columns}) if columns else frame


def initial_rows(frame: DataFrame, now: Column, at_ms: int) -> DataFrame:
    """Initial-load rows: time columns coerced, a missing creation time is now, operation ``c``."""
    rows = _instants(frame, time_columns(frame))
    if "created_at" in rows.columns:
        rows = rows.withColumn("created_at", F.coalesce("created_at", now))
    return rows.withColumns(
        {"cdc_operation": F.lit("c"), "cdc_timestamp": F.lit(at_ms).cast("bigint")}
    )


def lake_name(table: str) -> str:
    return LAKE_NAMES.get(table, table)


def shift_years(frame: DataFrame, years: int) -> DataFrame:
    """All time columns moved by whole years; the end of February stays valid."""
    columns = time_columns(frame)
    if not columns:
        return frame
    shift = F.make_ym_interval(F.lit(int(years)))
    return _instants(frame, columns).withColumns({c: F.col(c) + shift for c in columns})


def read_csv(spark: SparkSession, path: str, table: str | None = None, years: int = 0) -> DataFrame:
    """A CSV file with a header, typed by the source table when it is known, dates shifted by ``years``."""
    frame = spark.read.option("header", "true").csv(path)
    if table is not None:
        schema = SOURCE_TABLES[table]
        kinds = {f.name: f.dataType for f in schema.fields}
        frame = frame.select(
            *[F.col(c).try_cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in frame.columns]
        )
    return shift_years(frame, years) if years else frame


def read_products(spark: SparkSession, table_path: str, csv_path: str | None = None) -> DataFrame:
    """The product dimension for enrichment: the stored table, or the CSV when its path is missing. Any other error of
    the table is an error."""
    try:
        return spark.read.parquet(table_path)
    except AnalysisException as error:
        if csv_path is None or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return read_csv(spark, csv_path, "products")
