"""Session defaults and the shared working folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on; every instant in the library is UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def local_session(cores: int | str = 8, app: str = "tidemark", shuffle_partitions: int = 8) -> SparkSession:
    """Single-machine session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.checkpoint.dir", LOCAL_ROOT)
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


#: The shared folder of a single machine: one place, so nothing piles up under random names.
LOCAL_ROOT = "/tmp/tidemark-work"


def work_root(spark: SparkSession) -> str:
    """Shared folder of the cluster (``spark.checkpoint.dir``); where it is unset, ``LOCAL_ROOT`` on one machine only."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return LOCAL_ROOT


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared one; never reused, so a retried job cannot read half a result."""
    return f"{work_root(spark)}/tidemark/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


@contextmanager
def freeing_shuffles(spark: SparkSession) -> Iterator[None]:
    """For a job of many writes: each query's shuffle files go when the query ends, not when the driver happens to
    collect its garbage, so that disk holds one step's shuffles and not those of all steps."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    given = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, given)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of any store that Spark reaches; the library's only use of the JVM's file system."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(found, True)


def clear_work(spark: SparkSession) -> None:
    """Delete what this application wrote below the shared folder; call it when no result of it is read any more."""
    delete_path(spark, f"{work_root(spark)}/tidemark/{spark.sparkContext.applicationId}")
