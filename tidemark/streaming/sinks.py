"""Sinks that can be repeated: a batch that runs twice replaces its own rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

DEFAULT_PARTITIONS = "200"  # fixed value: Spark's default

BatchJob = Callable[[DataFrame, int], None]


def write_batch(batch: DataFrame, batch_id: int, path: str, partitions: Sequence[str] = ()) -> None:
    """Add a micro-batch to a table below its own ``batch_id`` partitions, replacing an earlier attempt."""
    (
        batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions, "batch_id")
        .parquet(path)
    )


def _start(writer: DataStreamWriter, spark: SparkSession) -> StreamingQuery:
    """Start a query. On a single machine with the default setting, state is kept in as many partitions as
    there are cores; a query copies the setting when it starts, so it is put back at once."""
    key = "spark.sql.shuffle.partitions"
    given = spark.conf.get(key)
    if given != DEFAULT_PARTITIONS or not spark.sparkContext.master.startswith("local"):
        return writer.start()
    spark.conf.set(key, str(spark.sparkContext.defaultParallelism))
    try:
        return writer.start()
    finally:
        spark.conf.set(key, given)


def start_batches(
    stream: DataFrame, job: BatchJob, checkpoint: str, name: str, mode: str = "append",
    every: str | None = None,
) -> StreamingQuery:
    """Run ``job`` per micro-batch: each ``every`` interval, or over what is there now and then stop."""
    writer = (
        stream.writeStream.foreachBatch(job)
        .outputMode(mode)
        .queryName(name)
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return _start(writer, stream.sparkSession)


def start_table(
    stream: DataFrame, path: str, checkpoint: str, name: str, partitions: Sequence[str] = (), every: str | None = None
) -> StreamingQuery:
    """Append a stream to a Parquet table with the file sink (exactly once)."""
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .queryName(name)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.partitionBy(*partitions) if partitions else writer
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return _start(writer, stream.sparkSession)


def finish(query: StreamingQuery) -> StreamingQuery:
    """Wait for a run over available data; its failure is raised here."""
    query.awaitTermination()
    return query


def newest_batch(spark: SparkSession, path: str, before: int) -> int | None:
    """Highest ``batch_id`` below ``before`` in a table written by :func:`write_batch` without partitions."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    files = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not files.exists(root):
        return None
    names = [status.getPath().getName() for status in files.listStatus(root)]
    numbers = [int(n.split("=")[1]) for n in names if n.startswith("batch_id=")]
    return max((n for n in numbers if n < before), default=None)


def drop_batches(spark: SparkSession, path: str, before: int) -> None:
    """Remove the batches below ``before``."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    files = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    for status in files.listStatus(root):
        name = status.getPath().getName()
        if name.startswith("batch_id=") and int(name.split("=")[1]) < before:
            files.delete(status.getPath(), True)
