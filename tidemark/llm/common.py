"""What the operators of this package share: reading columns by exact name, word rules, shared intermediate tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import work_path, work_root

#: Words are runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def pick(frame: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, found by exact name, so that further columns (also ``DOC_ID`` or repeats) cannot clash."""
    plain, at, _ = by_place(frame)
    return plain.select(*[F.col(at[name]).alias(name) for name in names])


def by_place(frame: DataFrame) -> tuple[DataFrame, dict[str, str], list[Column]]:
    """The frame with columns ``_0``, ``_1``, ..., the new name of each (first) old one, and the columns as they were:
    for operators that pass whole rows through beside columns of their own."""
    plain = frame.toDF(*[f"_{i}" for i in range(len(frame.columns))])
    names = {name: f"_{i}" for i, name in reversed(list(enumerate(frame.columns)))}
    return plain, names, [F.col(f"_{i}").alias(name) for i, name in enumerate(frame.columns)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def ascii_lower(text: Column) -> Column:
    """A-Z lowered, everything else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id's decimal text modulo ``parts``; a null id counts as the text ``null``."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")) % parts


def saved(frame: DataFrame, label: str) -> DataFrame:
    """Written once to the cluster's shared folder and read back: cuts lineage and survives lost executors."""
    spark = frame.sparkSession
    path = work_path(spark, label)
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def checkpointed(frame: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder, for small tables of iterative jobs."""
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(work_root(frame.sparkSession))
    return frame.checkpoint()
