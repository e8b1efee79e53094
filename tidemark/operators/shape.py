"""Relational building blocks shared by the models."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import UNKNOWN_ID


def latest_by(
    frame: DataFrame,
    keys: Sequence[str],
    newest: Sequence[str],
    then: Sequence[Column] = (),
    ties: Sequence[str] | None = None,
    wanted: Collection[str] | None = None,
) -> DataFrame:
    """One row per key: the newest by the ``newest`` columns (nulls last), then by ``then``. Remaining
    columns (or ``ties``) settle equal ranks, so that a rerun picks the same row.

    ``row_number() = 1`` lets Spark keep one row per key in each task before the shuffle
    (WindowGroupLimit), so a key with very many copies does not gather in one place.

    With ``wanted`` only the keys and these columns are returned. Ties are then settled up to the last wanted one: rows
    alike so far are alike in all that is returned, so columns behind it need not be shuffled.
    """
    if ties is None:
        ties = [c for c in frame.columns if c not in keys and c not in newest]
    if wanted is not None:
        ties = ties[: max((n for n, c in enumerate(ties, 1) if c in wanted), default=0)]
    order = [F.desc_nulls_last(c) for c in newest]
    ranked = Window.partitionBy(*keys).orderBy(*order, *then, *[F.desc_nulls_last(c) for c in ties])
    latest = frame.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")
    return latest if wanted is None else latest.select(*[c for c in frame.columns if c in keys or c in wanted])


def place_of(key: Column) -> Column:
    """The place of rows with a key, 0 for each: beside the key in a shuffle it changes nothing, while rows without one
    take others. Computed from the key, because a literal would be taken out of the shuffle and the join."""
    return F.pmod(F.xxhash64(key), F.lit(1)).cast("int")


def lookup(
    facts: DataFrame, dimension: DataFrame, fact_key: str, dimension_key: str, spread_by: str | None = None
) -> DataFrame:
    """Left join to a dimension with a unique key; Catalyst broadcasts it when its statistics allow.

    Rows without a key would all meet in one shuffle partition: give ``spread_by`` (any well-spread
    column of the facts) when the key can be null, and they are spread by it. A dimension that brings the ``_place`` of
    its key and lies by both already is not shuffled again.
    """
    side = dimension.withColumnRenamed(dimension_key, "_match")
    if spread_by is None:
        return facts.join(side, F.col(fact_key) == F.col("_match"), "left").drop("_match")
    if "_place" not in side.columns:
        side = side.withColumn("_place", place_of(F.col("_match")))
    spread = F.when(F.col(fact_key).isNull(), 1 + F.pmod(F.xxhash64(spread_by), F.lit(1024))).otherwise(F.lit(0))
    return (
        facts.withColumn("_spread", spread.cast("int"))
        .join(side, (F.col(fact_key) == F.col("_match")) & (F.col("_spread") == F.col("_place")), "left")
        .drop("_spread", "_place", "_match")
    )


def one_row(*frames: DataFrame) -> DataFrame:
    """One-row frames with distinct column names side by side, without a cross join."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def with_unknown_member(frame: DataFrame, key: str, values: Mapping[str, object]) -> DataFrame:
    """Append the sentinel row ``values`` unless its key is already there.

    The row hangs on a count of the key, which always yields one row to keep or drop, so there is no join.
    """

    def value(field: T.StructField) -> Column:
        given = values[field.name]
        column = given if isinstance(given, Column) else F.lit(given)
        return column.cast(field.dataType).alias(field.name)

    present = frame.where(F.col(key) == UNKNOWN_ID).agg(F.count(key).alias("n"))
    return frame.unionByName(present.where("n = 0").select(*[value(f) for f in frame.schema.fields]))


def top(frame: DataFrame, limit: int | None, *order: Column) -> DataFrame:
    """Top-k report; Spark keeps k rows per task (TakeOrderedAndProject). Without a limit every row, in no order."""
    return frame if limit is None else frame.orderBy(*order).limit(limit)
