"""Change-data-capture messages: decode, route, project. Input column ``value`` (JSON text)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import once, to_instant
from tidemark.schemas import HOT_TABLES, LAKE_NAMES, SOURCE_TABLES, bronze_schema

# The row images stay JSON text at this stage; a table's own schema is applied when it is projected.
_SOURCE = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("schema", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
    ]
)
_PAYLOAD = [
    T.StructField("op", T.StringType()),
    T.StructField("ts_ms", T.LongType()),
    T.StructField("before", T.StringType()),
    T.StructField("after", T.StringType()),
    T.StructField("source", _SOURCE),
]
_ENVELOPE = T.StructType(
    _PAYLOAD
    + [
        T.StructField("table", T.StringType()),
        T.StructField("schema", T.StringType()),
        T.StructField("value_json", T.StringType()),
        T.StructField("payload", T.StructType(_PAYLOAD)),
    ]
)
_INNER = T.StructType(_PAYLOAD + [T.StructField("payload", T.StructType(_PAYLOAD))])

# Default destination topics, and the source tables of the main one (fixed values).
EVENTS_TOPIC = "clickstream-events"
MAIN_TOPIC = "cdc-events"
MAIN_TABLES = ("users", "products", "distribution_centers", "inventory_items", "orders", "order_items")


def lake_table(table: Column) -> Column:
    """Lake name of a source table; ``unknown`` when missing."""
    named = table
    for source, lake in LAKE_NAMES.items():
        named = F.when(table == source, lake).otherwise(named)
    return F.coalesce(named, F.lit("unknown"))


def parse_cdc(messages: DataFrame) -> DataFrame:
    """Unwrap an envelope in any of its shapes; adds table, schema_name, op, cdc_timestamp, after, before."""
    body = F.from_json("value", _ENVELOPE)
    frame = messages.withColumn("_body", once(body))
    has_inner = F.coalesce(F.col("_body.value_json"), F.lit("")) != ""
    frame = frame.withColumn("_inner", once(F.when(has_inner, F.from_json("_body.value_json", _INNER))))

    def field(path: str) -> Column:
        in_inner = F.when(
            F.col("_inner.payload").isNotNull(), F.col(f"_inner.payload.{path}")
        ).otherwise(F.col(f"_inner.{path}"))
        in_body = F.when(F.col("_body.payload").isNotNull(), F.col(f"_body.payload.{path}")).otherwise(
            F.col(f"_body.{path}")
        )
        return F.when(has_inner, in_inner).otherwise(in_body)

    def first_filled(*columns: Column) -> Column:
        return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])

    def first_nonzero(*columns: Column) -> Column:
        return F.coalesce(*[F.nullif(c, F.lit(0).cast("bigint")) for c in columns])

    kept = [c for c in messages.columns]
    return frame.select(
        *kept,
        lake_table(first_filled(field("source.table"), F.col("_body.table"))).alias("table"),
        first_filled(field("source.schema"), F.col("_body.schema")).alias("schema_name"),
        field("op").alias("op"),
        first_nonzero(field("ts_ms"), field("source.ts_ms")).alias("cdc_timestamp"),
        field("after").alias("after"),
        field("before").alias("before"),
    )


def epoch_instant(text: Column, unit: str = "digits") -> Column:
    """A ``*_at`` value of a row image: a number is epoch time, text an ISO instant, anything else null.

    ``unit="micros"`` reads every number as microseconds; ``"digits"`` goes by its length.
    """
    if unit == "micros":
        return F.when(text.rlike("^-?[0-9]+$"), F.timestamp_micros(text.try_cast("bigint"))).otherwise(
            text.try_cast("timestamp")
        )
    return to_instant(text)


def flatten(parsed: DataFrame, table: str, unit: str = "digits") -> DataFrame:
    """Rows of one table in its bronze schema: the ``after`` image, or ``before`` when there is none."""
    source = SOURCE_TABLES[table]
    lake = LAKE_NAMES.get(table, table)
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in source.fields])
    empty = F.coalesce(F.nullif(F.col("after"), F.lit("{}")), F.col("before"))
    rows = parsed.where(F.col("table") == lake).withColumn("_image", once(F.from_json(empty, texts)))

    def typed(field: T.StructField) -> Column:
        text = F.col(f"_image.{field.name}")
        if isinstance(field.dataType, T.TimestampType):
            return epoch_instant(text, unit).alias(field.name)
        return text.try_cast(field.dataType).alias(field.name)

    extra = [c for c in ("topic", "timestamp") if c in parsed.columns]
    return rows.select(
        *[typed(f) for f in source.fields],
        "cdc_timestamp",
        F.col("op").alias("cdc_operation"),
        *[F.col(c).alias(f"_{c}") for c in extra],
    )


def route_hot(parsed: DataFrame, hot: Sequence[str] = HOT_TABLES) -> DataFrame:
    return parsed.where(F.col("table").isin(*hot))


def route_cold(parsed: DataFrame, hot: Sequence[str] = HOT_TABLES) -> DataFrame:
    return parsed.where(~F.col("table").isin(*hot))


def topic_of(source_topic: Column, events_topic: str = EVENTS_TOPIC, main_topic: str = MAIN_TOPIC) -> Column:
    """Destination topic of a connector topic ``<server>.<schema>.<table>``; unrouted names stay."""
    main = "|".join(MAIN_TABLES)
    return (
        F.when(source_topic.rlike(r"^(.*)\.events$"), events_topic)
        .when(source_topic.rlike(rf"^(.*)\.({main})$"), main_topic)
        .otherwise(source_topic)
    )


def normalise_timestamps(rows: DataFrame, unit: str = "micros") -> DataFrame:
    """Every ``*_at`` column as an instant: whole numbers are epoch, text is ISO, junk is null."""
    return rows.select(
        *[
            F.col(f.name)
            if not f.name.endswith("_at") or isinstance(f.dataType, T.TimestampType)
            else epoch_instant(F.col(f.name).cast("string"), unit).alias(f.name)
            for f in rows.schema.fields
        ]
    )


def normalise_schema(rows: DataFrame, unit: str = "micros") -> DataFrame:
    """Column types a lake file must have: ``*_at`` instants, integers 64-bit, untyped columns text;
    columns in name order, so files of different batches agree."""
    casts = []
    fields = {f.name: f.dataType for f in normalise_timestamps(rows, unit).schema.fields}
    for name in sorted(fields):
        kind = fields[name]
        if isinstance(kind, T.IntegralType):
            casts.append(F.col(name).cast("bigint").alias(name))
        elif isinstance(kind, T.NullType):
            casts.append(F.col(name).cast("string").alias(name))
        else:
            casts.append(F.col(name))
    return normalise_timestamps(rows, unit).select(*casts)


def union_batches(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Batches whose column sets differ, missing columns null."""
    result = normalise_schema(first)
    for other in others:
        result = result.unionByName(normalise_schema(other), allowMissingColumns=True)
    return result


def to_transport(messages: DataFrame, now: Column) -> DataFrame:
    """Raw replay record of a broker message (topic, partition, offset, key, value, timestamp)."""
    names = set(messages.columns)

    def either(name: str, otherwise: Column) -> Column:
        return F.col(name) if name in names else otherwise

    return messages.select(
        F.coalesce(either("timestamp", now), now).alias("ingested_at"),
        either("topic", F.lit(None)).cast("string").alias("topic"),
        either("partition", F.lit(None)).cast("bigint").alias("partition"),
        either("offset", F.lit(None)).cast("bigint").alias("offset"),
        either("key", F.lit(None)).cast("string").alias("key_json"),
        F.col("value").cast("string").alias("value_json"),
    )


def bronze_types() -> Mapping[str, T.StructType]:
    return {table: bronze_schema(table) for table in SOURCE_TABLES}
