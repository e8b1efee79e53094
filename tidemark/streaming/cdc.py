"""Change-stream jobs: hot and cold landing, raw replay copy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import cdc
from tidemark.schemas import HOT_TABLES, LAKE_NAMES, SOURCE_TABLES
from tidemark.streaming.sinks import start_batches, start_table, write_batch

FLUSH = "60 seconds"


def land_hot(
    messages: DataFrame, root: str, checkpoint: str, hot: Sequence[str] = HOT_TABLES, unit: str = "digits",
    every: str | None = None,
) -> list[StreamingQuery]:
    """Append the changes of each hot table to ``root/<table>``."""
    queries = []
    for table in hot:
        rows = cdc.flatten(cdc.route_hot(cdc.parse_cdc(messages), (table,)), table, unit)
        rows = rows.withColumn("date", F.to_date("_timestamp")).drop("_topic", "_timestamp")
        target = f"{root}/{LAKE_NAMES.get(table, table)}"
        queries.append(start_table(rows, target, f"{checkpoint}/{table}", f"hot_{table}", ("date",), every))
    return queries


def land_cold(
    messages: DataFrame, root: str, checkpoint: str, hot: Sequence[str] = HOT_TABLES, unit: str = "digits",
    every: str | None = None,
) -> StreamingQuery:
    """Append all other changes to ``root/<table>/date=/hour=/``, by transport time.

    Changes of tables without a known schema are kept as JSON below ``root/other``.
    """
    tables = [t for t in SOURCE_TABLES if t not in hot]

    def flush(batch: DataFrame, batch_id: int) -> None:
        parsed = cdc.route_cold(cdc.parse_cdc(batch), hot).persist()
        moments = {"date": F.to_date("_timestamp"), "hour": F.date_format("_timestamp", "HH")}
        try:
            present = {row.table for row in parsed.select("table").distinct().collect()}  # a handful of names
            for table in tables:
                lake = LAKE_NAMES.get(table, table)
                if lake in present:
                    rows = cdc.flatten(parsed, table, unit).withColumns(moments).drop("_topic", "_timestamp")
                    write_batch(rows, batch_id, f"{root}/{lake}", ("date", "hour"))
                    present.discard(lake)
            if present:
                known = [LAKE_NAMES.get(t, t) for t in tables]
                rest = parsed.where(~F.col("table").isin(*known)).withColumnRenamed("timestamp", "_timestamp")
                columns = ("table", "schema_name", "op", "cdc_timestamp", "after", "before")
                rows = rest.withColumns(moments).select(*columns, "date", "hour")
                write_batch(rows, batch_id, f"{root}/other", ("date", "hour"))
        finally:
            parsed.unpersist()

    return start_batches(messages, flush, checkpoint, "cold_landing", every=every)


def land_raw(
    messages: DataFrame, table_path: str, archive_path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Write every message unparsed to a table and to an archive copy, for audit and replay."""

    def tee(batch: DataFrame, batch_id: int) -> None:
        records = cdc.to_transport(batch, F.current_timestamp()).persist()
        try:
            write_batch(records, batch_id, table_path)
            write_batch(records.withColumn("ingested_at", F.col("ingested_at").cast("string")), batch_id, archive_path)
        finally:
            records.unpersist()

    return start_batches(messages, tee, checkpoint, "raw_replay", every=every)
