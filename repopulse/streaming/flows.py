"""Append-only flows. Each run loads what is new and stops; a restart loads nothing twice."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from repopulse.plans import silver
from repopulse.schemas import BRONZE_EVENT_DDL, BRONZE_FETCH_DDL
from repopulse.sources import landing
from repopulse.streaming.batches import BatchTable, count_only


def append(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write everything available now to a parquet table, exactly once, and wait for it."""
    query = (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()
    return query


def table_stream(
    spark: SparkSession, path: str, schema: StructType | str, max_files: int | None = None
) -> DataFrame:
    """New rows of a stored append-only table; `max_files` bounds a batch."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def load_events(
    spark: SparkSession,
    landed: str,
    table: str,
    checkpoint: str,
    max_files: int | None = None,
    glob: str = landing.LANDED_FILES,
    tasks: int | None = None,
) -> StreamingQuery:
    """Landed event files to bronze.

    `max_files` bounds a batch when much has piled up; `tasks` spreads few large files.
    """
    lines = landing.spread(landing.stream_lines(spark, landed, glob, max_files), tasks)
    return append(landing.event_rows(lines), table, checkpoint)


def load_fetches(
    spark: SparkSession,
    landed: str,
    table: str,
    checkpoint: str,
    max_files: int | None = None,
    glob: str = landing.LANDED_FILES,
    tasks: int | None = None,
) -> StreamingQuery:
    """Landed fetch records to bronze."""
    lines = landing.spread(landing.stream_lines(spark, landed, glob, max_files), tasks)
    return append(landing.fetch_rows(lines), table, checkpoint)


def into(rows: DataFrame, table: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Give everything available now to a table, batch by batch, and wait for it."""
    query = (
        rows.writeStream.foreachBatch(table)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def event_table(path: str, records: str) -> BatchTable:
    """Typed events: a folder per date, and in it sorted by type and time."""
    return BatchTable(
        path,
        records,
        "silver_events",
        silver.EVENT_RULES,
        order=["event_type", "created_at"],
        date="event_date",
        partition="event_date",
    )


def fetch_table(path: str, records: str) -> BatchTable:
    """The typed fetch log, sorted by repository and time."""
    return BatchTable(
        path,
        records,
        "silver_repo_fetches",
        silver.FETCH_RULES,
        order=["repo_id", "fetched_at"],
        date="to_date(fetched_at)",
    )


def type_events(
    spark: SparkSession,
    bronze: str,
    table: str,
    checkpoint: str,
    records: str,
    within: str | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """Bronze events to silver.

    Repeated event ids are kept. `within` (an interval such as `2 hours`) drops the later copies
    that arrive that close together in event time, across batches and restarts: the ids of that time
    are kept as state, and rows older than it are left out. Off unless asked for.
    """
    rows = silver.type_events(table_stream(spark, bronze, BRONZE_EVENT_DDL, max_files))
    sink = event_table(table, records)
    if within:
        # Copies go before the table sees them, so the rules are counted on all rows by themselves,
        # by a stream of their own at the same time.
        count = count_only(records, "all_events", silver.EVENT_RULES)
        single = silver.EVENT_RULES.keep(rows).withWatermark("created_at", within)
        single = single.dropDuplicatesWithinWatermark(["event_id"])
        with ThreadPoolExecutor(max_workers=1) as pool:
            counted = pool.submit(into, rows, count, f"{checkpoint}_counts")
            query = into(single, sink, checkpoint)
            counted.result()
        return query
    return into(rows, sink, checkpoint)


def type_fetches(
    spark: SparkSession, bronze: str, table: str, checkpoint: str, records: str
) -> StreamingQuery:
    """Bronze fetch records to the typed fetch log."""
    rows = silver.type_fetches(table_stream(spark, bronze, BRONZE_FETCH_DDL))
    return into(rows, fetch_table(table, records), checkpoint)
