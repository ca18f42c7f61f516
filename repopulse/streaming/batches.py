"""Tables that grow by the batches of a stream, with a record of what each batch held.

A batch is written to a folder of its own, clustered, and leaves two small records: a ledger of the
dates it touched, and the violations of its rules. All three are replaced when a batch is repeated, so
a run that dies half-way is repaired by its repetition, and what it has counted outlives the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from repopulse.operators.expect import Expectations
from repopulse.sources.tables import scan_if_exists

LOAD = "load"
LOADED_AT = "_ingested_at"
TIMES = "spark.sql.parquet.outputTimestampType"
LEDGER = "load bigint, event_date date, rows bigint, loaded_through timestamp"
VIOLATIONS = "load bigint, rule string, action string, violations bigint"


@dataclass(frozen=True)
class BatchTable:
    """Takes the batches of one stream: rows to `path`, records below `records` under `name`.

    Rows that break a required rule are left out. The others are sorted by `order`, so the statistics
    of row groups and pages let scans skip, for times as well; `partition` is a date column that gets
    a folder per value. A stream that begins anew needs a new table.
    """

    path: str
    records: str
    name: str
    rules: Expectations
    order: list[str]
    date: str
    partition: str | None = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        seen, spark = Observation(), batch.sparkSession
        keys = [self.partition] if self.partition else []
        placed = self.rules.watch(batch, seen).hint("rebalance", *keys, *self.order[:1])
        writer = placed.sortWithinPartitions(*keys, *self.order).write.mode("overwrite")
        if self.partition:
            writer = writer.partitionBy(self.partition)
        folder = f"{LOAD}={batch_id}"
        with _times_with_statistics(spark):
            writer.parquet(f"{self.path}/{folder}")
        write_violations(spark, self.records, self.name, self.rules, batch_id, seen.get)
        written = spark.read.schema(batch.schema).parquet(f"{self.path}/{folder}")
        dates = written.groupBy(F.expr(self.date).alias("event_date")).agg(
            F.count("*").alias("rows"), F.max(LOADED_AT).alias("loaded_through")
        )
        dates.coalesce(1).write.mode("overwrite").parquet(
            f"{self.records}/ledger/{self.name}/{folder}"
        )


@contextmanager
def _times_with_statistics(spark: SparkSession) -> Iterator[None]:
    """Times are written as a type that has statistics. A stream has a copy of the session; in any
    other the setting is put back."""
    before = spark.conf.get(TIMES)
    spark.conf.set(TIMES, "TIMESTAMP_MICROS")
    try:
        yield
    finally:
        spark.conf.set(TIMES, before)


def write_violations(
    spark: SparkSession, records: str, name: str, rules: Expectations, load: int, counts: dict
) -> None:
    """One row per rule, and one for all rows of a batch."""
    rows = [("rows", "seen", counts["rows"] or 0)]
    rows += [(rule, action, counts[rule] or 0) for rule, action in rules.actions().items()]
    one = spark.createDataFrame(rows, "rule string, action string, violations bigint").coalesce(1)
    one.write.mode("overwrite").parquet(f"{records}/violations/{name}/{LOAD}={load}")


def count_only(records: str, name: str, rules: Expectations):
    """For `foreachBatch`: only the violations of each batch."""

    def count(batch: DataFrame, batch_id: int) -> None:
        found = batch.agg(F.count("*").alias("rows"), *rules.violations()).first().asDict()
        write_violations(batch.sparkSession, records, name, rules, batch_id, found)

    return count


def _record(spark: SparkSession, records: str, kind: str, name: str, ddl: str) -> DataFrame:
    # Some folders may hold no row, and so no schema: it is given.
    if scan_if_exists(spark, f"{kind}/{name}", records) is None:
        return spark.createDataFrame([], ddl)
    return spark.read.schema(ddl).parquet(f"{records}/{kind}/{name}")


def ledger(spark: SparkSession, records: str, name: str) -> DataFrame:
    """(load, event_date, rows, loaded_through): the dates each batch of a table has touched."""
    return _record(spark, records, "ledger", name, LEDGER)


def violations(
    spark: SparkSession, records: str, name: str, after: int | None = None
) -> DataFrame:
    """(rule, action, violations) over all finished batches, or those after one.

    `rows` is how many rows were seen.
    """
    found = _record(spark, records, "violations", name, VIOLATIONS)
    if after is not None:
        found = found.where(F.col(LOAD) > after)
    return found.groupBy("rule", "action").agg(F.sum("violations").alias("violations"))


def last_load(spark: SparkSession, records: str, name: str) -> int:
    """The last finished batch, -1 if there is none."""
    found = _record(spark, records, "violations", name, VIOLATIONS)
    return found.agg(F.coalesce(F.max(LOAD), F.lit(-1))).first()[0]
