"""Upkeep of date-grained tables: recompute in full each date that received new rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repopulse.sources.tables import replace_partitions, scan_if_exists

LOADED_AT = "_ingested_at"
LOADED_THROUGH = "_loaded_through"
DATE = "event_date"
APPLIED = "_applied"  # the last load each table includes


def changed_dates(source: DataFrame, mark: int | None) -> DataFrame:
    """Dates with a row loaded after `mark` (microseconds); every date when there is no mark yet.

    One column, one row per calendar day, so it is safe to broadcast. The mark is a constant of the
    plan, so it is pushed down to the scan.
    """
    if mark is not None:
        source = source.where(F.col(LOADED_AT) > F.timestamp_micros(F.lit(mark)))
    return source.where(F.col(DATE).isNotNull()).select(DATE).distinct()


def rows_to_recompute(source: DataFrame, mark: int | None) -> DataFrame:
    """All rows, old and new, of the changed dates.

    On a source partitioned by date the join prunes partitions at run time, so a late batch reads
    only the dates it touches. Rows without a date belong to no partition and are left out.
    """
    if mark is None:
        return source.where(F.col(DATE).isNotNull())
    return source.join(F.broadcast(changed_dates(source, mark)), DATE, "left_semi")


def high_water_mark(target: DataFrame | None) -> int | None:
    """Latest load time a table includes, in microseconds so that no time zone is involved."""
    return None if target is None else target.agg(F.unix_micros(F.max(LOADED_THROUGH))).first()[0]


@dataclass(frozen=True)
class Changes:
    """Dates that loads after the last applied one have touched; None stands for all dates."""

    dates: list[date] | None
    through: int


def changes(ledger: DataFrame, applied: int | None) -> Changes:
    """What a ledger (load, event_date) tells an upkeep run.

    Only the ledger is read, and its dates are bounded by the calendar.
    """
    through = ledger.agg(F.coalesce(F.max("load"), F.lit(-1))).first()[0]
    if applied is None:
        return Changes(None, through)
    later = ledger.where((F.col("load") > applied) & F.col(DATE).isNotNull())
    return Changes([row[0] for row in later.select(DATE).distinct().collect()], through)


def _applied(spark: SparkSession, name: str, root: str) -> int | None:
    found = scan_if_exists(spark, f"{APPLIED}/{name}", root)
    return None if found is None else found.first()[0]


def _apply(spark: SparkSession, name: str, root: str, through: int) -> None:
    row = spark.range(1).select(F.lit(through).cast("bigint").alias("load"))
    row.write.mode("overwrite").parquet(f"{root}/{APPLIED}/{name}")


def merge_dates(target: DataFrame, recomputed: DataFrame) -> DataFrame:
    """The table after an upkeep run: recomputed dates replace what was there.

    Same as upserting by key, because the source only grows and a date is recomputed whole.
    """
    dates = F.broadcast(recomputed.select(DATE).distinct())
    return target.join(dates, DATE, "left_anti").unionByName(recomputed)


def refresh(
    spark: SparkSession,
    source: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    name: str,
    root: str,
    sort_by: list[str],
    full: bool = False,
    beside: str | None = None,
    ledger: DataFrame | None = None,
) -> DataFrame:
    """Bring the stored table `name` up to date and return it.

    With `beside` the recomputed dates are written to that folder and the stored table stays as it
    is; what is returned is the table as it would be. `publish` then takes the dates over.

    The mark is read before anything is written, and only whole date partitions are replaced, so a
    run that dies half-way is repaired by running it again. A full refresh replaces the whole table:
    dates that left the source go.

    With a `ledger` of the source's loads the changed dates come from it, and the mark is the last load
    applied, kept beside the table: neither the source nor the table is scanned for them, and dates are
    part of the plan, so only their files are read.
    """
    target = None if full else scan_if_exists(spark, name, root)
    if ledger is None:
        rows = rows_to_recompute(source, high_water_mark(target))
    else:
        found = changes(ledger, None if target is None else _applied(spark, name, root))
        known = F.col(DATE).isNotNull() if found.dates is None else F.col(DATE).isin(found.dates)
        rows = source.where(known)
    built = build(rows)
    if beside:
        replace_partitions(built, f"{beside}/{name}", DATE, sort_by, whole=True)
        if ledger is not None:
            _apply(spark, name, beside, found.through)
        recomputed = scan_if_exists(spark, name, beside)
        if recomputed is None:
            return built if target is None else target
        return recomputed if target is None else merge_dates(target, recomputed)
    replace_partitions(built, f"{root}/{name}", DATE, sort_by, whole=full)
    if ledger is not None:
        _apply(spark, name, root, found.through)
    stored = scan_if_exists(spark, name, root)
    return built if stored is None else stored  # nothing is stored while there is no row at all


def publish(
    spark: SparkSession, name: str, root: str, beside: str, sort_by: list[str], full: bool
) -> None:
    """Take over the dates that `refresh` has written beside the table.

    A full refresh that left none has found an empty source, so the table is emptied.
    """
    recomputed = scan_if_exists(spark, name, beside)
    if recomputed is None and full:
        stored = scan_if_exists(spark, name, root)
        if stored is not None:
            recomputed = spark.createDataFrame([], stored.schema)
    if recomputed is not None:
        replace_partitions(recomputed, f"{root}/{name}", DATE, sort_by, whole=full)
    through = _applied(spark, name, beside)
    if through is not None:
        _apply(spark, name, root, through)
