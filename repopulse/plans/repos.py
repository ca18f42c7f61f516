"""Repository tables: fetch state, the dimension, and daily metric snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repopulse.plans.silver import ATTRIBUTES, METRICS

UNCHANGED = "not_modified"
AVAILABLE = ("ok", UNCHANGED)


def _latest(values: list[str], among: Column) -> Column:
    """Columns of the latest fetch that meets a condition; equal times are decided by ETag."""
    when = F.when(among, F.struct("fetched_at", "etag"))
    return F.max_by(F.struct(*values), when)


def latest_fetch(fetches: DataFrame) -> DataFrame:
    """Fetch state per repository: last check, the ETag to send next, the last known metrics.

    One conditional aggregate with map-side combine: one pass and one shuffle, no joins.
    """
    available = F.col("fetch_outcome").isin(*AVAILABLE)
    measured = [*METRICS, "pushed_at"]
    state = fetches.groupBy("repo_id").agg(
        _latest(["fetched_at", "fetch_outcome"], F.lit(True)).alias("checked"),
        _latest(["etag"], available & F.col("etag").isNotNull()).alias("tagged"),
        _latest(["fetched_at", *measured], F.col("fetch_outcome") == "ok").alias("measured"),
    )
    return state.select(
        "repo_id",
        F.col("checked.fetched_at").alias("last_checked_at"),
        F.col("checked.fetch_outcome").alias("latest_outcome"),
        F.col("checked.fetch_outcome").isin(*AVAILABLE).alias("is_available"),
        F.col("tagged.etag").alias("last_etag"),
        F.col("measured.fetched_at").alias("metrics_as_of"),
        *[f"measured.{name}" for name in measured],
    )


def repo_dim(history: DataFrame, fetch_state: DataFrame, as_of: Column | None = None) -> DataFrame:
    """One row per repository: current attributes, number of versions, availability, metrics.

    Versions are counted and the current one is picked in a single aggregate over the history, so
    the history is read once. `as_of` is the day ages are counted to, today unless given.
    """
    today = F.current_date() if as_of is None else as_of
    described = [*ATTRIBUTES, "repo_created_at", "valid_from"]
    current_since = F.when(F.col("is_current"), F.col("valid_from"))
    repos = history.groupBy("repo_id").agg(
        F.max_by(F.struct(*described), current_since).alias("now"),
        F.count("*").alias("version_count"),
        F.min("valid_from").alias("first_seen_at"),
    )
    metrics = [*METRICS, "pushed_at", "metrics_as_of"]
    state = fetch_state.select(
        "repo_id", "is_available", "latest_outcome", "last_checked_at", *metrics
    )
    current = repos.where(F.col("now").isNotNull())
    return current.join(state, "repo_id", "left").select(
        "repo_id",
        *[f"now.{name}" for name in (*ATTRIBUTES, "repo_created_at")],
        F.date_diff(today, F.to_date("now.repo_created_at")).alias("repo_age_days"),
        F.col("now.valid_from").alias("current_version_since"),
        "version_count",
        "first_seen_at",
        "is_available",
        "latest_outcome",
        "last_checked_at",
        *metrics,
    )


def repo_snapshot_daily(fetches: DataFrame) -> DataFrame:
    """Metrics per repository and day it was checked; an unchanged check carries them forward.

    Each day is first reduced to its last check and last known metrics (map-side combine), so the
    windows see at most one row per repository and calendar day, however often it was checked.
    """
    when = F.struct("fetched_at", "etag")
    checks = fetches.where(F.col("fetch_outcome").isin(*AVAILABLE))
    known = [
        F.max_by(metric, F.when(F.col(metric).isNotNull(), when)).alias(metric)
        for metric in METRICS
    ]
    days = checks.groupBy("repo_id", F.to_date("fetched_at").alias("snapshot_date")).agg(
        F.max_by(F.struct("fetched_at", "fetch_outcome"), when).alias("last"), *known
    )
    by_day = Window.partitionBy("repo_id").orderBy("snapshot_date")
    so_far = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = days.select(
        "repo_id",
        "snapshot_date",
        "last",
        *[F.last(metric, ignorenulls=True).over(so_far).alias(metric) for metric in METRICS],
    ).where(F.col("stargazers_count").isNotNull())
    change = F.col("stargazers_count") - F.lag("stargazers_count").over(by_day)
    return filled.select(
        "snapshot_date",
        "repo_id",
        *METRICS,
        (F.col("last.fetch_outcome") == UNCHANGED).alias("is_carried_forward"),
        change.alias("stars_change"),
        F.col("last.fetched_at").alias("snapshot_at"),
    )
