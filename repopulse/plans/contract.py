"""The data contract: which tests each table must pass, and how fresh the sources must be."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repopulse.operators.quality import (
    Accepted,
    InRange,
    NotNull,
    References,
    Singular,
    Test,
    Unique,
    freshness,
    run_tests,
)
from repopulse.operators.scd2 import broken_histories
from repopulse.schemas import OUTCOME_NAMES

# Hours after which a source warns, and after which it fails.
EVENT_LIMITS = (36, 72)
FETCH_LIMITS = (48, None)
RECENT_DAYS = 2
QUEUE_REASONS = ("trending", "most_active", "refresh")


def contract(tables: dict[str, DataFrame], now: Column) -> dict[str, list[Test]]:
    """Tests per table. `tables` holds the staged and gold DataFrames by name.

    Repeated event ids are searched among recently loaded rows only, and only warn.
    """
    recent = F.col("_ingested_at") >= now - F.make_dt_interval(days=F.lit(RECENT_DAYS))
    chains = broken_histories(tables["repo_history"], "repo_id", "valid_from", "valid_to")
    return {
        "events": [
            NotNull("event_id"),
            Unique(("event_id",), where=recent, severity="warn"),
            NotNull("event_type"),
            NotNull("event_date"),
            InRange("event_hour", 0, 23),
            NotNull("repo_id"),
        ],
        "repo_fetches": [
            NotNull("repo_id"),
            NotNull("fetched_at"),
            Accepted("fetch_outcome", OUTCOME_NAMES),
        ],
        "repo_history": [
            NotNull("repo_id"),
            NotNull("valid_from"),
            Singular("history_is_contiguous", chains),
        ],
        "latest_fetch": [Unique(("repo_id",)), NotNull("repo_id")],
        "repo_daily_activity": [
            Unique(("event_date", "repo_id")),
            NotNull("event_date"),
            NotNull("repo_id"),
        ],
        "hourly_activity": [
            Unique(("event_date", "event_hour", "event_type")),
            NotNull("event_hour"),
            InRange("event_hour", 0, 23),
        ],
        "repo_dim": [
            Unique(("repo_id",)),
            NotNull("repo_id"),
            NotNull("full_name"),
            Accepted("latest_outcome", OUTCOME_NAMES),
        ],
        "repo_snapshot_daily": [
            Unique(("snapshot_date", "repo_id")),
            NotNull("stargazers_count"),
            InRange("stargazers_count", low=0),
        ],
        "trending_repos": [
            Unique(("trending_rank",)),
            NotNull("trending_rank"),
            References("repo_id", tables["repo_dim"], "repo_id", severity="warn"),
        ],
        "trending_languages": [
            Unique(("language",)),
            NotNull("language"),
            Unique(("language_rank",)),
            NotNull("language_rank"),
        ],
        "refresh_queue": [
            Unique(("priority",)),
            NotNull("priority"),
            Unique(("repo_id",)),
            NotNull("repo_id"),
            NotNull("repo_name"),
            Accepted("reason", QUEUE_REASONS),
        ],
    }


def contract_results(
    tables: dict[str, DataFrame], now: Column | None = None, only: list[str] | None = None
) -> DataFrame:
    """One row per test of the contract, for all tables or the named ones."""
    tests = contract(tables, F.current_timestamp() if now is None else now)
    names = list(tests) if only is None else only
    return reduce(
        DataFrame.unionByName, [run_tests(tables[name], name, tests[name]) for name in names]
    )


def source_freshness(events: DataFrame, fetches: DataFrame, now: Column | None = None) -> DataFrame:
    now = F.current_timestamp() if now is None else now
    return freshness(events, "events", "_ingested_at", now, *EVENT_LIMITS).unionByName(
        freshness(fetches, "repo_fetches", "_ingested_at", now, *FETCH_LIMITS)
    )
