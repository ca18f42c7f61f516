"""Typed, flattened and checked rows from the landed events and fetch records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repopulse.functions.events import (
    fetch_outcome,
    is_bot,
    owner_of,
    utc_date,
    utc_hour,
    utc_instant,
)
from repopulse.operators.expect import Expectations
from repopulse.operators.scd2 import END, START
from repopulse.schemas import FETCH_OUTCOMES, KNOWN_EVENT_TYPES


def _in_list(column: str, values) -> str:
    return f"{column} IN ({', '.join(repr(value) for value in values)})"


# Rule names and predicates.
EVENT_RULES = Expectations(
    required={
        "valid_event_id": "event_id IS NOT NULL",
        "valid_event_type": "event_type IS NOT NULL",
        "valid_created_at": "created_at IS NOT NULL",
        "valid_repo": "repo_id IS NOT NULL AND repo_name IS NOT NULL",
    },
    expected={"known_event_type": _in_list("event_type", KNOWN_EVENT_TYPES)},
)
FETCH_RULES = Expectations(
    required={
        "valid_repo_id": "repo_id IS NOT NULL",
        "valid_fetched_at": "fetched_at IS NOT NULL",
    },
    expected={"known_http_status": _in_list("http_status", FETCH_OUTCOMES)},
)
SNAPSHOT_RULES = Expectations(
    required={
        "valid_repo_id": "repo_id IS NOT NULL",
        "valid_full_name": "full_name IS NOT NULL",
        "valid_fetched_at": "fetched_at IS NOT NULL",
    },
)

METRICS = ("stargazers_count", "forks_count", "open_issues_count", "subscribers_count")

# Descriptive attributes in stored order.
ATTRIBUTES = (
    "full_name",
    "owner_login",
    "owner_type",
    "description",
    "homepage",
    "language",
    "topics",
    "license_spdx_id",
    "is_fork",
    "parent_full_name",
    "is_archived",
    "is_disabled",
    "is_template",
    "visibility",
    "default_branch",
)


def type_events(landed: DataFrame) -> DataFrame:
    """Event columns with their types; a value that cannot be read becomes null."""
    stamp, login, name = F.col("created_at"), F.col("actor.login"), F.col("repo.name")
    typed = {
        "event_id": F.col("id"),
        "event_type": F.col("type"),
        "action": F.get_json_object("payload", "$.action"),
        "created_at": utc_instant(stamp),
        "event_date": utc_date(stamp),
        "event_hour": utc_hour(stamp),
        "actor_id": F.col("actor.id"),
        "actor_login": login,
        "is_bot": is_bot(login),
        "repo_id": F.col("repo.id"),
        "repo_name": name,
        "repo_owner": owner_of(name),
        "org_login": F.col("org.login"),
        "payload_json": F.col("payload"),
        "_source_file": F.col("_source_file"),
        "_ingested_at": F.col("_ingested_at"),
    }
    return landed.select(*[column.alias(alias) for alias, column in typed.items()])


def type_fetches(landed: DataFrame) -> DataFrame:
    """The fetch log: one row per attempt, keyed on the id that was answered if there is one."""
    return landed.select(
        F.ifnull("repo.id", "repo_id").alias("repo_id"),
        F.col("repo_id").alias("queued_repo_id"),
        "requested_name",
        utc_instant(F.col("fetched_at")).alias("fetched_at"),
        "http_status",
        fetch_outcome(F.col("http_status")).alias("fetch_outcome"),
        "etag",
        "repo.full_name",
        *[f"repo.{metric}" for metric in METRICS],
        "repo.size_kb",
        utc_instant(F.col("repo.pushed_at")).alias("pushed_at"),
        "_ingested_at",
    )


def repo_snapshots(landed: DataFrame) -> DataFrame:
    """Full attribute snapshots, from successful fetches only.

    A list of topics counts as a set.
    """
    topics = F.array_sort(F.coalesce("repo.topics", F.array().cast("array<string>")))
    columns = [topics.alias(a) if a == "topics" else F.col(f"repo.{a}") for a in ATTRIBUTES]
    found = (F.col("http_status") == 200) & F.col("repo").isNotNull()
    return landed.where(found).select(
        F.col("repo.id").alias("repo_id"),
        *columns,
        utc_instant(F.col("repo.created_at")).alias("repo_created_at"),
        utc_instant(F.col("fetched_at")).alias("fetched_at"),
    )


# --- staging: the columns the gold tables may rely on ---------------------------------------------

# Column lists.
STAGED_EVENT_COLUMNS = (
    "event_id",
    "event_type",
    "action",
    "created_at",
    "event_date",
    "event_hour",
    "actor_id",
    "actor_login",
    "is_bot",
    "repo_id",
    "repo_name",
    "repo_owner",
    "org_login",
    "_ingested_at",
)
STAGED_FETCH_COLUMNS = (
    "repo_id",
    "queued_repo_id",
    "requested_name",
    "full_name",
    "fetched_at",
    "http_status",
    "fetch_outcome",
    "etag",
    *METRICS,
    "pushed_at",
    "_ingested_at",
)


def staged_events(silver: DataFrame) -> DataFrame:
    return silver.select(*STAGED_EVENT_COLUMNS)


def staged_fetches(silver: DataFrame) -> DataFrame:
    return silver.select(*STAGED_FETCH_COLUMNS)


def staged_history(history: DataFrame) -> DataFrame:
    return history.select(
        "repo_id",
        *ATTRIBUTES,
        "repo_created_at",
        F.col(START).alias("valid_from"),
        F.col(END).alias("valid_to"),
        F.col(END).isNull().alias("is_current"),
    )
