"""Activity facts: what happened per repository and day, and per hour and event type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repopulse.functions.events import counts_as


def repo_daily_activity(events: DataFrame) -> DataFrame:
    """One row per repository and UTC day.

    Spark first reduces to (date, repository, actor) on the map side, so a repository with a third
    of all events is spread by its actors. Name and organisation come from the latest event of the
    day, through one struct maximum: equal times are decided by name, and no event id is read.
    """
    latest = F.max(F.struct("created_at", "repo_name", "org_login"))
    human = F.when(~F.col("is_bot"), F.col("actor_id"))
    facts = events.groupBy("event_date", "repo_id").agg(
        latest.alias("_latest"),
        counts_as("WatchEvent").alias("stars"),
        counts_as("ForkEvent").alias("forks"),
        counts_as("PushEvent").alias("pushes"),
        counts_as("PullRequestEvent", "opened").alias("pull_requests_opened"),
        counts_as("PullRequestEvent", "merged").alias("pull_requests_merged"),
        counts_as("IssuesEvent", "opened").alias("issues_opened"),
        counts_as("ReleaseEvent", "published").alias("releases"),
        F.count_distinct(human).alias("unique_human_actors"),
        F.count("*").alias("total_events"),
        F.count_if("is_bot").alias("bot_events"),
        F.max("_ingested_at").alias("_loaded_through"),
    )
    keys = ["event_date", "repo_id"]
    measures = [c for c in facts.columns if c not in (*keys, "_latest")]
    return facts.select(*keys, "_latest.repo_name", "_latest.org_login", *measures)


def hourly_activity(events: DataFrame) -> DataFrame:
    """Event volume per UTC hour and type, with the part of it that bots caused."""
    return events.groupBy("event_date", "event_hour", "event_type").agg(
        F.count("*").alias("events"),
        F.count_if("is_bot").alias("bot_events"),
        F.count_distinct("actor_id").alias("unique_actors"),
        F.max("_ingested_at").alias("_loaded_through"),
    )
