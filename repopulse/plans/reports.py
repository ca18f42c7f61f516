"""Report panels and profile figures over the gold tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repopulse.operators.ranking import top_ranked
from repopulse.operators.small import broadcast_up_to, lookup
from repopulse.params import Params
from repopulse.schemas import TRACKED_ATTRIBUTES


def panels(tables: dict[str, DataFrame], params: Params) -> dict[str, DataFrame]:
    """All reports over the tables of a run, by name."""
    daily, hourly = tables["repo_daily_activity"], tables["hourly_activity"]
    trending, repos = tables["trending_repos"], tables["repo_dim"]
    return {
        "headline_figures": headline_figures(daily),
        "trending_panel": trending_panel(trending),
        "trending_languages": tables["trending_languages"],
        "breakout_repos": breakout_repos(trending),
        "activity_by_hour": activity_by_hour(hourly),
        "activity_by_day": activity_by_day(hourly),
        "pull_requests_by_day": pull_requests_by_day(daily, hourly),
        "merge_automation": merge_automation(daily),
        "event_mix": event_mix(hourly),
        "bot_share": bot_share(hourly),
        "events_per_hour": events_per_hour(hourly),
        "repeated_events": repeated_events(tables["events"]),
        "repository_profile": repository_profile(repos),
        "enrichment_coverage": enrichment_coverage(trending, repos, params),
        "history_changes": history_changes(tables["repo_history"]),
    }


def _percent(part: Column, whole: Column, digits: int = 1) -> Column:
    return F.round(F.try_divide(100 * part, whole), digits)


def complete_days(hourly: DataFrame) -> DataFrame:
    """Hourly rows of the days with all 24 hours, so a day still loading shows no false drop."""
    days = (
        hourly.groupBy("event_date")
        .agg(F.count_distinct("event_hour").alias("hours"))
        .where(F.col("hours") == 24)
        .select("event_date")
    )
    return hourly.join(F.broadcast(days), "event_date", "left_semi")


def headline_figures(daily: DataFrame) -> DataFrame:
    """Events, active repositories, stars, merged pull requests, releases and bot share.

    Repositories are reduced first, which leaves counting them to a plain `count`.
    """
    measures = ("total_events", "stars", "pull_requests_merged", "releases", "bot_events")
    per_repo = daily.groupBy("repo_id").agg(*[F.sum(m).alias(m) for m in measures])
    total = per_repo.agg(F.count("*").alias("active_repos"), *[F.sum(m).alias(m) for m in measures])
    return total.select(
        F.col("total_events").alias("events"),
        "active_repos",
        "stars",
        "pull_requests_merged",
        "releases",
        _percent(F.col("bot_events"), F.col("total_events")).alias("bot_share_pct"),
    )


def trending_panel(trending: DataFrame, n: int = 20) -> DataFrame:
    """The first ranks with their language."""
    return trending.where(F.col("trending_rank") <= n).select(
        "trending_rank",
        "repo_name",
        F.coalesce("language", F.lit("No language")).alias("language"),
        "stars_in_window",
        "star_growth_pct",
    )


def breakout_repos(trending: DataFrame) -> DataFrame:
    """Trending repositories that were created recently, with their total stars."""
    return trending.where("is_new_repo").select(
        "trending_rank", "repo_id", "repo_name", "language", "stars_in_window", "total_stars"
    )


def activity_by_hour(hourly: DataFrame) -> DataFrame:
    """Human and bot events per hour of day, over complete days."""
    return (
        complete_days(hourly)
        .groupBy("event_hour")
        .agg(
            F.sum(F.col("events") - F.col("bot_events")).alias("human_events"),
            F.sum("bot_events").alias("bot_events"),
        )
    )


def activity_by_day(hourly: DataFrame) -> DataFrame:
    """Human and bot events per complete day."""
    return (
        complete_days(hourly)
        .groupBy("event_date")
        .agg(
            F.sum(F.col("events") - F.col("bot_events")).alias("human_events"),
            F.sum("bot_events").alias("bot_events"),
        )
    )


def pull_requests_by_day(daily: DataFrame, hourly: DataFrame) -> DataFrame:
    """Pull requests opened and merged per complete day."""
    days = complete_days(hourly).select("event_date").distinct()
    return (
        daily.join(F.broadcast(days), "event_date", "left_semi")
        .groupBy("event_date")
        .agg(
            F.sum("pull_requests_opened").alias("opened"),
            F.sum("pull_requests_merged").alias("merged"),
        )
    )


def merge_automation(daily: DataFrame, n: int = 20) -> DataFrame:
    """Repositories merging the most pull requests, and how automated each one is."""
    merges = daily.groupBy("repo_id").agg(
        F.max_by("repo_name", "event_date").alias("repo_name"),
        F.sum("pull_requests_merged").alias("merged"),
        F.sum("bot_events").alias("bot_events"),
        F.sum("total_events").alias("total_events"),
    )
    order = [F.desc("merged"), F.asc("repo_id")]
    top = top_ranked(merges.where("merged > 0"), n, order, "merge_rank")
    share = _percent(F.col("bot_events"), F.col("total_events"))
    return top.select("merge_rank", "repo_id", "repo_name", "merged", share.alias("bot_share_pct"))


def event_mix(hourly: DataFrame) -> DataFrame:
    """Share of each event type in all events."""
    types = hourly.groupBy("event_type").agg(F.sum("events").alias("events"))
    total = hourly.agg(F.sum("events")).scalar()
    return types.withColumn("share_pct", _percent(F.col("events"), total))


def bot_share(hourly: DataFrame) -> DataFrame:
    """How much of each event type comes from bots."""
    types = hourly.groupBy("event_type").agg(
        F.sum("events").alias("events"), F.sum("bot_events").alias("bot_events")
    )
    return types.withColumn("bot_share_pct", _percent(F.col("bot_events"), F.col("events")))


def events_per_hour(hourly: DataFrame) -> DataFrame:
    """Smallest, average and largest number of events in an hour that has any."""
    hours = hourly.groupBy("event_date", "event_hour").agg(F.sum("events").alias("n"))
    return hours.agg(
        F.count("*").alias("hours"),
        F.min("n").alias("fewest"),
        F.round(F.avg("n"), 1).alias("average"),
        F.max("n").alias("most"),
    )


def repeated_events(events: DataFrame) -> DataFrame:
    """Event ids that occur more than once; they are flagged, never removed."""
    return (
        events.groupBy("event_id")
        .agg(F.count("*").alias("copies"))
        .where(F.col("copies") > 1)
    )


def repository_profile(repos: DataFrame) -> DataFrame:
    """Known repositories, distinct licenses, topics per repository, share without a language."""
    unknown = F.count_if(F.col("language").isNull())
    return repos.agg(
        F.count("*").alias("repos"),
        F.count_distinct("license_spdx_id").alias("licenses"),
        F.round(F.avg(F.size("topics")), 1).alias("avg_topics"),
        _percent(unknown, F.count("*")).alias("no_language_pct"),
    )


def enrichment_coverage(trending: DataFrame, repos: DataFrame, params: Params) -> DataFrame:
    """How many of the trending repositories have known attributes."""
    bound = params.trending_top_n
    listed = trending.select("repo_id")
    known = lookup(listed, repos.select("repo_id"), bound).withColumn("known", F.lit(1))
    marked = listed.join(broadcast_up_to(known, bound), "repo_id", "left")
    return marked.agg(
        F.count("*").alias("trending"),
        F.count("known").alias("enriched"),
        _percent(F.count("known"), F.count("*")).alias("coverage_pct"),
    )


def history_changes(history: DataFrame) -> DataFrame:
    """Changes captured per tracked attribute.

    A version is compared with the one that ends where it starts: an equality join on
    (repository, time), so a repository with very many versions is still spread over all tasks.
    """
    after = history.select("repo_id", F.col("valid_from").alias("at"), *TRACKED_ATTRIBUTES)
    before = history.where(F.col("valid_to").isNotNull()).select(
        "repo_id",
        F.col("valid_to").alias("at"),
        *[F.col(name).alias(f"old_{name}") for name in TRACKED_ATTRIBUTES],
    )
    pairs = after.join(before, ["repo_id", "at"])
    changes = [
        F.struct(
            F.lit(name).alias("attribute"),
            (~F.col(name).eqNullSafe(F.col(f"old_{name}"))).cast("bigint").alias("changed"),
        )
        for name in TRACKED_ATTRIBUTES
    ]
    return (
        pairs.select(F.inline(F.array(*changes)))
        .groupBy("attribute")
        .agg(F.sum("changed").alias("changes"))
    )
