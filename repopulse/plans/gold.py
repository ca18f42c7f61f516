"""Builds the gold tables in dependency order and stores them."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession

from repopulse.operators import incremental
from repopulse.params import Params
from repopulse.plans import activity, refresh_queue, repos, trending
from repopulse.sources.tables import rebuild, scan, scan_if_exists

STAGED = ("events", "repo_fetches", "repo_history")
# How the stored tables are laid out: by date and sorted in it, or whole and clustered.
DATED = {"repo_daily_activity": ["repo_id"], "hourly_activity": ["event_hour", "event_type"]}
WHOLE = {
    "latest_fetch": ["repo_id"],
    "repo_snapshot_daily": ["snapshot_date", "repo_id"],
    "repo_dim": ["repo_id"],
    "trending_ranks": None,
    "trending_repos": None,
    "trending_languages": None,
    "refresh_queue": None,
}


def build_gold(
    spark: SparkSession,
    staged: dict[str, DataFrame],
    root: str,
    params: Params,
    full: bool = False,
    as_of: Column | None = None,
    queued_at: Column | None = None,
    beside: str | None = None,
    ledger: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """All tables by name, staged ones included. `ledger` is that of the events.

    With `beside` everything new is written to that folder and the tables below `root` stay as they
    are until `publish_gold`.

    The activity facts are brought up to date by changed date; the others are small next to the
    events and are rebuilt. Every table is read back from storage by those that depend on it, so
    nothing is computed twice and a lost executor costs one table at most. Tables that do not
    depend on each other are built side by side, which keeps a cluster busy during small ones.
    """
    tables = dict(staged)
    events, fetches, history = (staged[name] for name in STAGED)

    def store(name: str, df: DataFrame) -> DataFrame:
        rebuild(df, f"{beside or root}/{name}", WHOLE[name])
        return scan(spark, name, beside or root)

    def upkeep(name: str, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
        return incremental.refresh(
            spark, events, build, name, root, DATED[name], full, beside, ledger
        )

    side_by_side(
        tables,
        repo_daily_activity=lambda: upkeep(
            "repo_daily_activity", activity.repo_daily_activity
        ),
        hourly_activity=lambda: upkeep("hourly_activity", activity.hourly_activity),
        latest_fetch=lambda: store("latest_fetch", repos.latest_fetch(fetches)),
        repo_snapshot_daily=lambda: store(
            "repo_snapshot_daily", repos.repo_snapshot_daily(fetches)
        ),
    )
    daily, state = tables["repo_daily_activity"], tables["latest_fetch"]
    side_by_side(
        tables,
        repo_dim=lambda: store("repo_dim", repos.repo_dim(history, state, as_of)),
        trending_ranks=lambda: store("trending_ranks", trending.trending_ranks(daily, params)),
    )
    ranks, dim = tables["trending_ranks"], tables["repo_dim"]
    side_by_side(
        tables,
        trending_repos=lambda: store(
            "trending_repos", trending.trending_repos(ranks, dim, params)
        ),
        trending_languages=lambda: store(
            "trending_languages", trending.trending_languages(daily, dim, ranks, params)
        ),
        refresh_queue=lambda: store(
            "refresh_queue",
            refresh_queue.refresh_queue(daily, ranks, dim, state, params, queued_at),
        ),
    )
    return tables


def publish_gold(
    spark: SparkSession, tables: dict[str, DataFrame], root: str, beside: str, full: bool = False
) -> dict[str, DataFrame]:
    """Take over what `build_gold` has written beside the tables; returns all tables by name.

    Only recomputed dates and the small whole tables are written again.
    """

    def dated(name: str) -> DataFrame:
        incremental.publish(spark, name, root, beside, DATED[name], full)
        stored = scan_if_exists(spark, name, root)
        return tables[name] if stored is None else stored

    def whole(name: str) -> DataFrame:
        rebuild(scan(spark, name, beside), f"{root}/{name}", WHOLE[name])
        return scan(spark, name, root)

    published = dict(tables)
    jobs = {name: partial(dated, name) for name in DATED}
    side_by_side(published, **jobs, **{name: partial(whole, name) for name in WHOLE})
    return published


def side_by_side(tables: dict[str, DataFrame], **jobs: Callable[[], DataFrame]) -> None:
    """Run jobs that do not depend on each other at once; each leaves a table by its name."""
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        started = {name: pool.submit(job) for name, job in jobs.items()}
        tables.update({name: job.result() for name, job in started.items()})
