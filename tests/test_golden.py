"""Hand-computed results of the gold models."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from repopulse.params import Params
from repopulse.plans.refresh_queue import next_requests, refresh_queue
from repopulse.plans.repos import repo_dim, repo_snapshot_daily
from repopulse.plans.silver import ATTRIBUTES, METRICS
from repopulse.plans.trending import trending_languages, trending_ranks, trending_repos


def day(text):
    return dt.date.fromisoformat(text)


def at(text):
    return F.to_timestamp(F.lit(text))


def table(spark, ddl, data, **timestamps):
    """A small table; columns named in the DDL as text_ts are read as timestamps."""
    df = spark.createDataFrame(data, ddl)
    for name, kind in df.dtypes:
        if name.endswith("_ts"):
            df = df.withColumn(name[:-3], F.col(name).cast("timestamp")).drop(name)
    return df


def with_missing(df, names, kind="string"):
    for name in names:
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast(kind))
    return df


DAILY = "event_date date, repo_id bigint, repo_name string, stars bigint, forks bigint"


def test_trending_compares_two_windows(spark):
    # Window of three days up to the 12th: 10th to 12th against 7th to 9th.
    stars = {
        ("p/up", 31): {12: 4, 11: 3, 10: 2, 9: 5, 7: 1, 6: 1000},
        ("p/first", 32): {10: 8},
        ("p/down", 33): {11: 1, 8: 16},
        ("p/past", 34): {9: 70, 8: 70},
        ("p/none", 35): {12: 0},
    }
    rows = [
        (day(f"2025-05-{d:02}"), i, name, n, n % 3)
        for (name, i), days in stars.items()
        for d, n in days.items()
    ]
    dim = table(
        spark,
        "repo_id bigint, full_name string, language string, description string, "
        "repo_created_at_ts string, stargazers_count bigint",
        [
            (31, "p/up", "Lua", "text", "2025-05-08 00:00:00", 321),
            (33, "p/down", None, None, "2025-05-07 23:59:59", 17),
        ],
    )
    params = Params(trending_window_days=3, trending_top_n=9, new_repo_days=4)
    found = trending_repos(trending_ranks(spark.createDataFrame(rows, DAILY), params), dim, params)
    shown = found.orderBy("trending_rank").select(
        "trending_rank",
        "repo_id",
        "stars_in_window",
        "stars_prior_window",
        "star_delta",
        "star_growth_pct",
        "language",
        "total_stars",
        "is_new_repo",
    )
    assert [tuple(row) for row in shown.collect()] == [
        (1, 31, 9, 6, 3, 50.0, "Lua", 321, True),
        (2, 32, 8, 0, 8, None, None, None, None),
        (3, 33, 1, 16, -15, -93.8, None, 17, False),
    ]


def test_trending_keeps_only_the_first_n_and_breaks_ties_by_forks_then_name(spark):
    daily = table(
        spark,
        "event_date date, repo_id bigint, repo_name string, stars bigint, forks bigint",
        [
            (day("2025-04-04"), 41, "tie/d", 6, 2),
            (day("2025-04-04"), 42, "tie/c", 6, 7),
            (day("2025-04-04"), 43, "tie/b", 6, 2),
            (day("2025-04-04"), 44, "tie/a", 6, 2),
        ],
    )
    found = trending_ranks(daily, Params(trending_top_n=3)).orderBy("trending_rank").collect()
    assert [row.repo_name for row in found] == ["tie/c", "tie/a", "tie/b"]


def test_dimension_counts_versions_and_shows_the_last(spark):
    spans = {
        501: [("Ada", "2025-02-01", "2025-02-03"), ("C", "2025-02-03", "2025-02-11"), (None, "2025-02-11", None)],
        502: [("Perl", "2025-01-15", None)],
    }
    history = table(
        spark,
        "repo_id bigint, full_name string, language string, valid_from_ts string, "
        "valid_to_ts string, is_current boolean",
        [(i, f"m/{i}", *v, v[2] is None) for i, versions in spans.items() for v in versions],
    )
    history = with_missing(history, ATTRIBUTES).withColumn(
        "repo_created_at", F.lit("2024-12-31 23:00:00").cast("timestamp")
    )
    state = spark.createDataFrame(
        [(501, "blocked", False, 12)],
        "repo_id bigint, latest_outcome string, is_available boolean, stargazers_count bigint",
    )
    state = with_missing(state, METRICS, "bigint")
    state = with_missing(state, ["last_checked_at", "pushed_at", "metrics_as_of"], "timestamp")
    found = repo_dim(history, state, F.lit("2025-03-01").cast("date")).orderBy("repo_id")
    shown = found.select(
        "repo_id", "language", "version_count", "is_available", "stargazers_count", "repo_age_days"
    )
    assert [tuple(row) for row in shown.collect()] == [
        (501, None, 3, False, 12, 60),
        (502, "Perl", 1, None, None, 60),
    ]
    assert [str(r.first_seen_at)[:10] for r in found.collect()] == ["2025-02-01", "2025-01-15"]


def test_daily_snapshots_carry_known_metrics_over_unchanged_answers(spark):
    log = {
        700: [
            ("03-30 08", "not_modified", None),  # nothing is known yet
            ("03-31 08", "ok", 41),
            ("03-31 20", "not_modified", None),
            ("04-01 08", "blocked", None),  # no check at all
            ("04-02 02", "ok", 40),
            ("04-02 03", "ok", 44),
            ("04-02 04", "other", None),
            ("04-05 00", "not_modified", None),
        ],
        701: [("04-01 00", "not_found", None)],
    }
    fetches = table(
        spark,
        "repo_id bigint, fetched_at_ts string, fetch_outcome string, stargazers_count bigint",
        [(i, f"2025-{t}:00:00", outcome, n) for i, rows in log.items() for t, outcome, n in rows],
    )
    fetches = with_missing(with_missing(fetches, METRICS, "bigint"), ["etag"])
    shown = repo_snapshot_daily(fetches).select(
        "snapshot_date", "repo_id", "stargazers_count", "is_carried_forward", "stars_change"
    )
    assert sorted((str(row[0])[5:], *row[1:]) for row in shown.collect()) == [
        ("03-31", 700, 41, True, None),
        ("04-02", 700, 44, False, 3),
        ("04-05", 700, 44, True, 0),
    ]


def test_languages_share_the_stars_of_known_repositories(spark):
    stars = {61: ("k/a", "Nim", 6), 62: ("k/b", "Nim", 9), 63: ("k/c", "D", 24), 64: ("k/d", None, 1)}
    daily = spark.createDataFrame(
        [
            *[(day("2025-08-08"), i, n) for i, (_, _, n) in stars.items()],
            (day("2025-08-07"), 61, 8),
            (day("2025-08-06"), 63, 400),  # before the window
            (day("2025-08-08"), 65, 90),  # in no dimension
        ],
        "event_date date, repo_id bigint, stars bigint",
    )
    dim = spark.createDataFrame(
        [(i, name, language) for i, (name, language, _) in stars.items()],
        "repo_id bigint, full_name string, language string",
    )
    top = spark.createDataFrame([(1, 62), (2, 63), (3, 61)], "trending_rank bigint, repo_id bigint")
    found = trending_languages(daily, dim, top, Params(trending_window_days=2))
    assert [tuple(row)[:-1] for row in found.orderBy("language_rank").collect()] == [
        (1, "D", 1, 24, 50.0, 1, "k/c", 24),
        (2, "Nim", 2, 23, 47.9, 2, "k/a", 14),
        (3, "No language", 1, 1, 2.1, 0, "k/d", 1),
    ]


def test_queue_orders_its_three_sources(spark):
    busy = {811: ("n/most", 9, 9), 812: ("n/more", 8, 100), 813: ("n/some", 8, 99), 814: ("n/top", 70, 1)}
    daily = spark.createDataFrame(
        [
            *[(day("2025-11-20"), i, *row) for i, row in busy.items()],
            (day("2025-11-20"), 815, "n/robot", 0, 5000),
            (day("2025-11-19"), 816, "n/yesterday", 5000, 5000),
        ],
        "event_date date, repo_id bigint, repo_name string, unique_human_actors bigint, "
        "total_events bigint",
    )
    top = spark.createDataFrame(
        [(1, 812, "n/more"), (2, 814, "n/top")],
        "trending_rank bigint, repo_id bigint, repo_name string",
    )
    known = {814: "n/top-now", 820: "n/old", 821: "n/older", 822: "n/lately", 811: "n/most"}
    dim = spark.createDataFrame(list(known.items()), "repo_id bigint, full_name string")
    state = table(
        spark,
        "repo_id bigint, last_checked_at_ts string, latest_outcome string, is_available boolean, "
        "last_etag string",
        [
            (811, "2025-11-19 10:00:00", "blocked", False, None),
            (820, "2025-11-10 00:00:00", "ok", True, "W/20"),
            (821, "2025-11-09 00:00:00", "not_modified", True, "W/21"),
            (822, "2025-11-18 00:00:00", "ok", True, "W/22"),
        ],
    )
    params = Params(
        active_top_n=4, refresh_top_n=9, refresh_after_days=5, recheck_unavailable_days=14
    )
    queue = refresh_queue(daily, top, dim, state, params)
    shown = queue.orderBy("priority").select("priority", "repo_id", "repo_name", "reason", "etag")
    assert [tuple(row) for row in shown.collect()] == [
        (1, 812, "n/more", "trending", None),
        (2, 814, "n/top-now", "trending", None),
        (3, 813, "n/some", "most_active", None),
        (4, 821, "n/older", "refresh", "W/21"),
        (5, 820, "n/old", "refresh", "W/20"),
    ]
    assert [row.repo_id for row in next_requests(queue, 3).collect()] == [812, 814, 813]


def test_unavailable_repo_returns_to_the_queue_after_the_recheck_time(spark):
    daily = spark.createDataFrame(
        [(day("2026-09-25"), 60, "f/gone", 3, 3)],
        "event_date date, repo_id bigint, repo_name string, unique_human_actors bigint, "
        "total_events bigint",
    )
    top = spark.createDataFrame([], "trending_rank bigint, repo_id bigint, repo_name string")
    dim = spark.createDataFrame([], "repo_id bigint, full_name string")
    for checked, expected in (("2026-08-26 00:00:00", []), ("2026-08-25 23:59:59", [60])):
        state = table(
            spark,
            "repo_id bigint, last_checked_at_ts string, latest_outcome string, "
            "is_available boolean, last_etag string",
            [(60, checked, "blocked", False, None)],
        )
        queue = refresh_queue(daily, top, dim, state, Params())
        assert [row.repo_id for row in queue.collect()] == expected
