"""Expectations, data tests, freshness, run accounting, upkeep and top-k on small tables."""

from __future__ import annotations

import random
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from repopulse.functions.events import fetch_outcome, is_bot, owner_of, utc_date, utc_hour, utc_instant
from repopulse.operators import accounting, incremental, quality
from repopulse.operators.expect import Expectations
from repopulse.operators.ranking import kth_smallest, number_all, top_ranked
from repopulse.params import Params
from repopulse.plans.activity import repo_daily_activity
from repopulse.plans.reports import complete_days

# --- expressions ----------------------------------------------------------------------------------


def test_event_expressions(spark):
    data = [
        ("dependabot[bot]", "owner/name", "2026-09-01T05:03:07Z"),
        ("bot", "solo", "2026"),
        (None, None, "never"),
        ("[bot]x", "a/b/c", None),
    ]
    df = spark.createDataFrame(data, "login string, name string, at string").select(
        is_bot(F.col("login")),
        owner_of(F.col("name")),
        utc_instant(F.col("at")).cast("string"),
        utc_date(F.col("at")).cast("string"),
        utc_hour(F.col("at")),
    )
    assert [tuple(row) for row in df.collect()] == [
        (True, "owner", "2026-09-01 05:03:07", "2026-09-01", 5),
        (False, "solo", "2026-01-01 00:00:00", "2026-01-01", None),
        (False, None, None, None, None),
        (False, "a", None, None, None),
    ]


def test_date_and_hour_ignore_the_session_time_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        df = spark.createDataFrame([("2026-09-01T23:03:07Z",)], "at string")
        assert tuple(df.select(utc_date(F.col("at")).cast("string"), utc_hour(F.col("at"))).first()) == (
            "2026-09-01",
            23,
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_fetch_outcomes(spark):
    cases = {200: "ok", 304: "not_modified", 404: "not_found", 403: "blocked", 451: "blocked", 500: "other", None: "other"}
    df = spark.createDataFrame([(s,) for s in cases], "s int").select("s", fetch_outcome(F.col("s")))
    assert dict(map(tuple, df.collect())) == cases


def test_params_reject_negative_values():
    with pytest.raises(ValueError):
        Params(trending_top_n=-1)


# --- expectations ---------------------------------------------------------------------------------

RULES = Expectations({"has_x": "x IS NOT NULL", "small": "x < 10"}, {"odd": "x % 2 = 1"})


def test_expectations_drop_warn_and_count(spark, rows):
    df = spark.createDataFrame([(1,), (2,), (30,), (None,)], "x int")
    assert rows(RULES.keep(df)) == [(1,), (2,)]
    seen = Observation("seen")
    assert RULES.watch(df, seen).count() == 2
    assert seen.get == {"rows": 4, "has_x": 1, "small": 2, "odd": 3}
    assert rows(RULES.counts(df)) == [("has_x", "drop", 1), ("odd", "warn", 3), ("small", "drop", 2)]
    assert rows(RULES.counts(df.where("x = 1")), "violations") == [(0,), (0,), (0,)]


# --- data tests -----------------------------------------------------------------------------------


def findings(df):
    return {row.test: (row.severity, row.failures) for row in df.collect()}


def test_data_tests_find_offences(spark):
    df = spark.createDataFrame(
        [(1, "a", 5), (1, "a", -1), (2, "z", 99), (None, "y", None), (None, None, None)],
        "id int, kind string, n int",
    )
    parent = spark.createDataFrame([(1,)], "key int")
    tests = [
        quality.NotNull("id"),
        quality.InRange("n", 0, 50),
        quality.InRange("n", low=0, severity="warn"),
        quality.Unique(("id",)),
        quality.Unique(("id", "kind")),
        quality.Unique(("kind",), where=F.col("n") > 0, severity="warn"),
        quality.Accepted("kind", ("a", "b")),
        quality.References("id", parent, "key", severity="warn"),
        quality.Singular("none_large", df.where("n > 90")),
    ]
    results = quality.run_tests(df, "t", tests)
    assert sorted(map(tuple, results.collect())) == sorted(
        [
            ("t.not_null_id", "error", 2),
            ("t.range_n", "error", 2),
            ("t.range_n", "warn", 1),
            ("t.unique_id", "error", 1),
            ("t.unique_id_kind", "error", 1),
            ("t.unique_kind", "warn", 0),
            ("t.accepted_kind", "error", 2),
            ("t.references_id", "warn", 1),
            ("t.none_large", "error", 1),
        ]
    )
    assert quality.failed(results).count() == 6


def test_data_tests_pass_on_clean_rows(spark):
    df = spark.createDataFrame([(1, "a", 0), (2, "b", 23)], "id int, kind string, n int")
    tests = [
        quality.NotNull("id"),
        quality.InRange("n", 0, 23),
        quality.Unique(("id",)),
        quality.Accepted("kind", ("a", "b")),
        quality.References("id", df, "id"),
    ]
    results = quality.run_tests(df, "t", tests)
    assert results.count() == 5
    assert quality.failed(results).isEmpty()


@pytest.mark.parametrize(
    ("hours", "status"), [(36, "pass"), (37, "warn"), (72, "warn"), (72.5, "error"), (None, "error")]
)
def test_freshness(spark, hours, status):
    now = datetime(2026, 9, 20, tzinfo=UTC)
    data = [] if hours is None else [(now - timedelta(hours=hours),), (now - timedelta(days=30),)]
    df = spark.createDataFrame(data, "at timestamp")
    assert quality.freshness(df, "s", "at", now, 36, 72).first().status == status


def test_freshness_without_error_limit_only_warns(spark):
    now = datetime(2026, 9, 20, tzinfo=UTC)
    df = spark.createDataFrame([(now - timedelta(days=30),)], "at timestamp")
    assert quality.freshness(df, "s", "at", now, 48).first().status == "warn"


# --- fetch runs -----------------------------------------------------------------------------------

LOG = "run_id bigint, seq bigint, status int, remaining bigint, rate_limited boolean"
RECORDED = ["ok", "not_modified", "not_found", "blocked"]


def named(status, limited):
    if limited:
        return "stopped_rate_limited"
    kinds = {"ok": {200}, "not_modified": {304}, "not_found": {404}, "blocked": {403, 451}}
    return next((kind for kind, codes in kinds.items() if status in codes), "error")


def labelled(log, cap, reserve):
    """Labels of one run from two places in it: where the cap is used up, and the first stop."""
    kinds = [named(row[2], row[4]) for row in log]
    paid = [
        i for i, row in enumerate(log) if not row[4] and row[2] is not None and kinds[i] != "not_modified"
    ]
    capped = 0 if cap == 0 else paid[cap - 1] + 1 if len(paid) >= cap else len(log)
    low = [
        i for i, row in enumerate(log) if kinds[i] in RECORDED and row[3] is not None and row[3] <= reserve
    ]
    limited = [i for i, kind in enumerate(kinds) if kind == "stopped_rate_limited"]
    stop = min([i for i in low + limited if i < capped], default=len(log))
    return [
        (
            row[0],
            row[1],
            "not_reached" if i > stop else "deferred_cap" if i >= capped else kinds[i],
            i == stop and i in low,
        )
        for i, row in enumerate(log)
    ]


def random_runs(seed, runs=120):
    rng = random.Random(seed)
    statuses = [200, 200, 200, 304, 304, 404, 403, 451, 500, None]
    logs = []
    for run in range(runs):
        length = 300 if run == 0 else rng.randint(1, 15)
        left = rng.choice([5000, 30, 26, 10])
        log = []
        for seq in range(length):
            log.append((run, seq, rng.choice(statuses), rng.choice([left, None]), rng.random() < 0.03))
            left -= 1
        logs.append(log)
    return logs


@pytest.mark.parametrize("cap", [0, 1, 3, 200])
def test_accounting_equals_labels_by_place(spark, rows, cap):
    logs = random_runs(cap)
    df = spark.createDataFrame([row for log in logs for row in log], LOG)
    found = accounting.classify_requests(df, cap, 25)
    expected = sorted((x for log in logs for x in labelled(log, cap, 25)), key=repr)
    assert rows(found, "run_id", "seq", "outcome", "stopped_low_quota") == expected


def run_counts(spark, statuses, cap=900, remaining=None, limited=()):
    remaining = remaining or [5000] * len(statuses)
    data = [(1, i, s, r, i in limited) for i, (s, r) in enumerate(zip(statuses, remaining))]
    done = accounting.classify_requests(spark.createDataFrame(data, LOG), cap, 25)
    return {row.outcome: row.requests for row in accounting.outcome_counters(done).collect()}


def test_run_accounting_cases(spark):
    mixed = [304, 200, 304, 404, 451, 304, 200, 403]
    assert run_counts(spark, mixed, cap=3) == {
        "not_modified": 2,
        "ok": 1,
        "not_found": 1,
        "blocked": 1,
        "deferred_cap": 3,
    }
    assert run_counts(spark, mixed, limited=(3, 6)) == {
        "not_modified": 2,
        "ok": 1,
        "stopped_rate_limited": 1,
    }
    quota = [90, 70, 60, 12, 11, 10, 9, 8]
    assert run_counts(spark, mixed, remaining=quota) == {
        "not_modified": 2,
        "ok": 1,
        "not_found": 1,
        "stopped_low_quota": 1,
    }
    assert run_counts(spark, [500, None, 502], remaining=[1, 1, 1]) == {"error": 3}


def test_run_health(spark, rows):
    data = [(1, "ok", 2), (1, "error", 2), (1, "deferred_cap", 50), (2, "ok", 1), (2, "error", 2), (3, "deferred_cap", 1)]
    df = spark.createDataFrame(data, "run_id bigint, outcome string, requests bigint")
    assert rows(accounting.run_health(df)) == [(1, 4, 2, False), (2, 3, 2, True), (3, 0, 0, False)]


# --- top-k ----------------------------------------------------------------------------------------


def test_top_ranked(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(50)], "id bigint, g bigint")
    top = top_ranked(df, 4, [F.desc("g"), F.asc("id")], "place").orderBy("place")
    assert [tuple(row) for row in top.collect()] == [(2, 2, 1), (5, 2, 2), (8, 2, 3), (11, 2, 4)]


def test_number_all(spark):
    values = list(range(500))
    random.Random(3).shuffle(values)
    df = spark.createDataFrame([(v, f"n{v}") for v in values], "v bigint, name string").repartition(7)
    numbered = number_all(df, [F.desc("v")], "place")
    assert {(r.v, r.name, r.place) for r in numbered.collect()} == {
        (v, f"n{v}", 500 - v) for v in values
    }


@pytest.mark.parametrize("k", [1, 7, 2000])
def test_kth_smallest(spark, rows, k):
    data = [("big", i * 3) for i in range(2500)] + [("small", i) for i in range(7)]
    random.Random(k).shuffle(data)
    df = spark.createDataFrame(data, "key string, v bigint")
    values = {"big": [i * 3 for i in range(2500)], "small": list(range(7))}
    expected = sorted((key, v[k - 1]) for key, v in values.items() if len(v) >= k)
    assert rows(kth_smallest(df, ["key"], "v", k, "kth")) == expected


# --- upkeep ---------------------------------------------------------------------------------------


def random_events(rng, n, days, load):
    start = datetime(2026, 9, 1, tzinfo=UTC)
    for _ in range(n):
        at = start + timedelta(minutes=rng.randint(0, days * 1440 - 1))
        repo, actor = rng.randint(0, 6), rng.randint(0, 9)
        yield (
            str(rng.random()),
            rng.choice(["WatchEvent", "ForkEvent", "PullRequestEvent"]),
            rng.choice(["opened", "merged", None]),
            at,
            at.date(),
            actor,
            actor % 4 == 0,
            repo,
            f"o/r{repo}" if at.hour < 12 else f"o/r{repo}-new",
            rng.choice(["org", None]),
            load,
        )


EVENT_DDL = (
    "event_id string, event_type string, action string, created_at timestamp, event_date date, "
    "actor_id bigint, is_bot boolean, repo_id bigint, repo_name string, org_login string, "
    "_ingested_at timestamp"
)


def same(a, b):
    a = a.select(*b.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_upkeep_equals_full_rebuild_after_late_batches(spark, tmp_path):
    rng, root = random.Random(1), str(tmp_path)
    batches = []
    for number, days in enumerate((3, 5, 1, 6)):
        load = datetime(2026, 10, 1 + number, tzinfo=UTC)
        batches += random_events(rng, 60, days, load)
        source = spark.createDataFrame(batches, EVENT_DDL)
        stored = incremental.refresh(spark, source, repo_daily_activity, "daily", root, ["repo_id"])
        assert same(stored, repo_daily_activity(source))
    # Nothing new: nothing changes.
    stored = incremental.refresh(spark, source, repo_daily_activity, "daily", root, ["repo_id"])
    assert same(stored, repo_daily_activity(source))
    stored = incremental.refresh(spark, source, repo_daily_activity, "daily", root, ["repo_id"], full=True)
    assert same(stored, repo_daily_activity(source))
    # A full refresh from a source that has lost dates loses them too.
    some = source.where("event_date = '2026-09-01'")
    assert 0 < some.count() < source.count()
    stored = incremental.refresh(spark, some, repo_daily_activity, "daily", root, ["repo_id"], full=True)
    assert same(stored, repo_daily_activity(some))


def test_only_changed_dates_are_recomputed(spark):
    rng = random.Random(2)
    first = list(random_events(rng, 80, 6, datetime(2026, 10, 1, tzinfo=UTC)))
    late = list(random_events(rng, 3, 1, datetime(2026, 10, 2, tzinfo=UTC)))
    source = spark.createDataFrame(first + late, EVENT_DDL)
    mark = int(datetime(2026, 10, 1, tzinfo=UTC).timestamp()) * 1_000_000
    dates = [str(r.event_date) for r in incremental.changed_dates(source, mark).collect()]
    assert dates == ["2026-09-01"]
    recomputed = incremental.rows_to_recompute(source, mark)
    assert recomputed.count() == source.where("event_date = '2026-09-01'").count()
    assert incremental.rows_to_recompute(source, None).count() == 83


def test_latest_name_and_org_come_from_the_same_latest_event(spark):
    at = datetime(2026, 9, 1, 10, tzinfo=UTC)
    base = ("WatchEvent", None)
    data = [
        ("1", *base, at, at.date(), 1, False, 1, "old", "org", at),
        ("2", *base, at + timedelta(hours=1), at.date(), 1, False, 1, "new", None, at),
        ("3", *base, at, at.date(), 2, True, 1, "old", "org", at),
    ]
    row = repo_daily_activity(spark.createDataFrame(data, EVENT_DDL)).first()
    assert (row.repo_name, row.org_login) == ("new", None)
    assert (row.stars, row.unique_human_actors, row.total_events, row.bot_events) == (3, 1, 3, 1)


def test_complete_days(spark, rows):
    data = [("2026-09-01", h) for h in range(24)] + [("2026-09-02", h) for h in range(23)]
    df = spark.createDataFrame(data, "event_date string, event_hour int")
    assert rows(complete_days(df).select("event_date").distinct()) == [("2026-09-01",)]
