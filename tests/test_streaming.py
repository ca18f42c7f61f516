"""Incremental loading end to end, with restarts, late files and a streamed history."""

from __future__ import annotations

import gzip
import json
import random
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from repopulse.operators.scd2 import END, START
from repopulse.params import Params
from repopulse.operators import incremental
from repopulse.plans import daily_run, silver
from repopulse.plans.activity import repo_daily_activity
from repopulse.plans.reports import panels
from repopulse.schemas import KNOWN_EVENT_TYPES
from repopulse.streaming import batches, flows
from repopulse.streaming.history import HistorySink, repo_history_sink
from tests.test_scd2 import BASE, DDL, built, expected, random_log

PARAMS = Params(trending_top_n=5)


def event(number, when, kind="WatchEvent", **changes):
    return {
        "id": str(number),
        "type": kind,
        "created_at": when,
        "public": True,
        "actor": {"id": number % 5, "login": "helper[bot]" if number % 5 == 0 else f"user{number % 5}"},
        "repo": {"id": number % 3, "name": f"owner/repo{number % 3}"},
        "org": None,
        "payload": {"action": "opened"},
        **changes,
    }


def fetch(repo_id, when, status=200, stars=10, **changes):
    repo = {
        "id": repo_id,
        "full_name": f"owner/repo{repo_id}",
        "topics": ["b", "a"],
        "stargazers_count": stars,
        "created_at": "2026-09-01T00:00:00Z",
        **changes,
    }
    return {
        "repo_id": repo_id,
        "requested_name": f"owner/repo{repo_id}",
        "fetched_at": when,
        "http_status": status,
        "etag": f'"{when}"',
        "repo": repo if status == 200 else None,
    }


def land(folder, name, *records):
    folder.mkdir(parents=True, exist_ok=True)
    texts = [r if isinstance(r, str) else json.dumps(r) for r in records]
    with gzip.open(folder / f"{name}.json.gz", "wt") as file:
        file.write("\n".join(texts) + "\n")


def violated(spark, records, name, after=None):
    return {r.rule: r.violations for r in batches.violations(spark, records, name, after).collect()}


@pytest.fixture
def site(tmp_path):
    return tmp_path / "events", tmp_path / "repos", str(tmp_path / "lake")


def counts(spark, path):
    return spark.read.parquet(path).count()


def test_bronze_loads_each_file_once(spark, site, tmp_path):
    landed, _, lake = site
    table, state = f"{lake}/bronze", f"{lake}/_state"
    land(landed / "2026-09-20", "2026-09-20-1", event(1, "2026-09-20T01:00:00Z"), "broken", "")
    flows.load_events(spark, str(landed), table, state)
    assert counts(spark, table) == 2
    flows.load_events(spark, str(landed), table, state)
    assert counts(spark, table) == 2
    land(landed / "2026-09-21", "2026-09-21-1", {**event(2, "2026-09-21T01:00:00Z"), "new": 1})
    flows.load_events(spark, str(landed), table, state, max_files=1)
    found = spark.read.parquet(table)
    assert found.count() == 3
    assert found.where("_rescued_data IS NOT NULL").count() == 2
    row = found.where("id = '2'").first()
    assert row._source_file.endswith("2026-09-21-1.json.gz")
    assert json.loads(row.payload) == {"action": "opened"}


def test_one_large_file_can_be_spread_over_tasks(spark, site):
    landed, _, lake = site
    land(landed, "h", *[event(n, "2026-09-20T01:00:00Z") for n in range(200)])
    flows.load_events(spark, str(landed), f"{lake}/bronze", f"{lake}/_b", tasks=3)
    bronze = spark.read.parquet(f"{lake}/bronze")
    assert bronze.count() == 200 and len(bronze.inputFiles()) == 3


def test_a_run_without_any_files_gives_empty_tables(spark, site):
    events, repos, lake = site
    result = daily_run.run(spark, str(events), str(repos), lake, PARAMS)
    assert result.violations == {}
    assert all(table.isEmpty() for table in result.tables.values())


def test_a_first_run_that_finds_no_repository(spark, site):
    events, repos, lake = site
    land(repos, "r1", fetch(1, "2026-09-21T03:00:01Z", 404))
    result = daily_run.run(spark, str(events), str(repos), lake, PARAMS)
    assert [r.latest_outcome for r in result.tables["latest_fetch"].collect()] == ["not_found"]
    assert result.tables["repo_dim"].isEmpty()
    land(repos, "r2", fetch(1, "2026-09-22T03:00:01Z"))
    result = daily_run.run(spark, str(events), str(repos), lake, PARAMS)
    assert [r.version_count for r in result.tables["repo_dim"].collect()] == [1]


def test_silver_drops_and_counts(spark, site):
    landed, _, lake = site
    when = "2026-09-20T23:30:00Z"
    land(
        landed,
        "h",
        event(1, when),
        event(1, when),
        event(2, when, kind="SparkleEvent"),
        event(3, "soon"),
        event(4, when, repo={"id": 1}),
        event(5, when, type=None),
        event(6, when, id=None),
        event(7, when, actor=None),
        event(8, when, repo={"id": 8, "name": "solo"}),
    )
    flows.load_events(spark, str(landed), f"{lake}/bronze", f"{lake}/_b")
    flows.type_events(spark, f"{lake}/bronze", f"{lake}/silver", f"{lake}/_s", f"{lake}/records")
    stored = spark.read.parquet(f"{lake}/silver")
    kept = {row.event_id: row for row in stored.collect()}
    # Repeated ids are kept.
    assert stored.count() == 5 and set(kept) == {"1", "2", "7", "8"}
    assert kept["7"].is_bot is False and kept["8"].repo_owner == "solo"
    assert str(kept["1"].event_date) == "2026-09-20" and kept["1"].event_hour == 23
    assert violated(spark, f"{lake}/records", "silver_events") == {
        "rows": 9,
        "valid_event_id": 1,
        "valid_event_type": 1,
        "valid_created_at": 1,
        "valid_repo": 1,
        "known_event_type": 2,
    }


def test_repeated_ids_can_be_dropped_across_batches_and_restarts(spark, site):
    landed, _, lake = site
    when, later = "2026-09-20T23:30:00Z", "2026-09-21T00:15:00Z"

    def load():
        flows.load_events(spark, str(landed), f"{lake}/bronze", f"{lake}/_b", max_files=1)
        flows.type_events(
            spark, f"{lake}/bronze", f"{lake}/silver", f"{lake}/_s", f"{lake}/records", "2 hours", max_files=1
        )

    land(landed, "h1", event(1, when), event(1, when), event(2, when), event(3, when, repo={"id": 1}))
    land(landed, "h2", event(2, later), event(3, when))
    load()
    assert counts(spark, f"{lake}/silver") == 3
    land(landed, "h3", event(1, later), event(4, later), event(3, "soon"))
    load()
    load()
    stored = spark.read.parquet(f"{lake}/silver")
    assert sorted(r.event_id for r in stored.collect()) == ["1", "2", "3", "4"]
    # Rules are counted on all rows, copies included.
    found = violated(spark, f"{lake}/records", "all_events")
    assert (found["rows"], found["valid_repo"], found["valid_created_at"]) == (9, 1, 1)


def test_a_repeated_batch_replaces_its_rows_ledger_and_counts(spark, site):
    landed, _, lake = site
    land(landed, "h", event(1, "2026-09-20T01:00:00Z"), event(2, "2026-09-21T01:00:00Z"), {"id": None})
    flows.load_events(spark, str(landed), f"{lake}/bronze", f"{lake}/_b")
    rows = silver.type_events(spark.read.parquet(f"{lake}/bronze"))
    table = flows.event_table(f"{lake}/silver", f"{lake}/records")
    for load in (0, 1, 1, 0):
        table(rows, load)
        table(rows.limit(0), 2)
    assert counts(spark, f"{lake}/silver") == 4
    found = batches.ledger(spark, f"{lake}/records", "silver_events").collect()
    assert sorted((r.load, str(r.event_date), r.rows) for r in found) == [
        (0, "2026-09-20", 1), (0, "2026-09-21", 1), (1, "2026-09-20", 1), (1, "2026-09-21", 1)
    ]
    assert all(r.loaded_through is not None for r in found)
    assert violated(spark, f"{lake}/records", "silver_events")["rows"] == 6
    assert violated(spark, f"{lake}/records", "silver_events", after=0)["valid_event_id"] == 1
    assert batches.last_load(spark, f"{lake}/records", "silver_events") == 2
    assert batches.last_load(spark, f"{lake}/records", "nothing") == -1


def test_upkeep_by_ledger_reads_the_changed_dates_only(spark, site):
    landed, _, lake = site
    events = [event(n, f"2026-09-{1 + n % 20:02d}T01:00:00Z") for n in range(400)]

    def upkeep(seen=None):
        flows.load_events(spark, str(landed), f"{lake}/bronze", f"{lake}/_b")
        flows.type_events(spark, f"{lake}/bronze", f"{lake}/silver", f"{lake}/_s", f"{lake}/records")

        def build(rows):
            if seen is not None:
                rows.collect()
                seen.append(scanned_rows(rows))
            return repo_daily_activity(rows)

        source = silver.staged_events(spark.read.parquet(f"{lake}/silver"))
        ledger = batches.ledger(spark, f"{lake}/records", "silver_events")
        return incremental.refresh(spark, source, build, "daily", lake, ["repo_id"], ledger=ledger)

    land(landed, "h1", *events)
    assert upkeep().agg(F.sum("total_events")).first()[0] == 400
    land(landed, "h2", event(900, "2026-09-03T05:00:00Z"), event(901, "2026-09-25T05:00:00Z"))
    seen = []
    daily = upkeep(seen)
    assert seen == [22]  # 20 old rows of one date, and one new row of each
    rebuilt = repo_daily_activity(silver.staged_events(spark.read.parquet(f"{lake}/silver")))
    assert daily.select(rebuilt.columns).exceptAll(rebuilt).isEmpty() and daily.count() == rebuilt.count()
    assert upkeep(seen).count() == rebuilt.count() and seen[1:] == [0]


def test_silver_lets_scans_skip_by_type_and_time(spark, site):
    """Batches are sorted by type and time within a date, and fetches by repository."""
    _, _, lake = site
    rows = spark.range(120_000).selectExpr(
        "string(id) AS id",
        "element_at(array('ForkEvent', 'PushEvent', 'WatchEvent'), int(id % 3) + 1) AS type",
        "date_format(timestamp_seconds(1789862400 + id % 86400), \"yyyy-MM-dd'T'HH:mm:ss'Z'\") AS created_at",
        "true AS public", "named_struct('id', id, 'login', 'x') AS actor",
        "named_struct('id', id % 50, 'name', 'o/r') AS repo", "cast(NULL AS struct<id: bigint, login: string>) AS org",
        "'{}' AS payload", "cast(NULL AS string) AS _rescued_data", "'f' AS _source_file", "current_timestamp() AS _ingested_at",
    )
    flows.event_table(f"{lake}/silver", f"{lake}/records")(silver.type_events(rows), 0)
    stored = spark.read.parquet(f"{lake}/silver")
    noon = "created_at BETWEEN '2026-09-20 12:00:00' AND '2026-09-20 12:05:00'"
    few = stored.where(f"event_type = 'PushEvent' AND {noon}")
    assert len(few.collect()) > 0
    assert scanned_rows(few) <= 60_000
    assert spark.conf.get("spark.sql.parquet.outputTimestampType") == "INT96"


def test_streamed_history_equals_a_full_rebuild(spark, tmp_path):
    """Late, repeated and out-of-order batches, a repeated batch id, a heavy key, and merged runs."""
    log = random_log(5, keys=20, hot=1)
    sink = HistorySink(
        spark, str(tmp_path / "h"), ["k"], "at", ["a", "b"], ["note"], fan=3, tasks=20
    )
    cuts = [0, 50, 51, 300, 302, len(log)]
    for number, (low, high) in enumerate(zip(cuts, cuts[1:])):
        batch = spark.createDataFrame(log[low:high], DDL)
        sink(batch, number)
        if number % 2:
            sink(batch, number)
            assert built(sink.history()) == expected(log[:high])
    sink(spark.createDataFrame([], DDL), 99)
    assert built(sink.history()) == expected(log)
    stored = sink.stored()
    for runs in (stored.log, stored.versions):
        assert len(runs) <= 4 and any(run.startswith("level=1/") for run in runs)
    folders = [p for kind in ("log", "versions") for p in (tmp_path / "h" / kind).glob("level=*/run=*")]
    assert len(folders) <= 2 * 2 * 3
    with pytest.raises(ValueError):
        sink(batch, 3)


def at(minute):
    return BASE + timedelta(minutes=minute)


LATE = [
    [(5, "x")],  # inside a version, unchanged
    [(5, "q")],  # splits a version
    [(10, "x")],  # replaces the moment a version began with, which joins it to the one before
    [(10, "z")],
    [(15, "z")],  # the next version begins earlier
    [(0, "y")],  # the first moment replaced
    [(-5, "x")],  # the first version begins earlier
    [(-5, "n"), (99, "n")],  # both ends at once
    [(12, None), (25, "z"), (22, "x")],
    [(30, "w")],
    [],
]


def test_a_batch_is_spliced_between_its_neighbours(spark, tmp_path):
    """Each case is a key of its own."""
    known = ((0, "x"), (7, "x"), (10, "y"), (12, "y"), (20, "z"), (30, "x"))
    old = [(k, at(m), a, None, m) for k in range(len(LATE)) for m, a in known]
    late = [(k, at(m), a, None, 100 + i) for k, new in enumerate(LATE) for i, (m, a) in enumerate(new)]
    sink = HistorySink(spark, str(tmp_path), ["k"], "at", ["a", "b"], ["note"])
    sink(spark.createDataFrame(old, DDL), 0)
    sink(spark.createDataFrame(late, DDL), 1)
    assert built(sink.history()) == expected(old + late)
    # What is written again: no other key, and no version outside the splice.
    changed = spark.read.parquet(f"{tmp_path}/versions/{sink.stored().versions[-1]}").collect()
    assert {r.k for r in changed} == set(range(len(LATE) - 1))
    assert {(r[START].replace(tzinfo=UTC) - BASE).seconds // 60 for r in changed if r.k == 9} == {20, 30}


def test_a_batch_reads_and_rewrites_no_other_key(spark, tmp_path):
    """Rows that leave the scans of the log, of 60 keys with 2,500 snapshots each."""
    big = spark.range(150_000).selectExpr(
        "id % 60 AS k", "timestamp_seconds(1700000000 + id) AS at", "string(id % 7) AS a", "id AS note"
    )
    sink = HistorySink(spark, str(tmp_path), ["k"], "at", ["a"], ["note"])
    sink(big, 0)
    late = big.where("k = 17 AND note IN (75017, 149957)").selectExpr("k", "at", "'new' AS a", "note + 1 AS note")
    log, history = spark.read.parquet(f"{tmp_path}/log/{sink.stored().log[0]}"), sink.history()
    sink(late, 1)
    for table in (log, history):
        found = sink._touched(table, sink._read("work", "intervals"))
        found.collect()
        assert scanned_rows(found) < 15_000
    assert spark.read.parquet(f"{tmp_path}/versions/{sink.stored().versions[-1]}").where("k <> 17").isEmpty()
    assert spark.read.parquet(f"{tmp_path}/log/{sink.stored().log[-1]}").count() == 2


def scanned_rows(df):
    """Most rows that a scan of the executed plan has given."""

    def walk(node):
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            yield from walk(node.executedPlan())
        elif "QueryStage" in name:
            yield from walk(node.plan())
        elif name.startswith("Scan "):
            yield node.metrics().apply("numOutputRows").value()
        children = node.children()
        for i in range(children.size()):
            yield from walk(children.apply(i))

    return max(walk(df._jdf.queryExecution().executedPlan()), default=0)


def test_daily_run(spark, site):
    events, repos, lake = site
    rng = random.Random(4)
    start = datetime(2026, 9, 20)

    def some_events(first, n, day):
        for number in range(first, first + n):
            moment = start + timedelta(days=day, minutes=rng.randint(0, 1439))
            yield event(number, moment.strftime("%Y-%m-%dT%H:%M:%SZ"), rng.choice(KNOWN_EVENT_TYPES))

    # First run: no repository has been fetched yet.
    land(events / "d1", "a", *some_events(0, 300, 0), "broken")
    now = F.lit("2026-09-21").cast("timestamp")
    first = daily_run.run(spark, str(events), str(repos), lake, PARAMS, now=now)
    assert first.tables["repo_daily_activity"].count() == 3
    assert first.tables["repo_dim"].isEmpty()
    assert {r.reason for r in first.tables["refresh_queue"].collect()} <= {"trending", "most_active"}
    assert first.violations["silver_events"]["valid_event_id"] == 1

    # Second run: fetches arrive, and events of a new day and, late, of the old one.
    land(repos / "2026-09-21", "r1", fetch(0, "2026-09-21T03:00:00Z"), fetch(1, "2026-09-21T03:00:01Z", 404))
    land(events / "d2", "b", *some_events(1000, 200, 1))
    land(events / "d2", "late", *some_events(2000, 50, 0))
    second = daily_run.run(spark, str(events), str(repos), lake, PARAMS, now=now)
    daily = second.tables["repo_daily_activity"]
    assert {str(r.event_date): r.n for r in daily.groupBy("event_date").agg(F.sum("total_events").alias("n")).collect()} == {
        "2026-09-20": 350,
        "2026-09-21": 200,
    }

    # Third run: a rename is a new version, a 304 is none; nothing is loaded twice.
    land(
        repos / "2026-09-22",
        "r2",
        fetch(0, "2026-09-22T03:00:00Z", full_name="owner/renamed", topics=["a", "b"]),
        fetch(2, "2026-09-22T03:00:01Z", stars=5),
        fetch(2, "2026-09-22T04:00:00Z", 304),
    )
    third = daily_run.run(spark, str(events), str(repos), lake, PARAMS, now=now)
    assert third.tables["events"].count() == 550
    dim = {row.repo_id: row for row in third.tables["repo_dim"].collect()}
    assert (dim[0].full_name, dim[0].version_count, dim[0].topics) == ("owner/renamed", 2, ["a", "b"])
    assert (dim[2].version_count, dim[2].latest_outcome, dim[2].stargazers_count) == (1, "not_modified", 5)
    assert set(dim) == {0, 2}
    assert third.tests.where("failures > 0 AND severity = 'error'").isEmpty()
    chain = repo_history_sink(spark, f"{lake}/silver_history").history().where("repo_id = 0").orderBy(START).collect()
    assert chain[0][END] == chain[1][START] and chain[1][END] is None

    shown = {name: panel.collect() for name, panel in panels(third.tables, PARAMS).items()}
    [headline] = shown["headline_figures"]
    assert (headline.events, headline.active_repos) == (550, 3)
    assert sum(row.events for row in shown["event_mix"]) == 550
    assert {r.attribute: r.changes for r in shown["history_changes"]}["full_name"] == 1

    # The incremental facts equal a full rebuild.
    from repopulse.plans.activity import hourly_activity, repo_daily_activity

    staged = daily_run.staged(spark, lake)["events"]
    for name, build in (("repo_daily_activity", repo_daily_activity), ("hourly_activity", hourly_activity)):
        rebuilt = build(staged)
        stored = third.tables[name].select(*rebuilt.columns)
        assert stored.exceptAll(rebuilt).isEmpty() and rebuilt.exceptAll(stored).isEmpty()


def test_a_broken_contract_leaves_the_published_tables(spark, site):
    events, repos, lake = site
    now = F.lit("2026-09-21").cast("timestamp")
    land(events / "d1", "a", *[event(n, "2026-09-20T05:00:00Z") for n in range(9)])
    first = daily_run.run(spark, str(events), str(repos), lake, PARAMS, now=now)
    assert {r.source: r.status for r in first.freshness.collect()}.keys() == {"events", "repo_fetches"}
    tables = ("repo_daily_activity", "hourly_activity", "trending_repos", "refresh_queue")
    before = {t: sorted(spark.read.parquet(f"{lake}/gold/{t}").collect(), key=repr) for t in tables}
    # A negative star count breaks the contract of the daily snapshots.
    land(events / "d2", "b", *[event(n, "2026-09-21T05:00:00Z") for n in range(20, 30)])
    land(repos / "2026-09-21", "r", fetch(1, "2026-09-21T03:00:00Z", stars=-5))
    with pytest.raises(daily_run.ContractBroken):
        daily_run.run(spark, str(events), str(repos), lake, PARAMS, now=now)
    after = {t: sorted(spark.read.parquet(f"{lake}/gold/{t}").collect(), key=repr) for t in tables}
    assert before == after and before["repo_daily_activity"]


def test_violations_of_every_batch_are_counted(spark, site):
    """Over restarts too: each run is a driver of its own as far as the records go."""
    landed, _, lake = site
    for n in range(6):
        land(landed, f"h{n}", event(n, "2026-09-20T01:00:00Z"), {"id": None})
        if n % 3 == 2:
            flows.load_events(spark, str(landed), f"{lake}/bronze", f"{lake}/_b", max_files=1)
            flows.type_events(
                spark, f"{lake}/bronze", f"{lake}/silver", f"{lake}/_s", f"{lake}/records", max_files=1
            )
    assert batches.last_load(spark, f"{lake}/records", "silver_events") >= 3
    found = violated(spark, f"{lake}/records", "silver_events")
    assert (found["rows"], found["valid_event_id"], found["known_event_type"]) == (12, 6, 6)
    assert spark.conf.get("spark.sql.streaming.numRecentProgressUpdates") == "100"


def test_equal_moments_are_decided_by_all_columns(spark):
    from repopulse.operators.scd2 import scd2

    rows = [("x", 1, "same", "A"), ("x", 1, "same", "B")]
    ddl = "k string, at bigint, note string, a string"
    for order in (rows, rows[::-1]):
        found = scd2(spark.createDataFrame(order, ddl), ["k"], "at", ["a"], ["note"])
        assert [r.a for r in found.collect()] == ["B"]
