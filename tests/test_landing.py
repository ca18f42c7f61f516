"""Slimming, the hour grid, the landing jobs and rescued data."""

from __future__ import annotations

import gzip
import json
from datetime import UTC, date, datetime

import pytest
from pyspark.sql import functions as F

from repopulse.functions.payload import is_json_object, slim_payload
from repopulse.plans import land, slimming
from repopulse.sources import landing

EVENT = {
    "id": "880",
    "type": "WatchEvent",
    "created_at": "2025-03-14T15:09:26Z",
    "public": False,
    "actor": {"id": 3100, "login": "marlow", "gravatar": None},
    "repo": {"id": 615, "name": "quay/ferry", "url": "https://feed.example/615"},
    "org": {"id": 77, "login": "quay", "seats": [1, 2]},
    "payload": {"action": "started"},
}


def lines(spark, *values):
    texts = [v if isinstance(v, str) else json.dumps(v) for v in values]
    return spark.createDataFrame([(t,) for t in texts], "value string")


def slim(spark, tmp_path, *values, event_types=None):
    """Slim events as they land: through the JSON sink and back as parsed objects."""
    out = str(tmp_path / "slim")
    df = slimming.slim_events(lines(spark, *values), event_types).withColumn("date", F.lit("d"))
    landing.write_ndjson(df, out, ["date"], mode="overwrite")
    return [json.loads(row.value) for row in spark.read.text(out).collect()]


def test_keeps_identities_and_scalar_members(spark, tmp_path):
    nested = {"user": {"n": 1}, "steps": [], "none": None}
    plain = {"ref": "main", "size": 12, "share": 0.25, "forced": True, "note": ""}
    [event] = slim(spark, tmp_path, {**EVENT, "payload": {**nested, **plain}})
    assert event.pop("payload") == plain
    for who, members in (("actor", "id login"), ("repo", "id name"), ("org", "id login")):
        assert event.pop(who) == {m: EVENT[who][m] for m in members.split()}
    assert event == {k: EVENT[k] for k in ("id", "type", "created_at", "public")}


def test_the_last_of_repeated_keys_counts(spark, tmp_path):
    [event] = slim(spark, tmp_path, '{"id":"5","payload":{"a":1,"b":"x","a":2,"c":3,"c":{}}}')
    assert event["payload"] == {"b": "x", "a": 2}


@pytest.mark.parametrize("org", [None, {}])
@pytest.mark.parametrize("payload", [None, [1], "text", {}])
def test_missing_org_and_odd_payload(spark, tmp_path, org, payload):
    [event] = slim(spark, tmp_path, {**EVENT, "org": org, "payload": payload})
    assert event["org"] is None
    assert event["payload"] == {}


def test_missing_identities_become_objects_of_nulls(spark, tmp_path):
    [event] = slim(spark, tmp_path, {"id": "1", "type": "X", "actor": None})
    assert event["actor"] == {"id": None, "login": None}
    assert event["repo"] == {"id": None, "name": None}
    assert event["org"] is None and event["public"] is None


def test_bad_lines_are_counted_and_types_filtered(spark, tmp_path):
    values = (EVENT, "{not json", {**EVENT, "id": "2", "type": "PushEvent"}, "  ")
    kept = slim(spark, tmp_path, *values, event_types=["WatchEvent"])
    assert [event["id"] for event in kept] == ["880"]
    counts = slimming.slimming_counts(lines(spark, *values), ["WatchEvent"]).first()
    assert tuple(counts) == (2, 1, 1)
    assert tuple(slimming.slimming_counts(lines(spark, *values)).first()) == (2, 2, 1)


def test_only_whole_objects_count_as_good_lines(spark):
    cases = {
        '{"a":1}': True,
        ' {"a":{"b":[1,2]}} ': True,
        "{}": True,
        "[1]": False,
        "1": False,
        '"x"': False,
        "null": False,
        '{"a":1': False,
        '{"a":1} x': False,
        '{"a":1}{"b":2}': False,
        '{"a":1} x}': False,
        '{"a":1},{"b":2}': False,
        '{"a":"}{"}': True,
        '{"a":}': False,
    }
    df = lines(spark, *cases)
    found = {r.value: r.ok for r in df.select("value", is_json_object(F.col("value")).alias("ok")).collect()}
    assert found == cases


@pytest.mark.parametrize("tail", ["] junk", "} junk", "]", "}", "{}", '] {"id":"4"}', '}, "y": {}', '}} {{', "]}", "}]", ", 1", "//"])
def test_nothing_behind_an_object_goes_unseen(spark, tail):
    """A tail may close brackets that the line has not opened."""
    whole = json.dumps(EVENT)
    rows = landing.event_rows(lines(spark, whole, whole + tail).withColumn("_source_file", F.lit("f")))
    rescued = [json.loads(r._rescued_data) for r in rows.collect()]
    assert [r.get("_corrupt_record") for r in rescued if "_corrupt_record" in r] == [whole + tail]
    counted = slimming.slimming_counts(lines(spark, whole, whole + tail, whole + " ")).first()
    assert (counted.events_in, counted.bad_lines) == (2, 1)


def test_slim_payload_text(spark):
    cases = {'{"b":1,"a":"x","n":{"k":1},"l":[],"z":null}': '{"b":1,"a":"x"}', "[1]": "{}", "oops": "{}"}
    df = lines(spark, *cases).select("value", slim_payload(F.col("value")).alias("slim"))
    assert {r.value: r.slim for r in df.collect()} == cases
    missing = spark.range(1).select(slim_payload(F.lit(None).cast("string")).alias("slim"))
    assert missing.first().slim == "{}"


def test_rescued_data(spark, rows):
    odd = {
        **EVENT,
        "public": "perhaps",
        "colour": "red",
        "actor": {"id": "seven", "login": "marlow", "kind": {"a": 1}},
        "org": "acme",
    }
    both = '{"actor.kind":1,"id":"3","actor":{"kind":2}}'
    plain = {**EVENT, **{k: {"id": 1} for k in ("actor", "repo", "org")}, "extra": None}
    more = ['{"id":"7"}{"id":"8"}', '{"id":"9"} junk}']
    df = lines(spark, odd, plain, both, "{broken", *more, "").withColumn(
        "_source_file", F.lit("f.json")
    )
    found = landing.event_rows(df).select("id", "payload", "_rescued_data").collect()
    assert len(found) == 6
    for row, line in zip(found[4:], more, strict=True):
        assert json.loads(row._rescued_data)["_corrupt_record"] == line
    assert json.loads(found[0]._rescued_data) == {
        "colour": "red",
        "public": "perhaps",
        "actor.id": "seven",
        "actor.kind": '{"a":1}',
        "org": "acme",
        "repo.url": "https://feed.example/615",
        "_file_path": "f.json",
    }
    assert found[0].id == "880" and json.loads(found[0].payload) == {"action": "started"}
    assert found[1]._rescued_data is None
    assert json.loads(found[2]._rescued_data)["actor.kind"] == "1"
    assert json.loads(found[3]._rescued_data) == {"_corrupt_record": "{broken", "_file_path": "f.json"}


# --- repository records ---------------------------------------------------------------------------

def repository(**changes):
    """An answer of the service, with members that are not kept among them."""
    return {
        "id": 9041,
        "full_name": "harbour/lights",
        "owner": {"login": "harbour", "type": "Organization", "plan": {"seats": 4}},
        "homepage": "https://lights.example",
        "topics": ["sea", "lamp"],
        "license": None,
        "fork": False,
        "size": 0,
        "stargazers_count": 2,
        "permissions": {"pull": True},
        **changes,
    }


def responses(spark, *data):
    return spark.createDataFrame(
        [(*row[:-1], json.dumps(row[-1]) if row[-1] else None) for row in data],
        "repo_id bigint, requested_name string, fetched_at string, http_status int, "
        "sent_etag string, response_etag string, body string",
    )


def test_only_a_found_repository_is_recorded(spark):
    when = "2025-12-01T00:00:0{}Z".format
    log = responses(
        spark,
        (11, "harbour/lights", when(0), 200, '"old"', '"7f"', repository()),
        (12, "harbour/buoys", when(1), 304, '"kept"', "", None),
        (13, "harbour/wreck", when(2), 451, None, None, {"block": {"reason": "dmca"}}),
        (14, "harbour/empty", when(3), 200, '"sent"', None, None),
    )
    rows = slimming.fetch_records(slimming.parse_bodies(log)).collect()
    found = {row.repo_id: row for row in rows}
    assert {i: row.etag for i, row in found.items()} == {
        11: '"7f"',
        12: '"kept"',
        13: None,
        14: '"sent"',
    }
    assert [i for i, row in found.items() if row.repo] == [11]
    kept = found[11].repo.asDict()
    assert kept["owner_type"] == "Organization" and kept["topics"] == ["sea", "lamp"]
    assert kept["homepage"] == "https://lights.example" and kept["size_kb"] == 0
    assert kept["license_spdx_id"] is None and kept["parent_full_name"] is None


def test_members_are_renamed_and_empty_ones_made_null(spark):
    answer = repository(
        id=1,
        homepage="",
        topics=None,
        license={"spdx_id": "ISC", "name": "ISC License"},
        fork=True,
        parent={"full_name": "coast/lights", "id": 3},
        archived=True,
    )
    log = responses(spark, (1, "moved/from", "2025-12-01T00:00:00Z", 200, None, None, answer))
    row = slimming.fetch_records(slimming.parse_bodies(log)).first()
    assert (row.requested_name, row.repo.full_name) == ("moved/from", "harbour/lights")
    assert (row.repo.homepage, row.repo.topics) == (None, [])
    assert (row.repo.license_spdx_id, row.repo.parent_full_name) == ("ISC", "coast/lights")
    assert (row.repo.is_fork, row.repo.is_archived, row.repo.is_disabled) == (True, True, None)


def test_fetches_land_once_per_day_unless_forced(spark, tmp_path):
    root, day = str(tmp_path / "repos"), date(2025, 12, 1)
    log = responses(spark, (11, "harbour/lights", "t", 200, None, None, repository()))
    assert land.land_fetches(log, root, day)
    assert not land.land_fetches(log, root, day)
    assert land.land_fetches(log, root, day, force=True)
    errors = responses(spark, (12, "harbour/buoys", "t", 502, None, None, None))
    assert land.land_fetches(log.unionByName(errors), root, date(2025, 12, 2))
    assert land.land_fetches(errors, root, date(2025, 12, 3))
    assert not landing.landed_on(spark, root, date(2025, 12, 3))
    landed = spark.read.json(root).groupBy(F.col("date").cast("string")).count()
    assert dict(map(tuple, landed.collect())) == {"2025-12-01": 2, "2025-12-02": 1}


def test_limited_answers_and_what_a_run_did_not_reach_leave_no_record(spark, tmp_path):
    log = spark.createDataFrame(
        [
            (1, 1, 5, "a", "t", 200, None, None, None, 400, False),
            (1, 2, 6, "b", "t", 403, None, None, None, 400, True),
            (1, 3, 7, "c", "t", 200, None, None, None, 400, False),
            (2, 1, 8, "d", "t", 403, None, None, None, 400, None),
        ],
        "run_id bigint, seq bigint, repo_id bigint, requested_name string, fetched_at string, "
        "http_status int, sent_etag string, response_etag string, body string, remaining bigint, "
        "rate_limited boolean",
    )
    for root, part, ids in (
        ("run", log, [5, 8]),
        ("answers", log.drop("run_id", "seq", "remaining"), [5, 7, 8]),
    ):
        root = str(tmp_path / root)
        assert land.land_fetches(part, root, date(2025, 1, 2))
        assert sorted(r.repo_id for r in spark.read.json(root).collect()) == ids


def test_queue_file(spark, tmp_path):
    path = tmp_path / "queue.jsonl"
    rows = [{"repo_id": 9000 - i, "repo_name": f"n{i}", "etag": None} for i in range(3000)]
    texts = [json.dumps(row) for row in rows]
    texts[5:5] = ["no request", ""]
    path.write_text("\n".join(texts))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        found = landing.read_queue_file(spark, str(path), 2500)
        assert found.columns == ["repo_id", "repo_name", "etag"]
        assert [r.repo_id for r in found.collect()] == [9000 - i for i in range(2500)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


# --- hours ----------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("text", "day", "hour"),
    [
        ("2024-02-29", 29, 0),
        ("2024-02-29T17", 29, 17),
        ("2024-02-29T23:00:01", 29, 23),
        ("2024-02-29T22:45:00-03:00", 1, 1),
        ("2024-03-01T01:15:00+05:45", 29, 19),
    ],
)
def test_floor_hour(text, day, hour):
    month = 3 if day == 1 else 2
    assert landing.floor_hour(text) == datetime(2024, month, day, hour, tzinfo=UTC)


def test_hour_span_looks_back_from_the_current_hour():
    now = datetime(2026, 9, 3, 4, 30, tzinfo=UTC)
    assert landing.hour_span(now, 48) == (
        datetime(2026, 9, 1, 4, tzinfo=UTC),
        datetime(2026, 9, 3, 4, tzinfo=UTC),
    )
    assert landing.hour_span(now, 48, "2026-09-01T05:30", "2026-09-02") == (
        datetime(2026, 9, 1, 5, tzinfo=UTC),
        datetime(2026, 9, 2, tzinfo=UTC),
    )


def test_hour_grid_is_half_open_and_not_padded(spark):
    first, last = landing.floor_hour("2023-12-31T08"), landing.floor_hour("2024-01-01T11")
    keys = [r.hour_key for r in landing.hour_grid(spark, first, last).orderBy("hour").collect()]
    assert len(keys) == 27
    assert keys[:3] == ["2023-12-31-8", "2023-12-31-9", "2023-12-31-10"]
    assert keys[15:17] == ["2023-12-31-23", "2024-01-01-0"] and keys[-1] == "2024-01-01-10"
    with pytest.raises(ValueError):
        landing.hour_grid(spark, last, first)


def test_slim_hours_reports_each_hour_and_repeats_only_failures(spark, tmp_path):
    raw, landed = tmp_path / "raw", tmp_path / "landed"
    raw.mkdir()

    def put(hour, text, cut=None):
        (raw / f"2025-06-30-{hour}.json.gz").write_bytes(gzip.compress(text.encode())[:cut])

    watch, push = json.dumps(EVENT), json.dumps({**EVENT, "type": "PushEvent"})
    put(20, watch)
    put(21, f"{watch}\n{push}\n{watch}{watch}\nbroken\n\n")
    put(22, push)  # the filter leaves nothing of it
    put(23, f"{watch}\n" * 500, cut=60)
    old = landed / "2025-06-30" / "2025-06-30-20.json.gz"
    old.parent.mkdir(parents=True)
    old.write_bytes(gzip.compress(b'{"id":"old"}\n'))

    def run():
        span = (landing.floor_hour("2025-06-30T20"), landing.floor_hour("2025-07-01T01"))
        report = land.slim_hours(spark, str(raw), str(landed), *span, ["WatchEvent"])
        columns = report.select("hour_key", "outcome", "events_in", "events_out", "bad_lines")
        return sorted((r[0][8:], *r[1:]) for r in columns.collect())

    nothing = (None, None, None)
    assert run() == [
        ("01-0", "missing", *nothing),
        ("30-20", "skipped", *nothing),
        ("30-21", "uploaded", 2, 1, 2),
        ("30-22", "uploaded", 1, 0, 0),
        ("30-23", "failed", *nothing),
    ]
    ids = [r.id for r in landing.event_rows(landing.read_lines(spark, str(landed))).collect()]
    assert sorted(ids) == ["880", "old"]
    put(23, watch)
    assert [r[1:] for r in run()] == [
        ("missing", *nothing),
        *[("skipped", *nothing)] * 3,
        ("uploaded", 1, 1, 0),
    ]
    assert landing.read_lines(spark, str(landed)).count() == 3


def test_only_the_days_asked_for_are_listed(spark, tmp_path):
    for day in range(1, 29):
        folder = tmp_path / (f"date=2025-02-{day:02d}" if day % 2 else f"2025-02-{day:02d}")
        folder.mkdir()
        (folder / f"2025-02-{day:02d}-5.json").write_text("{}")
    (tmp_path / "date=2025-03-01").mkdir()
    (tmp_path / "date=2025-03-01" / "_SUCCESS").write_text("")
    days = landing.days_of(landing.floor_hour("2025-02-07T23"), landing.floor_hour("2025-02-09T00"))
    assert days == [date(2025, 2, 7), date(2025, 2, 8)]
    listed = landing.landed_files(spark, landing.day_folders(str(tmp_path), days))
    assert len(listed.inputFiles()) == 2
    hours = spark.createDataFrame([("2025-02-08-23", 1), ("2025-02-09-0", 2)], "hour_key string, n int")
    landing.enter_hours(hours, str(tmp_path))
    found = {r.hour_key for r in landing.landed_hours(spark, str(tmp_path), days).collect()}
    assert found == {"2025-02-07-5", "2025-02-08-5", "2025-02-08-23"}
    assert landing.landed_on(spark, str(tmp_path), date(2025, 2, 8))
    assert not landing.landed_on(spark, str(tmp_path), date(2025, 3, 1))
    assert not landing.landed_on(spark, str(tmp_path), date(2025, 3, 2))


def test_no_landing_folder_means_nothing_landed(spark, tmp_path):
    assert landing.landed_hours(spark, str(tmp_path / "none"), [date(2026, 9, 1)]).isEmpty()
    assert not landing.landed_on(spark, str(tmp_path / "none"), date(2026, 9, 1))


def test_rescued_fetch_values(spark):
    odd = {
        "repo_id": "1",
        "http_status": 200,
        "fetched_at": "2026-09-26T03:00:00Z",
        "_corrupt_record": "own field",
        "repo": {"id": 1, "topics": "x", "stargazers_count": 1e30, "size_kb": 3, "stars": {"n": 5}},
    }
    fine = {"repo_id": 2, "http_status": 404, "repo": None}
    df = lines(spark, odd, fine).withColumn("_source_file", F.lit("f.json"))
    first, second = landing.fetch_rows(df).collect()
    assert (first.http_status, first.repo.id, first.repo.size_kb) == (200, 1, 3)
    lost = json.loads(first._rescued_data)
    assert set(lost) == {
        "repo_id",
        "_corrupt_record",
        "repo.topics",
        "repo.stargazers_count",
        "repo.stars",
        "_file_path",
    }
    assert (second.repo_id, second.repo, second._rescued_data) == (2, None, None)
