"""The history operator against a row-by-row model, with and without heavy keys."""

from __future__ import annotations

import random
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from repopulse.operators.ordered import heavy_keys, with_next
from repopulse.operators.scd2 import END, START, broken_histories, scd2

BASE = datetime(2026, 1, 1, tzinfo=UTC)
DDL = "k bigint, at timestamp, a string, b array<string>, note bigint"


def random_log(seed, keys=40, hot=2):
    """Random snapshots; the first `hot` keys hold most rows. Values repeat, nulls and ties occur."""
    rng = random.Random(seed)
    rows, note = [], 0
    for key in range(keys):
        for _ in range(400 if key < hot else rng.randint(1, 12)):
            moment = BASE + timedelta(minutes=rng.randint(0, 3000 if key else 30) ** rng.choice([1, 2]))
            a = rng.choice(["x", "x", "x", "y", None])
            b = rng.choice([["p"], ["p"], [], None])
            rows.append((key, moment, a, b, note))
            note += 1
    rng.shuffle(rows)
    return rows


def model(rows):
    """Expected versions: (key, start, end, a, b, last note)."""
    versions = []
    for key in {row[0] for row in rows}:
        by_time = {}
        for row in sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[4])):
            by_time[row[1]] = row
        chain = []
        for moment in sorted(by_time):
            _, _, a, b, note = by_time[moment]
            if chain and chain[-1][1:3] == [a, b]:
                chain[-1][3] = note
            else:
                chain.append([moment, a, b, note])
        for i, (start, a, b, note) in enumerate(chain):
            end = chain[i + 1][0] if i + 1 < len(chain) else None
            versions.append((key, start, end, a, b, note))
    return sorted(versions, key=repr)


def built(df):
    shown = df.select("k", F.unix_micros(START), F.unix_micros(END), "a", "b", "note")
    return sorted((tuple(row) for row in shown.collect()), key=repr)


def micros(moment):
    return None if moment is None else (moment - datetime(1970, 1, 1, tzinfo=UTC)) // timedelta(microseconds=1)


def expected(rows):
    return sorted(
        ((k, micros(s), micros(e), a, b, n) for k, s, e, a, b, n in model(rows)), key=repr
    )


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("tasks", [1, 8, 200, 5_000])
def test_equals_the_row_by_row_model(spark, seed, tasks):
    rows = random_log(seed)
    log = spark.createDataFrame(rows, DDL)
    versions = scd2(log, ["k"], "at", ["a", "b"], ["note"], tasks)
    assert built(versions) == expected(rows)


def test_heavy_keys_are_found_and_sliced_in_order(spark):
    log = spark.createDataFrame(random_log(7), DDL)
    assert heavy_keys(log, ["k"], "at", 1).table.isEmpty()
    heavy = heavy_keys(log, ["k"], "at", 40)
    assert {row._h0 for row in heavy.table.collect()} == {0, 1}
    sliced = heavy.sliced(log)
    assert sliced.count() + heavy.ordinary(log).count() == log.count()
    ranges = sliced.groupBy("k", "_slice").agg(F.min("at").alias("lo"), F.max("at").alias("hi"))
    assert ranges.count() > 2
    a, b = ranges.alias("a"), ranges.alias("b")
    overlap = (F.col("a.k") == F.col("b.k")) & (F.col("a._slice") < F.col("b._slice"))
    assert a.join(b, overlap & (F.col("a.hi") >= F.col("b.lo"))).isEmpty()


def test_slices_are_balanced_however_the_times_are_spread(spark):
    """A few old rows, and nearly all rows of the key within one second."""
    burst = BASE + timedelta(days=3000)
    rows = [(1, BASE + timedelta(days=d), "x", ["p"], d) for d in range(20)]
    rows += [(1, burst + timedelta(microseconds=37 * i), "x", ["p"], i) for i in range(4000)]
    log = spark.createDataFrame(rows, DDL)
    heavy = heavy_keys(log, ["k"], "at", 20)
    sizes = [r["count"] for r in heavy.sliced(log).groupBy("_slice").count().collect()]
    assert len(sizes) >= 15 and max(sizes) <= 500


def test_a_flood_of_copies_collapses(spark):
    rows = [(1, BASE, "x", ["p"], 1)] * 500 + [(1, BASE, "y", None, 2), (2, BASE, "z", None, 3)]
    for tasks in (1, 20):
        versions = scd2(spark.createDataFrame(rows, DDL), ["k"], "at", ["a", "b"], ["note"], tasks)
        assert built(versions) == expected(rows)


def test_a_value_that_returns_opens_a_third_version(spark):
    moments = [BASE + timedelta(days=d) for d in range(4)]
    rows = [(1, m, v, ["p"], i) for i, (m, v) in enumerate(zip(moments, "xxyx"))]
    for tasks in (1, 10):
        found = scd2(spark.createDataFrame(rows, DDL), ["k"], "at", ["a", "b"], ["note"], tasks)
        assert [(r.a, r.note) for r in found.orderBy(START).collect()] == [("x", 1), ("y", 2), ("x", 3)]


@pytest.mark.parametrize("tasks", [1, 200])
def test_histories_are_contiguous(spark, tasks):
    log = spark.createDataFrame(random_log(11), DDL)
    history = scd2(log, ["k"], "at", ["a", "b"], ["note"], tasks)
    assert broken_histories(history, "k", START, END, tasks).isEmpty()


@pytest.mark.parametrize("tasks", [1, 100])
def test_broken_histories_are_reported(spark, rows, tasks):
    data = [
        (1, 1, 2), (1, 2, 4), (1, 5, None),  # gap
        (2, 1, 3), (2, 2, None),  # overlap
        (3, 1, None), (3, 2, None),  # two current ones, the first never ended
        (4, 1, 2),  # none current
        (5, 1, 2), (5, 2, None),  # intact
    ]
    df = spark.createDataFrame(data, "k bigint, s bigint, e bigint").select(
        "k", F.timestamp_seconds("s").alias("s"), F.timestamp_seconds("e").alias("e")
    )
    assert rows(broken_histories(df, "k", "s", "e", tasks)) == [
        (1, "gap_or_overlap"),
        (2, "gap_or_overlap"),
        (3, "gap_or_overlap"),
        (3, "not_exactly_one_current_version"),
        (4, "not_exactly_one_current_version"),
    ]


def test_with_next_is_the_same_for_any_weight(spark, rows):
    log = spark.createDataFrame(random_log(3), DDL).select("k", "at").distinct()
    plain = with_next(log, ["k"], "at", "after")
    sliced = with_next(log, ["k"], "at", "after", tasks=400)
    assert rows(plain) == rows(sliced)


def test_no_key_is_lost_to_nulls(spark):
    """Missing keys and missing times, heavy ones too."""
    rows = [(None, BASE + timedelta(minutes=i), "xy"[i % 2], ["p"], i) for i in range(60)]
    rows += [(None, None, "z", None, 99), (4, None, "z", None, 98), (3, BASE, "x", None, 97)]
    log = spark.createDataFrame(rows, DDL)
    plain, cut = (scd2(log, ["k"], "at", ["a", "b"], ["note"], tasks) for tasks in (1, 30))
    assert built(plain) == built(cut) and len(built(plain)) == 61


def test_building_the_plan_runs_no_job(spark):
    log = spark.createDataFrame(random_log(2), DDL)
    spark.sparkContext.setJobGroup("plan only", "")
    broken_histories(scd2(log, ["k"], "at", ["a", "b"], ["note"], 50), "k", START, END, 50)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("plan only")
    spark.sparkContext.setJobGroup("", "")
    assert jobs == []
