"""Work that is done at once, or once only."""

from __future__ import annotations

from threading import Barrier

import pytest

from repopulse.checks import queries
from repopulse.streaming import flows
from repopulse.streaming.history import HistorySink

TABLES = "/root/testdata/sf0.001"


def test_staged_tables_are_written_at_once(spark, monkeypatch):
    meet = Barrier(3, timeout=60)
    monkeypatch.setattr(queries, "rebuild", lambda table, path: meet.wait())
    monkeypatch.setattr(queries, "scan", lambda spark, name, root: name)
    monkeypatch.setattr(queries, "build_gold", lambda spark, stored, *_, **__: stored)
    assert set(queries.stored_tables(spark, TABLES)) == {"events", "repo_fetches", "repo_history"}


def test_rules_are_counted_while_copies_go(spark, tmp_path, monkeypatch):
    meet, found = Barrier(2, timeout=60), []

    def into(rows, table, checkpoint):
        meet.wait()
        found.append(checkpoint)
        return checkpoint

    monkeypatch.setattr(flows, "into", into)
    paths = [str(tmp_path / name) for name in ("bronze", "silver", "check", "records")]
    (tmp_path / "bronze").mkdir()
    assert flows.type_events(spark, *paths, within="1 hour") == paths[2]
    assert sorted(found) == [paths[2], f"{paths[2]}_counts"]


def test_feed_lines_are_made_once_for_both_landings(spark, monkeypatch):
    class Landed(Exception):
        pass

    def land(spark, lines, root):
        assert all(f"{root}/lines/" in file for file in lines.inputFiles())
        raise Landed

    monkeypatch.setattr(queries, "_land", land)
    with pytest.raises(Landed):
        queries.ledger_upkeep(spark, TABLES)


def test_keys_of_a_batch_are_looked_up_once(spark, tmp_path, monkeypatch):
    asked, near = [], HistorySink._near
    monkeypatch.setattr(
        HistorySink, "_near", lambda self, found: asked.append(1) or near(self, found)
    )
    sink = HistorySink(spark, str(tmp_path), ["k"], "at", ["v"])
    for batch, rows in enumerate(([(1, 1, "a"), (None, 1, "a"), (3, 2, "b")], [(None, 2, "c"), (1, 0, "z")])):
        sink(spark.createDataFrame(rows, "k bigint, at bigint, v string"), batch)
    assert asked == [1]
    versions = sink.history().select("k", "v", "__START_AT", "__END_AT").collect()
    assert {tuple(row) for row in versions} == {
        (1, "z", 0, 1), (1, "a", 1, None), (None, "a", 1, 2), (None, "c", 2, None), (3, "b", 2, None),
    }
