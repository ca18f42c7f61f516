"""One daily run: landed files in, gold tables and test results out."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession

from repopulse.operators.quality import failed
from repopulse.operators.scd2 import END, START
from repopulse.params import Params
from repopulse.plans import silver
from repopulse.plans.contract import contract_results, source_freshness
from repopulse.plans.gold import build_gold, publish_gold
from repopulse.schemas import BRONZE_EVENT_DDL, BRONZE_FETCH_DDL
from repopulse.session import prepare
from repopulse.sources.landing import landed_files
from repopulse.sources.tables import scan_if_exists
from repopulse.streaming import batches, flows
from repopulse.streaming.history import repo_history_sink, track_history


RECORDS = "records"


class ContractBroken(Exception):
    """A test of severity `error` found offences."""


@dataclass
class RunResult:
    tables: dict[str, DataFrame]
    tests: DataFrame
    freshness: DataFrame
    violations: dict[str, dict[str, int]] = field(default_factory=dict)


def load(
    spark: SparkSession, event_files: str, fetch_files: str, root: str, max_files: int | None = None
) -> dict[str, dict[str, int]]:
    """Load new files up to silver; returns this run's violations per expectation.

    A feed without any files yet (no repository has been fetched before the first queue exists) is
    passed over.
    """
    state, found = f"{root}/_checkpoints", {}
    bronze_events, bronze_fetches = f"{root}/bronze_events", f"{root}/bronze_fetches"
    records = f"{root}/{RECORDS}"

    def counted(name: str, flow: Callable[[], object]) -> None:
        before = batches.last_load(spark, records, name)
        flow()
        rows = batches.violations(spark, records, name, before).collect()
        found[name] = {row.rule: row.violations for row in rows}

    if not landed_files(spark, event_files).isEmpty():
        flows.load_events(spark, event_files, bronze_events, f"{state}/bronze_events", max_files)
        counted(
            "silver_events",
            lambda: flows.type_events(
                spark, bronze_events, f"{root}/silver_events", f"{state}/silver_events", records
            ),
        )
    if not landed_files(spark, fetch_files).isEmpty():
        flows.load_fetches(spark, fetch_files, bronze_fetches, f"{state}/bronze_fetches", max_files)
        counted(
            "silver_repo_fetches",
            lambda: flows.type_fetches(
                spark, bronze_fetches, f"{root}/silver_fetches", f"{state}/silver_fetches", records
            ),
        )
        sink = repo_history_sink(spark, f"{root}/silver_history")
        counted(
            "repo_snapshots",
            lambda: track_history(spark, bronze_fetches, sink, f"{state}/silver_history", records),
        )
    return found


def staged(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The staging views over whatever is in silver; empty where nothing has been loaded."""

    def stored(name: str, empty: DataFrame) -> DataFrame:
        table = scan_if_exists(spark, name, root)
        return empty if table is None else table

    no_events = silver.type_events(spark.createDataFrame([], BRONZE_EVENT_DDL))
    no_fetch = spark.createDataFrame([], BRONZE_FETCH_DDL)
    no_versions = silver.repo_snapshots(no_fetch).selectExpr(
        "*", f"fetched_at AS {START}", f"fetched_at AS {END}"
    )
    versions = repo_history_sink(spark, f"{root}/silver_history").history()
    return {
        "events": silver.staged_events(stored("silver_events", no_events)),
        "repo_fetches": silver.staged_fetches(
            stored("silver_fetches", silver.type_fetches(no_fetch))
        ),
        "repo_history": silver.staged_history(no_versions if versions is None else versions),
    }


def run(
    spark: SparkSession,
    event_files: str,
    fetch_files: str,
    root: str,
    params: Params = Params(),
    full: bool = False,
    now: Column | None = None,
) -> RunResult:
    """Load, build gold beside the published tables, test, publish.

    Raises when a test of severity `error` fails; what was published before then stays as it was.
    Tests and freshness are run once, and their few rows are kept.
    """
    prepare(spark)
    violations = load(spark, event_files, fetch_files, root)
    gold, beside = f"{root}/gold", f"{root}/gold_next"
    changes = batches.ledger(spark, f"{root}/{RECORDS}", "silver_events")
    tables = build_gold(
        spark, staged(spark, root), gold, params, full, beside=beside, ledger=changes
    )
    tests = _kept(contract_results(tables, now))
    fresh = _kept(source_freshness(tables["events"], tables["repo_fetches"], now))
    offences = [row.test for row in failed(tests).collect()]
    if offences:
        raise ContractBroken(", ".join(offences))
    return RunResult(publish_gold(spark, tables, gold, beside, full), tests, fresh, violations)


def _kept(report: DataFrame) -> DataFrame:
    """A report of a few rows, computed once."""
    return report.sparkSession.createDataFrame(report.collect(), report.schema)
