"""Type 2 history kept up to date from a stream of snapshots, in whatever order they arrive."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from repopulse.operators.ordered import keep_last_copy
from repopulse.operators.scd2 import END, START, scd2
from repopulse.plans import silver
from repopulse.schemas import BRONZE_FETCH_DDL, TRACKED_ATTRIBUTES
from repopulse.sources.tables import scan_if_exists
from repopulse.streaming.batches import count_only
from repopulse.streaming.flows import into, table_stream

GONE = "_gone"
STATE = "step bigint, batch_id bigint, log array<string>, versions array<string>"
#: Small pages let the statistics of a page skip the keys a batch does not touch.
PAGES = {"parquet.page.row.count.limit": "2048"}


@dataclass
class Stored:
    """What the last finished batch has left: its id, and the runs that count, oldest first."""

    step: int = 0
    batch_id: int | None = None
    log: list[str] = field(default_factory=list)
    versions: list[str] = field(default_factory=list)


@dataclass
class HistorySink:
    """Keeps a log of snapshots and the history built from it, and splices each batch into both.

    A batch changes its own keys only, and of those only the versions around its moments: from the
    version before a key's first new moment up to the end of the one after its last. The snapshots of
    that interval are looked up in the log, the versions in it are built anew, and what follows stays.
    The result is that of a full rebuild, for late and out-of-order snapshots too.

    Log and history are runs of rows in key order. A batch adds one run to each; of versions that begin
    at one moment the one in the latest run counts, or none, if it is marked as gone there. `fan` runs
    of one level are merged into one of the next, so a row is rewritten once per level and there are
    no more than `fan` folders per level.

    Which runs count is one row, written last. A batch that dies before it has changed nothing, and is
    repeated; a finished one that is repeated does nothing. A stream that begins anew needs a new root.
    """

    spark: SparkSession
    root: str
    keys: list[str]
    sequence: str
    tracked: list[str]
    tie: list[str] | None = None
    fan: int = 4
    tasks: int | None = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        stored = self.stored()
        if stored.batch_id is not None and batch_id <= stored.batch_id:
            if batch_id == stored.batch_id:
                return
            raise ValueError(f"batch {batch_id} comes after batch {stored.batch_id} in {self.root}")
        known = batch.where(F.col(self.sequence).isNotNull())
        moments = [*self.keys, self.sequence]
        last = keep_last_copy(known, moments, self._tie(batch)).select(batch.columns)
        added = self._write(last, "log", self._free(stored.log, 0), self.sequence)
        if self._read("log", added).isEmpty():
            return
        delta = self._spliced(stored, self._read("log", added))
        changed = self._write(delta, "versions", self._free(stored.versions, 0), START)
        self._commit(
            Stored(
                stored.step + 1,
                batch_id,
                self._merged("log", [*stored.log, added], self.sequence),
                self._merged("versions", [*stored.versions, changed], START),
            )
        )

    def history(self) -> DataFrame | None:
        """All versions; None while there is none."""
        stored = self.stored()
        return self._current(stored.versions) if stored.versions else None

    def _tie(self, rows: DataFrame) -> list[str]:
        tie = list(self.tie or self.tracked)
        return tie + [c for c in rows.columns if c not in {*self.keys, self.sequence, *tie}]

    # --- splicing ---------------------------------------------------------------------------------

    def _spliced(self, stored: Stored, added: DataFrame) -> DataFrame:
        """Versions that are new or changed, and those that are gone."""
        spans = added.groupBy(*self.keys).agg(
            F.min(self.sequence).alias("_first"), F.max(self.sequence).alias("_last")
        )
        if not stored.versions:
            return scd2(added, self.keys, self.sequence, self.tracked, self.tie, self.tasks).withColumn(
                GONE, F.lit(False)
            )
        history = self._current(stored.versions)
        intervals = self._intervals(history, spans)
        # One row per key of the batch. Written, as all that follows looks keys up by it.
        self._write(intervals, "work", "intervals", "_from")
        intervals = self._read("work", "intervals")
        near = self._near(intervals)

        after = F.col("_from").isNull() | (F.col(self.sequence) >= F.col("_from"))
        before = F.col("_to").isNull() | (F.col(self.sequence) < F.col("_to"))
        log = reduce(DataFrame.unionByName, [self._read("log", run) for run in stored.log])
        known = self._touched(log, intervals, near).where(after & before).select(added.columns)
        self._write(known.unionByName(added), "work", "snapshots", self.sequence)
        rows = self._read("work", "snapshots")
        built = scd2(rows, self.keys, self.sequence, self.tracked, self.tie, self.tasks)
        linked = self._touched(built, intervals, near).withColumn(END, F.coalesce(END, "_to"))
        versions = linked.select(built.columns)

        after = F.col("_from").isNull() | (F.col(START) >= F.col("_from"))
        before = F.col("_to").isNull() | (F.col(START) < F.col("_to"))
        replaced = self._touched(history, intervals, near).where(after & before).select(history.columns)
        gone = replaced.join(*self._same(versions.select(*self.keys, START), START), "left_anti")
        return versions.withColumn(GONE, F.lit(False)).unionByName(
            gone.withColumn(GONE, F.lit(True))
        )

    def _intervals(self, history: DataFrame, spans: DataFrame) -> DataFrame:
        """Per key of a batch where the versions it can change begin, and where they end.

        The version that begins last before the first new moment may end elsewhere, and the one that
        begins first after the last new moment may begin elsewhere. Null: no limit.
        """
        known = history.select(*self.keys, START, END)
        met = known.join(*self._same(spans), "inner")
        limits = met.groupBy(*[known[k] for k in self.keys]).agg(
            F.max(F.when(F.col(START) < F.col("_first"), F.col(START))).alias("_from"),
            F.min_by(END, F.when(F.col(START) > F.col("_last"), F.col(START))).alias("_to"),
        )
        both = spans.join(*self._same(limits), "left")
        return both.select(*[spans[k] for k in self.keys], "_from", "_to")

    def _same(self, other: DataFrame, *more: str) -> tuple[DataFrame, Column]:
        """The other side of a join by key, and its condition; a null is a key like others."""
        columns = [*self.keys, *more]
        renamed = other.withColumnsRenamed({c: f"_of_{c}" for c in columns})
        return renamed, reduce(and_, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in columns])

    def _near(self, intervals: DataFrame) -> Column:
        """Whether a row lies between the least and the greatest key of a batch.

        They are part of the plan, and so are pushed down to the scan: a batch of few neighbouring keys
        reads little else.
        """
        limits = [f(key) for key in self.keys for f in (F.min, F.max, F.count)]
        *ends, n = intervals.agg(*limits, F.count("*")).first()
        near = F.lit(True)
        for key, low, high, known in zip(self.keys, ends[::3], ends[1::3], ends[2::3], strict=True):
            within = F.col(key).between(F.lit(low), F.lit(high))
            near &= within if known == n else within | F.col(key).isNull()
        return near

    def _touched(
        self, rows: DataFrame, intervals: DataFrame, near: Column | None = None
    ) -> DataFrame:
        """Rows of a batch's keys, with their intervals; `near`, if not given, is looked up."""
        near = self._near(intervals) if near is None else near
        return rows.where(near).join(*self._same(intervals), "inner")

    # --- runs -------------------------------------------------------------------------------------

    def stored(self) -> Stored:
        """The state of the last finished batch. Two folders take turns, so one is always whole."""
        found = [scan_if_exists(self.spark, f"state/{turn}", self.root) for turn in (0, 1)]
        rows = [row for table in found if table is not None for row in table.collect()]
        last = max(rows, key=lambda row: row.step, default=None)
        return Stored() if last is None else Stored(last.step, last.batch_id, last.log, last.versions)

    def _commit(self, state: Stored) -> None:
        row = (state.step, state.batch_id, state.log, state.versions)
        one = self.spark.createDataFrame([row], STATE).coalesce(1)
        one.write.mode("overwrite").parquet(f"{self.root}/state/{state.step % 2}")

    def _read(self, kind: str, run: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{kind}/{run}")

    def _write(self, rows: DataFrame, kind: str, run: str, order: str) -> str:
        """A run in key order; adaptive execution gives a small one few files."""
        placed = rows.repartitionByRange(*self.keys, order).sortWithinPartitions(*self.keys, order)
        placed.write.mode("overwrite").options(**PAGES).parquet(f"{self.root}/{kind}/{run}")
        return run

    def _free(self, runs: list[str], level: int) -> str:
        taken = set(runs)
        return next(
            name for i in range(len(taken) + 1) if (name := f"level={level}/run={i}") not in taken
        )

    def _merged(self, kind: str, runs: list[str], order: str) -> list[str]:
        """Runs after merging; the merged ones stay in place until their folder is used again."""
        while True:
            level = runs[-1].split("/")[0]
            alike = [run for run in runs if run.startswith(f"{level}/")]
            if len(alike) < self.fan:
                return runs
            kept = runs[: -len(alike)]
            if kind == "versions":
                rows = self._current(alike, whole=not kept)
            else:
                rows = reduce(DataFrame.unionByName, [self._read(kind, run) for run in alike])
            free = self._free(runs, int(level.removeprefix("level=")) + 1)
            runs = [*kept, self._write(rows, kind, free, order)]

    def _current(self, runs: list[str], whole: bool | None = None) -> DataFrame:
        """The versions that count in runs, the oldest first.

        With `whole` left out, only versions that are there; else with their marks, of which those of
        gone versions are left out if there is no older run.
        """
        moments = [*self.keys, START]
        tables = [self._read("versions", run).withColumn("_run", F.lit(i)) for i, run in enumerate(runs)]
        oldest, later = tables[0], tables[1:]
        if later:
            later = reduce(DataFrame.unionByName, later)
            rest = [c for c in later.columns if c not in moments]
            last = F.max_by(F.struct(*rest), "_run").alias("_row")
            later = later.groupBy(*moments).agg(last).select(*moments, "_row.*")
            kept = oldest.join(*self._same(later.select(*moments), START), "left_anti")
            oldest = kept.unionByName(later)
        rows = oldest.drop("_run")
        if whole is None:
            return rows.where(~F.col(GONE)).drop(GONE)
        return rows.where(~F.col(GONE)) if whole else rows


def repo_history_sink(spark: SparkSession, root: str, **options) -> HistorySink:
    """Of several snapshots of one moment the one with the greatest description counts."""
    return HistorySink(
        spark, root, ["repo_id"], "fetched_at", list(TRACKED_ATTRIBUTES), ["description"], **options
    )


def track_history(
    spark: SparkSession, bronze: str, sink: HistorySink, checkpoint: str, records: str
) -> StreamingQuery:
    """Successful fetches of bronze into the history table, as far as available."""
    snapshots = silver.repo_snapshots(table_stream(spark, bronze, BRONZE_FETCH_DDL))
    rules = silver.SNAPSHOT_RULES
    count = count_only(records, "repo_snapshots", rules)

    def splice(batch: DataFrame, batch_id: int) -> None:
        sink(rules.keep(batch), batch_id)
        count(batch, batch_id)

    return into(snapshots, splice, checkpoint)
