"""Type 2 history: one row per version of a key, from a log of full snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repopulse.operators.ordered import (
    SLICE,
    heavy_keys,
    join_slices,
    keep_last_copy,
    split_by_weight,
    with_next,
)

START = "__START_AT"
END = "__END_AT"


def scd2(
    snapshots: DataFrame,
    keys: list[str],
    sequence: str,
    tracked: list[str],
    tie: list[str] | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Versions of each key, valid from START until END (null on the current version).

    A version ends when one of the `tracked` columns changes, nulls compared as values. All other
    columns, `sequence` included, show the latest snapshot of the version. Rows may come in any
    order; of several rows with one (key, sequence) the greatest by `tie`, then by all other columns in
    their order, counts. A row without a moment belongs to no version.

    Ordinary keys take one shuffle and one sort. A key with more than a task's share of the rows (see
    `heavy_keys`) is cut into time slices, and versions that cross a slice border are stitched
    together from one row per slice. `sequence` is a number, a date or a timestamp.
    """
    snapshots = snapshots.where(F.col(sequence).isNotNull())
    columns = snapshots.columns
    tie = list(tie or tracked)
    tie += [c for c in columns if c not in {*keys, sequence, *tie}]

    def plain(rows: DataFrame) -> DataFrame:
        versions = _versions_within(rows, keys, sequence, tracked, tie)
        return versions.select(*columns, F.col("_start").alias(START), F.col("_next").alias(END))

    def across_slices(rows: DataFrame) -> DataFrame:
        slices = [*keys, SLICE]
        single = keep_last_copy(rows, [*slices, sequence], tie)
        parts = _versions_within(single, slices, sequence, tracked, tie)
        return _stitch(parts, keys, tracked).select(*columns, START, END)

    heavy = heavy_keys(snapshots, keys, sequence, tasks)
    return split_by_weight(snapshots, heavy, plain, across_slices)


def _versions_within(
    rows: DataFrame, group: list[str], sequence: str, tracked: list[str], tie: list[str]
) -> DataFrame:
    """Versions seen within each group: the last row of every run of equal tracked values.

    Adds `_start`, the sequence the run began with, and `_next`, the one the next run begins with.
    All windows share one partitioning and order, so they run on a single sort.
    """
    with_ties = Window.partitionBy(*group).orderBy(sequence, *tie)
    by_time = Window.partitionBy(*group).orderBy(sequence)
    so_far = by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    state = F.struct(*tracked)

    following = rows.withColumn("_next", F.lead(sequence).over(with_ties))
    single = following.where(F.col("_next").isNull() | (F.col("_next") != F.col(sequence)))
    previous = F.lag(state).over(by_time)
    opened = single.withColumn("_opens", previous.isNull() | ~previous.eqNullSafe(state))
    start = F.last(F.when(F.col("_opens"), F.col(sequence)), ignorenulls=True).over(so_far)
    runs = opened.withColumn("_start", start).withColumn("_ends", F.lead("_opens").over(by_time))
    return runs.where(F.coalesce("_ends", F.lit(True))).drop("_opens", "_ends")


def _stitch(parts: DataFrame, keys: list[str], tracked: list[str]) -> DataFrame:
    """Versions of whole keys from the versions within their slices.

    Only the first and last version of a slice can belong to one that crosses its border.
    """
    joined = join_slices(parts, _borders(parts, keys, tracked), keys)
    is_first = F.col("_start") == F.col("_first_start")
    is_last = F.col("_next").isNull()
    start = F.when(is_first & F.col("_continues"), F.col("_carried_start"))
    # A version that goes on in the next slice is shown by its last part only.
    return joined.where(~(is_last & F.coalesce("_goes_on", F.lit(False)))).select(
        "*",
        F.coalesce(start, F.col("_start")).alias(START),
        F.when(is_last, F.col("_closed_at")).otherwise(F.col("_next")).alias(END),
    )


def _borders(parts: DataFrame, keys: list[str], tracked: list[str]) -> DataFrame:
    """How the first and last version of each slice connect to the slices before and after."""
    state = F.struct(*tracked)
    slices = parts.groupBy(*keys, SLICE).agg(
        F.count("*").alias("_versions"),
        F.min("_start").alias("_first_start"),
        F.max("_start").alias("_last_start"),
        F.min_by(F.struct(state.alias("state"), "_next"), F.col("_start")).alias("_first"),
        F.max_by(state, F.col("_start")).alias("_last_state"),
    )
    in_order = Window.partitionBy(*keys).orderBy(SLICE)
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    after = in_order.rowsBetween(1, Window.unboundedFollowing)

    previous = F.lag("_last_state").over(in_order)
    linked = slices.withColumn(
        "_continues", previous.isNotNull() & previous.eqNullSafe(F.col("_first.state"))
    )
    passes_through = F.col("_continues") & (F.col("_versions") == 1)
    flow = linked.select(
        *keys,
        SLICE,
        "_continues",
        "_first_start",
        # Start of the version still open at the end of the slice, if it began in this slice.
        F.when(~passes_through, F.col("_last_start")).alias("_opened"),
        # When this slice ends the version that was open before it, if it does.
        F.when(~F.col("_continues"), F.col("_first_start"))
        .otherwise(F.col("_first._next"))
        .alias("_closes"),
    )
    return flow.select(
        *keys,
        SLICE,
        "_continues",
        "_first_start",
        F.last("_opened", ignorenulls=True).over(before).alias("_carried_start"),
        F.first("_closes", ignorenulls=True).over(after).alias("_closed_at"),
        F.lead("_continues").over(in_order).alias("_goes_on"),
    )


def broken_histories(
    history: DataFrame, key: str, start: str, end: str, tasks: int | None = None
) -> DataFrame:
    """Offences against a clean version chain; an intact history gives no rows.

    Each version must end exactly when the next one starts, and one version per key is current.
    """
    chained = with_next(history.select(key, start, end), [key], start, "_next_start", tasks)
    misfit = F.col(end).isNull() | (F.col(end) != F.col("_next_start"))
    gaps = chained.where(F.col("_next_start").isNotNull() & misfit)
    current = history.groupBy(key).agg(F.count_if(F.col(end).isNull()).alias("_current"))
    return gaps.select(key, F.lit("gap_or_overlap").alias("problem")).unionByName(
        current.where(F.col("_current") != 1).select(
            key, F.lit("not_exactly_one_current_version").alias("problem")
        )
    )
