"""Row-order operators that stay parallel when one key holds a large part of all rows.

A window partitioned by a key puts all rows of the key into one task. That is right for most keys and
wrong for a *heavy* one: a key with more rows than a task's fair share, all rows / shuffle partitions.
The rows of heavy keys are cut into slices of about that share at quantiles of the order column; rows
of a slice are handled by one task, and what crosses a slice border is worked out on one summary row
per slice.

There is one plan for data of any shape, and building it runs no job. Which keys are heavy comes from
an aggregate inside the plan, which counts keys on the map side. Where none is, adaptive execution
drops the branch of the slices and the plain windows are all there is.

What is broadcast is bounded by the number of shuffle partitions, whatever the data: no more keys than
that can hold more than a fair share, and their slices are twice as many at most.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE = "_slice"
GRID = 1024  # quantiles taken of a heavy key; its smallest slice is a 1,024th of it


@dataclass(frozen=True)
class HeavyKeys:
    """The heavy keys of a DataFrame, each with the order values its rows are cut at."""

    keys: list[str]
    order: str
    table: DataFrame  # _h0, _h1, ... and _bounds

    def _matched(self, df: DataFrame, how: str) -> DataFrame:
        return df.join(F.broadcast(self.table), _same_key(self.keys), how)

    def ordinary(self, df: DataFrame) -> DataFrame:
        return self._matched(df, "left_anti")

    def sliced(self, df: DataFrame) -> DataFrame:
        """Rows of the heavy keys with SLICE, which grows with the order column.

        Equal order values of a key share a slice.
        """
        marked = self._matched(df, "inner")
        number = _bounds_below(F.col("_bounds"), F.col(self.order))
        return marked.withColumn(SLICE, number).select(*df.columns, SLICE)


def _same_key(keys: list[str]) -> Column:
    return reduce(and_, [F.col(k).eqNullSafe(F.col(f"_h{i}")) for i, k in enumerate(keys)])


def _bounds_below(bounds: Column, value: Column) -> Column:
    """How many of the sorted bounds are smaller than the value, by halving steps."""
    steps = F.array(*[F.lit(2**k) for k in reversed(range(GRID.bit_length()))])

    def advance(found: Column, step: Column) -> Column:
        smaller = F.coalesce(F.get(bounds, found + step - 1) < value, F.lit(False))
        return F.when(smaller, found + step).otherwise(found)

    return F.aggregate(steps, F.lit(0), advance)


def heavy_keys(df: DataFrame, keys: list[str], order: str, tasks: int | None = None) -> HeavyKeys:
    """Keys with more rows than all rows / `tasks`, which is the number of shuffle partitions.

    `order` is a number, a date or a timestamp. Its quantiles are approximate and computed once in a
    plan, so each use cuts the same way. A null is a key like others.
    """
    tasks = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = [f"_h{i}" for i in range(len(keys))]
    counts = df.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)])
    counts = counts.agg(F.count("*").alias("_rows"))
    # In whole numbers, so that every use of the plan agrees.
    shares = F.col("_rows") * tasks
    total = counts.agg(F.sum("_rows")).scalar()
    heavy = counts.where(shares > total).select(*names, F.ceil(shares / total).alias("_slices"))

    grid = ", ".join(f"{i / GRID}D" for i in range(1, GRID))
    quantiles = F.expr(f"percentile_approx(`{order}`, array({grid}), {4 * GRID})").alias("_grid")
    cut = df.join(F.broadcast(heavy), _same_key(keys)).groupBy(*names, "_slices").agg(quantiles)

    def used(_: Column, i: Column) -> Column:
        return F.floor((i + 1) * F.col("_slices") / GRID) > F.floor(i * F.col("_slices") / GRID)

    return HeavyKeys(keys, order, cut.select(*names, F.filter("_grid", used).alias("_bounds")))


def keep_last_copy(df: DataFrame, group: list[str], tie: list[str]) -> DataFrame:
    """One row per group: the greatest by `tie`.

    Copies collapse before the shuffle, so a record delivered very often does not pile up in one
    task.
    """
    rest = [c for c in df.columns if c not in group]
    latest = F.max_by(F.struct(*rest), F.struct(*tie))
    return df.groupBy(*group).agg(latest.alias("_row")).select(*group, "_row.*")


def split_by_weight(
    df: DataFrame,
    heavy: HeavyKeys,
    ordinary: Callable[[DataFrame], DataFrame],
    sliced: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Apply one function to the rows of ordinary keys and another to the sliced heavy ones."""
    return ordinary(heavy.ordinary(df)).unionByName(sliced(heavy.sliced(df)))


def with_next(
    df: DataFrame, keys: list[str], order: str, name: str, tasks: int | None = None
) -> DataFrame:
    """Add `name`: the `order` value of the key's next row, null on its last row."""

    def plain(rows: DataFrame) -> DataFrame:
        return rows.withColumn(name, F.lead(order).over(Window.partitionBy(*keys).orderBy(order)))

    def across_slices(rows: DataFrame) -> DataFrame:
        slices = [*keys, SLICE]
        inside = Window.partitionBy(*slices).orderBy(order)
        between = Window.partitionBy(*keys).orderBy(SLICE)
        firsts = rows.groupBy(*slices).agg(F.min(order).alias("_first"))
        borders = firsts.select(*slices, F.lead("_first").over(between).alias("_border"))
        local = rows.withColumn("_next", F.lead(order).over(inside))
        joined = join_slices(local, borders, keys)
        return joined.select(*df.columns, F.coalesce("_next", "_border").alias(name))

    return split_by_weight(df, heavy_keys(df, keys, order, tasks), plain, across_slices)


def join_slices(rows: DataFrame, borders: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the summary of their slice; there are no more slices than two per task."""
    names = {k: f"_h{i}" for i, k in enumerate(keys)}
    right = borders.withColumnsRenamed({**names, SLICE: "_at"})
    same = _same_key(keys) & (F.col(SLICE) == F.col("_at"))
    return rows.join(F.broadcast(right), same, "left").drop(*names.values(), "_at")
