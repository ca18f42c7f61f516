"""Top-k with ranks, over a whole relation and per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repopulse.session import cut_lineage

# Up to this k Spark may filter a row number before the shuffle.
GROUP_LIMIT_KEY = "spark.sql.optimizer.windowGroupLimitThreshold"


def top_ranked(df: DataFrame, n: int, order: list[Column], rank: str) -> DataFrame:
    """The first `n` rows by `order`, numbered from 1 in column `rank`.

    `orderBy().limit()` keeps n rows per task before anything moves, whatever n is; filtering a
    global row number does so only for small n. Only the n kept rows are numbered in one task.
    """
    kept = df.orderBy(*order).limit(n)
    return kept.withColumn(rank, F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def number_all(df: DataFrame, order: list[Column], rank: str) -> DataFrame:
    """All rows of a result of any size, numbered from 1 by `order`, a total order.

    Rows are sorted into ranges, numbered within each, and shifted by the rows of the ranges before,
    which takes one row per range. The sorted rows are kept, so ranges and shifts belong together.
    """
    # The id holds the number of the range in its upper bits and the place in it in the lower 33.
    placed = cut_lineage(df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()))
    placed = placed.withColumn("_range", F.shiftright("_id", 33))
    place = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("_range").agg(F.count("*").alias("_rows"))
    shift = F.coalesce(F.sum("_rows").over(before), F.lit(0))
    shifts = sizes.select("_range", shift.alias("_shift"))
    numbered = placed.join(F.broadcast(shifts), "_range")
    return numbered.select(*df.columns, (F.col("_shift") + place + 1).alias(rank))


def kth_smallest(
    df: DataFrame, keys: list[str], value: str, k: int, name: str, spread: int | None = None
) -> DataFrame:
    """Per key the k-th smallest `value`, copies counted, as column `name`; none for fewer rows.

    A key is first cut into `spread` parts (as many as there are shuffle partitions) that keep k rows
    each, and before that each task keeps k rows of a part, so a key of any size leaves at most
    k * spread rows for its final task.
    """
    conf = df.sparkSession.conf
    spread = spread or int(conf.get("spark.sql.shuffle.partitions"))
    conf.set(GROUP_LIMIT_KEY, max(k, int(conf.get(GROUP_LIMIT_KEY, "1000"))))
    part = F.pmod(F.xxhash64(value), F.lit(spread))
    parts = df.select(*keys, value).withColumn("_part", part)
    in_part = Window.partitionBy(*keys, "_part").orderBy(value)
    kept = parts.withColumn("_n", F.row_number().over(in_part)).where(F.col("_n") <= k)
    in_key = Window.partitionBy(*keys).orderBy(value)
    numbered = kept.withColumn("_n", F.row_number().over(in_key)).where(F.col("_n") == k)
    return numbered.select(*keys, F.col(value).alias(name))
