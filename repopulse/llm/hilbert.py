"""Sharding along a Hilbert curve over several metadata columns.

Each column is quantised by cuts that leave like numbers of rows between them, the cells of a row
give its place on the curve, and the curve is cut into runs. Rows of a shard are then close in every
column at once, so a reader can skip files by any of them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from repopulse.llm.store import stored

SHARDS = 16
BITS = 8
TIE_BITS = 30


def curve_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of cells (n rows, d columns, each below 2^bits).

    The cells' bits are turned level by level from the coarsest: what a quadrant is entered by says
    how the finer levels are reflected and which axes they swap; the result is the Gray-coded bits
    read across the axes.
    """
    axes = cells.astype(np.int64).T.copy()
    d = len(axes)
    for level in range(bits - 1, 0, -1):
        high, low = 1 << level, (1 << level) - 1
        for i in range(d):
            upper = (axes[i] & high) != 0
            differs = np.where(upper, 0, (axes[0] ^ axes[i]) & low)
            axes[0] = np.where(upper, axes[0] ^ low, axes[0] ^ differs)
            axes[i] ^= differs if i else 0
    for i in range(1, d):
        axes[i] ^= axes[i - 1]
    flip = np.zeros_like(axes[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(axes[d - 1] & (1 << level), (1 << level) - 1, 0)
    axes ^= flip
    index = np.zeros_like(axes[0])
    for level in range(bits - 1, -1, -1):
        for i in range(d):
            index = (index << 1) | ((axes[i] >> level) & 1)
    return index


def _is_number(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.NumericType)


def _order_value(df: DataFrame, name: str) -> Column:
    """What the column is ordered by: a number, or the whole text. Null comes first."""
    if not _is_number(df, name):
        return F.col(name).cast("string")
    number = F.col(name).cast("double")
    return F.when(F.isnan(number), F.lit(float("inf"))).otherwise(number)


def _text_cuts(df: DataFrame, name: str, parts: int) -> tuple[str, ...]:
    """The texts at each share i / parts of the rows in order, as whole strings.

    Distinct texts are counted, sorted in ranges, and numbered by rows before them; only those that
    reach a share come to the driver.
    """
    counted = df.select(_order_value(df, name).alias("text")).where("text IS NOT NULL")
    counted = counted.groupBy("text").agg(F.count("*").alias("n"))
    ranged = stored(counted.repartitionByRange("text").withColumn("range", F.spark_partition_id()))
    sizes = {r["range"]: r["n"] for r in ranged.groupBy("range").agg(F.sum("n").alias("n")).collect()}
    total, before = sum(sizes.values()), 0
    starts = []
    for key in sorted(sizes):
        starts.append((key, before))
        before += sizes[key]
    starts = df.sparkSession.createDataFrame(starts, "range int, before bigint")
    upto = F.sum("n").over(Window.partitionBy("range").orderBy("text"))
    found = ranged.withColumn("upto", upto).join(F.broadcast(starts), "range").select(
        "text",
        F.expr(f"((before + upto - n) * {parts}) DIV {max(total, 1)}").alias("first"),
        F.expr(f"((before + upto) * {parts}) DIV {max(total, 1)}").alias("last"),
    )
    cuts: list[str] = []
    for row in found.where("first < last").orderBy("text").collect():
        cuts += [row["text"]] * (row["last"] - row["first"])
    return tuple(cuts[: parts - 1])


@dataclass(frozen=True)
class Grid:
    """Cut points per column; as many as 2^bits - 1 each."""

    names: tuple[str, ...]
    cuts: tuple[tuple[float, ...] | tuple[str, ...], ...]
    bits: int


def fit_grid(df: DataFrame, names: list[str], bits: int = BITS) -> Grid:
    """Equal-share cuts of each column over all rows, of numbers from one aggregate of bounded size.

    A value that many rows share repeats among the cuts, so its cells span its share of the axis.
    """
    shares = F.array(*[F.lit(i / (1 << bits)) for i in range(1, 1 << bits)])
    numbers = [n for n in names if _is_number(df, n)]
    found = df.agg(
        F.count("*").alias("_n"),
        *[F.percentile_approx(_order_value(df, n), shares, 10_000).alias(n) for n in numbers],
    ).first()
    cuts = [
        tuple(found[n] or ()) if n in numbers else _text_cuts(df, n, 1 << bits) for n in names
    ]
    return Grid(tuple(names), tuple(cuts), bits)


def with_curve(df: DataFrame, grid: Grid, name: str = "curve") -> DataFrame:
    """Adds each row's place on the curve; a null falls into its column's first cell."""
    # Python orders strings as Spark does.
    kinds = [float if _is_number(df, n) else object for n in grid.names]
    cuts = [np.array(c, kind) for c, kind in zip(grid.cuts, kinds, strict=True)]
    bits = grid.bits

    @pandas_udf("bigint")
    def place(values: pd.DataFrame) -> pd.Series:
        cells = []
        for cut, c in zip(cuts, values.columns, strict=True):
            if cut.dtype == object:
                known, at = np.unique(values[c].fillna("").to_numpy(object), return_inverse=True)
                cells.append(np.searchsorted(cut, known, side="left")[at])
            else:
                cells.append(np.searchsorted(cut, values[c].fillna(-np.inf).to_numpy(), side="left"))
        return pd.Series(curve_index(np.stack(cells, axis=1), bits))

    return df.withColumn(name, place(F.struct(*[_order_value(df, n).alias(n) for n in grid.names])))


def sharded(
    docs: DataFrame,
    columns: list[str],
    shards: int = SHARDS,
    bits: int = BITS,
) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, curve) per row of documents.

    Rows lie on the curve over `columns`, numeric or text, ties by a hash of id and text, by id and
    by checksum. Shard s is the s-th of `shards` runs whose counts are at most one apart (the `rows`
    law); slot is the place in the run. size: UTF-8 bytes of the text plus 1. grown_shard is null:
    another shard moves every cut.

    The order is cut at percentiles of (curve, hash) into as many ranges as there are shuffle
    partitions, so equal curve places are dealt over many tasks; each range is numbered by itself
    and shifted by the rows before it.

    Null texts count as empty. Null metadata fall into the first cell. Rows without an id, and rows
    that repeat, each have a slot of their own. An empty table gives an empty one. Other columns are
    ignored; `columns` may be among those.
    """
    if len(columns) * bits + TIE_BITS > 63:
        raise ValueError("the curve's cells and the tie bits must fit into 63 bits")
    grid = fit_grid(docs, columns, bits)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    placed = with_curve(
        docs.select(
            F.col("doc_id").cast("bigint").alias("_doc"),
            (F.octet_length(text) + 1).cast("bigint").alias("_size"),
            F.crc32(F.encode(text, "UTF-8")).cast("bigint").alias("_crc"),
            *[F.col(c) for c in columns],
        ),
        grid,
        "_curve",
    ).select("_doc", "_size", "_crc", "_curve")
    tie = F.pmod(F.xxhash64("_doc", "_crc"), F.lit(1 << TIE_BITS))
    placed = placed.withColumn("_key", F.shiftleft(F.col("_curve"), TIE_BITS) + tie)

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / n for i in range(1, n)] or [0.5]
    found = placed.agg(F.percentile_approx("_key", F.array(*map(F.lit, shares)), 10 * n)).first()[0]
    cuts = np.array(sorted(set(found or ())), np.int64)

    @pandas_udf("bigint")
    def range_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, key.to_numpy(), side="left"))

    placed = placed.withColumn("_range", range_of("_key"))
    sizes = placed.groupBy("_range").agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_range",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
        F.sum("_rows").over(Window.partitionBy()).alias("_total"),
    )
    in_range = Window.partitionBy("_range").orderBy("_key", "_doc", "_crc", "_size")
    placed = placed.withColumn("_n", F.row_number().over(in_range) - 1)
    # One row per range, and ranges are bounded by the number of shuffle partitions.
    placed = placed.join(F.broadcast(starts), "_range")
    at = F.col("_before") + F.col("_n")
    # Shard s holds the places from floor(s * total / shards) on.
    placed = placed.withColumn("_at", at).withColumn(
        "_shard", F.expr(f"CAST(((_at + 1) * {shards} - 1) DIV _total AS int)")
    )
    first = F.expr(f"(_shard * _total) DIV {shards}")
    return placed.select(
        F.col("_doc").alias("doc_id"),
        F.col("_size").alias("size"),
        F.col("_crc").alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("_shard").alias("shard"),
        (F.col("_at") - first).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("_curve").alias("curve"),
    )
