"""Centroid clustering in rounds, with heaps of bounds that say which vectors must be looked at again.

Every vector has an upper bound of the distance to its own centroid and a lower bound of that to all
others. Centroids that move by d widen both bounds by d at most, so the gap between them shrinks by no
more than (drift of the own centroid + largest drift of another). Each cluster adds these up in an
offset. A vector enters its cluster's heap with the key gap + offset of that time; as long as the key
is above the cluster's offset, no other centroid can be nearer, and nothing of the vector is read.

The heaps are sorted runs in Parquet. Offsets only grow, so what a round pops off a cluster's heap are
the rows whose key lies between the old and the new offset: a range that is pushed down to the row
groups and pages of all runs. Popped vectors are measured against all centroids and enter a new run,
with a new key. No run is ever rewritten, and a row that was popped once is never in range again.

A vector travels in its run's rows, so that rounds need no join; what comes to the driver is one sum
per cluster and component.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repopulse.llm.store import stored

LIMIT = 1 << 27  # components beyond it count as it, so that a squared distance fits a bigint
SLACK = 1e-9  # share of all lengths by which bounds are widened for rounding
RUN = "vec_id bigint, cluster int, was int, key double, point array<int>"


@dataclass(frozen=True)
class Settings:
    clusters: int = 8
    rounds: int = 10
    dims: int = 64
    scale: int = 1024
    seed: str = "3"
    row_group: int = 8 << 20  # bytes; small groups let a range of keys skip more


@dataclass(frozen=True)
class Clusters:
    """`assigned` (vec_id, cluster, distance), the final centroids, and the runs of the heaps."""

    assigned: DataFrame
    centroids: list[list[int]]
    runs: list[DataFrame] = field(default_factory=list)


def points(vectors: DataFrame, settings: Settings) -> DataFrame:
    """(vec_id, point) of the vectors with `dims` components, none of them null or non-finite."""
    found = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("x"),
    )
    finite = F.forall("x", lambda v: F.coalesce(F.abs(v) < F.lit(math.inf), F.lit(False)))
    within = F.transform(
        "x",
        lambda v: F.floor(
            F.greatest(F.least(v * F.lit(float(settings.scale)), F.lit(float(LIMIT))), F.lit(-float(LIMIT)))
        ).cast("int"),
    )
    return found.where((F.size("x") == settings.dims) & finite).select(
        "vec_id", within.alias("point")
    )


def first_centroids(rows: DataFrame, settings: Settings) -> list[list[int]]:
    """The vectors with the smallest hashes of their ids; without an id they come last."""
    drawn = F.sha2(F.concat(F.lit(f"{settings.seed}:"), F.col("vec_id").cast("string")), 256)
    few = rows.orderBy(drawn.asc_nulls_last(), "point").limit(settings.clusters)
    return [list(r.point) for r in few.collect()]


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).astype(np.int64)


def squared_distances(matrix: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, one row per vector and one column per centroid."""
    out = np.empty((len(matrix), len(centroids)), np.int64)
    for c, centroid in enumerate(centroids):
        gap = matrix - centroid
        out[:, c] = np.einsum("ij,ij->i", gap, gap)
    return out


def entries(matrix: np.ndarray, centroids: np.ndarray, offsets: np.ndarray):
    """Nearest centroid (ties: the smaller number) and heap key of each vector.

    A key is always above its cluster's offset: a vector without any gap is popped as soon as a
    centroid moves, and a move is never shorter than 1.
    """
    squared = squared_distances(matrix, centroids)
    cluster = squared.argmin(axis=1) if len(matrix) else np.zeros(0, np.int64)
    rows = np.arange(len(matrix))
    upper = np.sqrt(squared[rows, cluster].astype(np.float64))
    if len(centroids) == 1:
        return cluster, np.full(len(matrix), np.inf)
    squared[rows, cluster] = np.iinfo(np.int64).max
    lower = np.sqrt(squared.min(axis=1).astype(np.float64))
    offset = offsets[cluster]
    key = lower - upper - SLACK * (lower + upper + offset + 1) + offset
    return cluster, np.maximum(key, np.nextafter(offset, np.inf))


def scanned(rows: DataFrame, centroids, offsets, settings: Settings) -> DataFrame:
    """Rows (vec_id, was, point) with their cluster and key, each part in the order of the heaps."""
    middle, at = np.array(centroids, np.int64), np.array(offsets, np.float64)

    def scan(batches):
        for batch in batches:
            matrix = _matrix(batch.column("point"), settings.dims)
            cluster, key = entries(matrix, middle, at)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    pa.array(cluster.astype(np.int32)),
                    batch.column("was"),
                    pa.array(key),
                    batch.column("point"),
                ],
                ["vec_id", "cluster", "was", "key", "point"],
            )

    found = rows.select("vec_id", "was", "point").mapInArrow(scan, RUN)
    return found.sortWithinPartitions("cluster", "key")


def changes(run: DataFrame, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """What a run adds to each cluster's component sums and counts (driver: clusters x components)."""
    k, dims = settings.clusters, settings.dims

    def add(batches):
        total = np.zeros((k, dims + 1), np.int64)
        for batch in batches:
            matrix = _matrix(batch.column("point"), dims)
            matrix = np.hstack([matrix, np.ones((len(matrix), 1), np.int64)])
            for name, sign in (("cluster", 1), ("was", -1)):
                place = batch.column(name).fill_null(-1).to_numpy(zero_copy_only=False)
                for c in np.unique(place[place >= 0]):
                    total[c] += sign * matrix[place == c].sum(axis=0)
        c, place = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c), pa.array(place), pa.array(total[c, place])], ["c", "place", "total"]
        )

    moved = run.where("was IS NULL OR was <> cluster").select("cluster", "was", "point")
    sums = moved.mapInArrow(add, "c bigint, place bigint, total bigint")
    out = np.zeros((k, dims + 1), object)
    # Sums of very many long vectors outgrow a bigint.
    for c, place, total in sums.groupBy("c", "place").agg(F.sum(F.col("total").cast("decimal(38,0)"))).collect():
        out[c, place] = int(total)
    return out[:, :dims], out[:, dims]


def between(offsets, before=None) -> Column:
    """Heap rows above the old offset and not above the new one; without an old one, all above."""
    ranges = []
    for c, offset in enumerate(offsets):
        if before is None:
            ranges.append((F.col("cluster") == c) & (F.col("key") > F.lit(float(offset))))
        elif offset > before[c]:
            ranges.append(
                (F.col("cluster") == c)
                & (F.col("key") > F.lit(float(before[c])))
                & (F.col("key") <= F.lit(float(offset)))
            )
    return reduce(lambda a, b: a | b, ranges, F.lit(False))


def _write(df: DataFrame, settings: Settings) -> DataFrame:
    return stored(df, {"parquet.block.size": str(settings.row_group)})


def clustered(vectors: DataFrame, settings: Settings | None = None) -> Clusters:
    """Clusters of `vectors` (vec_id, embedding) after `rounds` rounds and a last assignment.

    Every row with `dims` components takes part, repeated ids and repeated vectors included; rows
    whose vector is null, of another length, or holds null or non-finite components don't. Components
    are floor(scale * x), held within +-2^27. A null id is a row like others, but seeds only where ids
    run out. Fewer vectors than clusters give as many clusters as vectors; an empty table gives none.
    Other columns are ignored.
    """
    settings = settings or Settings()
    rows = points(vectors, settings)
    centroids = first_centroids(rows, settings)
    if not centroids:
        empty = rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance"))
        return Clusters(empty.where(F.lit(False)), [])
    k = len(centroids)
    sums, counts = np.zeros((settings.clusters, settings.dims), object), np.zeros(settings.clusters, object)
    offsets = [0.0] * k
    first = rows.select("vec_id", F.lit(None).cast("int").alias("was"), "point")
    runs = [_write(scanned(first, centroids, offsets, settings), settings)]
    for _ in range(settings.rounds):
        more, number = changes(runs[-1], settings)
        sums, counts = sums + more, counts + number
        moved = [
            [int(s) // int(counts[c]) for s in sums[c]] if counts[c] else centroids[c] for c in range(k)
        ]
        drift = [math.dist(a, b) for a, b in zip(centroids, moved, strict=True)]
        if not any(drift):
            break
        centroids, before = moved, offsets
        # Widened for rounding, as the bounds are.
        offsets = [
            before[c] + (drift[c] + max((d for o, d in enumerate(drift) if o != c), default=0.0)) * (1 + SLACK)
            for c in range(k)
        ]
        heaps = reduce(DataFrame.unionAll, runs)
        popped = heaps.where(between(offsets, before)).withColumn("was", F.col("cluster"))
        # Few rows of very many files: merged by their bytes while they are dealt out evenly.
        popped = popped.select("vec_id", "was", "point").hint("rebalance")
        runs.append(_write(scanned(popped, centroids, offsets, settings), settings))
    live = reduce(DataFrame.unionAll, runs).where(between(offsets))
    return Clusters(stored(_measured(live, centroids, settings)), centroids, runs)


def _measured(rows: DataFrame, centroids, settings: Settings) -> DataFrame:
    """(vec_id, cluster, distance): the exact squared distance to the own centroid."""
    middle = np.array(centroids, np.int64)

    def measure(batches):
        for batch in batches:
            cluster = batch.column("cluster")
            gap = _matrix(batch.column("point"), settings.dims) - middle[cluster.to_numpy()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), cluster, pa.array(np.einsum("ij,ij->i", gap, gap))],
                ["vec_id", "cluster", "distance"],
            )

    return rows.select("vec_id", "cluster", "point").mapInArrow(
        measure, "vec_id bigint, cluster int, distance bigint"
    )


def with_inertia(found: Clusters) -> DataFrame:
    """The assigned rows with the distances summed per cluster and over all.

    Sums that don't fit a bigint are null.
    """
    exact = F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum")
    per = found.assigned.groupBy("cluster").agg(exact)
    sums = {r.cluster: int(r.sum) for r in per.collect()}  # a row per cluster

    def whole(n: int) -> Column:
        return F.lit(n if n < 1 << 63 else None).cast("bigint")

    own = F.lit(None).cast("bigint")
    for c, n in sums.items():
        own = F.when(F.col("cluster") == c, whole(n)).otherwise(own)
    return found.assigned.withColumns(
        {"cluster_inertia": own, "inertia": whole(sum(sums.values()))}
    )
