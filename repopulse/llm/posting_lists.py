"""Approximate nearest neighbours by balanced posting lists.

Centroids fitted on a bounded sample part the vectors into lists. A vector near the boundary of
several cells is put into each of their lists. Centroids are searched by best-first walks on a graph
of their neighbours held in memory, and a query reads the lists whose centroid is at most `ratio`
times as far as its nearest. Lists are cut into blocks of bounded size, so frequent regions and
popular queries are shared by many tasks. Equal vectors are one entry.

The largest inner product is looked for as the smallest distance, after one more component has
brought all vectors to the same length (0 for queries).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repopulse.llm.store import stored


@dataclass(frozen=True)
class Settings:
    """`sample` bounds the vectors the centroids are fitted on, `max_lists` the centroids.

    `wanted_recall` is what the distance ratio is calibrated for, on `trial` queries that are held
    against all vectors.
    """

    k: int = 20
    list_rows: int = 512
    max_lists: int = 4096
    sample: int = 16_384
    rounds: int = 8
    degree: int = 24
    replicas: int = 8
    boundary: float = 1.1
    trial: int = 128
    wanted_recall: float = 0.97
    block: int = 2048


@dataclass(frozen=True)
class Centroids:
    """Cell centres with the graph of their nearest neighbours and the walks' first centres."""

    points: np.ndarray
    graph: np.ndarray
    entries: np.ndarray

    def distances(self, vectors: np.ndarray, ratio: float, least: int = 16) -> np.ndarray:
        """Distances to the centres a best-first walk has met, infinite to the others.

        The walk goes on while the nearest centre not yet left is within `ratio` of the nearest one,
        and over `least` centres in any case.
        """
        n, every = len(vectors), np.arange(len(vectors))
        out = np.full((n, len(self.points)), np.inf, np.float32)
        to_leave = np.full_like(out, np.inf)

        def meet(rows: np.ndarray, centres: np.ndarray) -> None:
            gap = self.points[centres] - vectors[rows][:, None, :]
            found = np.sqrt(np.einsum("ijk,ijk->ij", gap, gap))
            new = np.isinf(out[rows[:, None], centres])
            at, which = np.nonzero(new)
            out[rows[at], centres[at, which]] = found[at, which]
            to_leave[rows[at], centres[at, which]] = found[at, which]

        meet(every, np.broadcast_to(self.entries, (n, len(self.entries))))
        rows, left = every, np.zeros(n, np.int64)
        while len(rows):
            nearest = to_leave[rows].argmin(axis=1)
            there = to_leave[rows, nearest]
            best = out[rows].min(axis=1)
            on = np.isfinite(there) & ((there <= ratio * best) | (left[rows] < least))
            rows, nearest = rows[on], nearest[on]
            to_leave[rows, nearest] = np.inf
            left[rows] += 1
            if len(rows):
                meet(rows, self.graph[nearest])
        return out


def fit(sample: np.ndarray, n_lists: int, settings: Settings) -> Centroids:
    """k-means centres of a sample and the graph of each one's nearest others."""
    draw = np.random.default_rng(0)
    points = sample[draw.choice(len(sample), n_lists, replace=False)].astype(np.float32)
    for _ in range(settings.rounds):
        near = np.argmax(sample @ points.T - 0.5 * (points * points).sum(axis=1), axis=1)
        held = np.bincount(near, minlength=n_lists)
        sums = np.zeros(points.shape, np.float64)
        np.add.at(sums, near, sample)
        points = np.where(held[:, None] > 0, sums / np.maximum(held, 1)[:, None], points)
        points = points.astype(np.float32)
    squares = (points * points).sum(axis=1)
    apart = squares[:, None] + squares - 2 * points @ points.T
    np.fill_diagonal(apart, np.inf)
    degree = min(settings.degree, n_lists - 1)
    graph = np.argsort(apart, axis=1, kind="stable")[:, :degree]
    if degree == 0:
        graph = np.zeros((n_lists, 1), np.int64)
    # A few far edges keep the graph in one piece.
    far = draw.integers(0, n_lists, (n_lists, 4))
    entries = draw.choice(n_lists, min(16, n_lists), replace=False)
    return Centroids(points, np.concatenate([graph, far], axis=1), entries)


def homes(centroids: Centroids, vectors: np.ndarray, settings: Settings):
    """Row numbers and lists: each vector's nearest list and the others hardly farther."""
    rows, cells = [], []
    for at in range(0, len(vectors), 256):
        part = vectors[at : at + 256]
        gap = centroids.distances(part, settings.boundary)
        near = np.argsort(gap, axis=1, kind="stable")[:, : settings.replicas]
        kept = np.take_along_axis(gap, near, axis=1) <= settings.boundary * gap.min(axis=1)[:, None]
        row, place = np.nonzero(kept)
        rows.append(row + at)
        cells.append(near[row, place])
    return np.concatenate(rows), np.concatenate(cells)


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _level(vectors: np.ndarray, length: float) -> np.ndarray:
    """Vectors with one more component that brings all to `length`."""
    rest = np.sqrt(np.maximum(length**2 - (vectors.astype(np.float64) ** 2).sum(axis=1), 0))
    return np.concatenate([vectors, rest[:, None]], axis=1).astype(np.float32)


def _aimed(queries: np.ndarray, length: float) -> np.ndarray:
    """Queries, which only their direction matters of, at that length with a 0 added."""
    queries = queries.astype(np.float64)
    queries = queries * (length / np.sqrt((queries**2).sum(axis=1)))[:, None]
    return np.concatenate([queries, np.zeros((len(queries), 1))], axis=1).astype(np.float32)


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector) of distinct rows whose vector can be compared.

    Left out: null ids; null, empty and zero vectors, those with null or non-finite components, and
    those of another length than most.
    """
    rows = df.select(
        F.col(id_col).cast("bigint").alias("vec_id"),
        F.col(vector_col).cast("array<float>").alias("vector"),
    ).where("vec_id IS NOT NULL AND vector IS NOT NULL")
    finite = F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    rows = rows.where(finite & F.exists("vector", lambda x: x != 0))
    sizes = rows.groupBy(F.size("vector").alias("size")).count()
    usual = sizes.orderBy(F.desc("count"), "size").first()
    return rows.where(F.size("vector") == (usual["size"] if usual else 0))


def _keys() -> list[Column]:
    return [F.xxhash64("vector").alias("k1"), F.xxhash64(F.lit(1), "vector").alias("k2")]


def entries(rows: DataFrame, k: int) -> DataFrame:
    """(k1, k2, vector, ids): distinct vectors with the k + 1 smallest ids that have them.

    More ids of one vector can't be among anyone's k nearest; they go before rows are shuffled.
    """
    first = Window.partitionBy("vector").orderBy("vec_id")
    few = rows.distinct().withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= k + 1)
    ids = F.sort_array(F.collect_list("vec_id")).alias("ids")
    return few.groupBy("vector").agg(ids).select(*_keys(), "vector", "ids")


def best_of(queries: np.ndarray, vectors: np.ndarray, first_ids: np.ndarray, k: int):
    """Per query the k best vectors' numbers and inner products, best first, ties to smaller ids.

    Products of single floats are exact in double precision; they are added component by component.
    """
    wide_q, wide_v = queries.astype(np.float64), vectors.astype(np.float64)
    rough = wide_q @ wide_v.T
    some = min(k + 8, len(vectors))
    near = np.broadcast_to(np.arange(len(vectors)), rough.shape)
    if some < len(vectors):
        near = np.argpartition(-rough, some - 1, axis=1)[:, :some]
    exact = np.zeros(near.shape)
    for c in range(queries.shape[1]):
        exact += wide_q[:, c : c + 1] * wide_v[near, c]
    order = np.lexsort((first_ids[near], -exact), axis=1)[:, :k]
    return np.take_along_axis(near, order, axis=1), np.take_along_axis(exact, order, axis=1)


FOUND = "k1 bigint, k2 bigint, score double, ids array<bigint>"


def _search(queries: pa.Table, held: pa.Table, k: int) -> pa.Table:
    """The k best of some vectors for each of some queries, as far as they reach its bound."""
    if not queries.num_rows or not held.num_rows:
        return pa.table(
            [pa.array([], t) for t in (pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.int64()))],
            names=["k1", "k2", "score", "ids"],
        )
    ids = held.column("ids").combine_chunks()
    first_ids = pc.list_element(ids, 0).to_numpy()
    near, score = best_of(
        _matrix(queries.column("vector")), _matrix(held.column("vector")), first_ids, k
    )
    bound = queries.column("bound").to_numpy()
    row, place = np.nonzero(score >= bound[:, None])
    return pa.table(
        [
            queries.column("k1").take(pa.array(row)),
            queries.column("k2").take(pa.array(row)),
            pa.array(score[row, place]),
            ids.take(pa.array(near[row, place])),
        ],
        names=["k1", "k2", "score", "ids"],
    )


def _top(found: DataFrame, k: int) -> DataFrame:
    """(k1, k2, vec_id, score): the k best ids of each query vector, each once."""
    best = Window.partitionBy("k1", "k2").orderBy(F.desc("score"), F.col("ids")[0])
    entry = found.groupBy("k1", "k2", "ids").agg(F.max("score").alias("score"))
    entry = entry.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k)
    one = entry.select("k1", "k2", "score", F.explode("ids").alias("vec_id"))
    one = one.groupBy("k1", "k2", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("k1", "k2").orderBy(F.desc("score"), "vec_id")
    return one.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k).drop("_n")


def _calibrated(held: DataFrame, asked: DataFrame, index, length: float, settings: Settings):
    """The distance ratio that finds the wanted share of the trial queries' true neighbours.

    The trial queries are held against all vectors, block by block; the queries, their neighbours
    and so all that comes to the driver are bounded by the settings.
    """
    few = asked.orderBy("k1", "k2").limit(settings.trial).select("k1", "k2", "vector").toArrow()
    few = few.combine_chunks()
    names = ["k1", "k2", "score", "ids", "vector"]

    def scan(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            near, score = best_of(
                _matrix(few.column("vector")),
                _matrix(table.column("vector")),
                np.arange(table.num_rows),
                settings.k,
            )
            whose = pa.array(np.repeat(np.arange(len(near)), near.shape[1]))
            at = pa.array(near.reshape(-1))
            columns = [
                few.column("k1").take(whose),
                few.column("k2").take(whose),
                pa.array(score.reshape(-1)),
                table.column("ids").take(at),
                table.column("vector").take(at),
            ]
            yield from pa.table(columns, names=names).combine_chunks().to_batches()

    found = held.select("ids", "vector").mapInArrow(scan, FOUND + ", vector array<float>")
    best = Window.partitionBy("k1", "k2").orderBy(F.desc("score"), F.col("ids")[0])
    found = found.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= settings.k)
    true = found.select("k1", "k2", "vector").toArrow()
    place = {key: i for i, key in enumerate(zip(*(few.column(c).to_pylist() for c in ("k1", "k2"))))}
    gap = np.concatenate(
        [
            index.distances(part, np.inf)
            for part in np.array_split(_aimed(_matrix(few.column("vector")), length), 4)
            if len(part)
        ]
    )
    rows, cells = homes(index, _level(_matrix(true.column("vector")), length), settings)
    query = np.array([place[k] for k in zip(*(true.column(c).to_pylist() for c in ("k1", "k2")))])
    least = np.full(len(query), np.inf)
    np.minimum.at(least, rows, gap[query[rows], cells])
    needed = least / gap.min(axis=1)[query]
    return float(np.quantile(needed, settings.wanted_recall, method="higher"))


def nearest(
    df: DataFrame,
    queries: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    settings: Settings | None = None,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k rows of largest inner product that were found.

    `queries` has the same columns as `df` and is searched among all rows of `df` but those of the
    query's own id. Ranks go by score, ties by smaller id; with fewer than k other rows all come.
    Scores are inner products of the original vectors in double precision.

    Rows that `usable` leaves out take no part, neither as queries nor as candidates. Rows that
    repeat count once; an id with several vectors is a candidate by its best one and a query by each.
    Other columns are ignored; an empty table gives an empty one.
    """
    settings = settings or Settings()
    k = settings.k + 1  # a query may find itself
    held = stored(entries(usable(df, id_col, vector_col), settings.k))
    who = usable(queries, id_col, vector_col).distinct().select("vec_id", *_keys(), "vector")
    who = stored(who)
    asked = who.select("k1", "k2", "vector").dropDuplicates(["k1", "k2"])

    squares = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    n, longest = held.agg(F.count("*"), F.sqrt(F.max(squares))).first()
    length = float(longest or 1.0)
    n_lists = max(1, min(settings.max_lists, n // settings.list_rows))
    sample = held.orderBy(F.xxhash64(F.lit(7), "k1")).limit(settings.sample).select("vector").toArrow()
    if not n or asked.isEmpty():
        empty = who.select("vec_id").limit(0)
        return empty.selectExpr(
            "vec_id AS query_id", "1 AS rank", "vec_id", "CAST(0 AS double) AS score"
        )
    index = fit(_level(_matrix(sample.column("vector")), length), n_lists, settings)
    ratio = _calibrated(held, asked, index, length, settings)

    def place(batches):
        for batch in batches:
            vectors = _level(_matrix(batch.column("vector")), length)
            rows, cells = homes(index, vectors, settings)
            table = pa.Table.from_batches([batch]).take(pa.array(rows))
            table = table.append_column("list", pa.array(cells.astype(np.int32)))
            yield from table.combine_chunks().to_batches()

    def route(batches):
        for batch in batches:
            vectors = _aimed(_matrix(batch.column("vector")), length)
            for at in range(0, len(vectors), 256):
                gap = index.distances(vectors[at : at + 256], ratio)
                rows, cells = np.nonzero(gap <= ratio * gap.min(axis=1)[:, None])
                table = pa.Table.from_batches([batch]).take(pa.array(rows + at))
                table = table.append_column("list", pa.array(cells.astype(np.int32)))
                table = table.append_column("home", pa.array(cells == gap.argmin(axis=1)[rows]))
                yield from table.combine_chunks().to_batches()

    key = "k1 bigint, k2 bigint, vector array<float>"
    posted = stored(held.mapInArrow(place, f"{key}, ids array<bigint>, list int"))
    routed = stored(asked.mapInArrow(route, f"{key}, list int, home boolean"))

    def blocks(rows: DataFrame, name: str) -> DataFrame:
        count = F.ceil(F.count("*") / settings.block).cast("int")
        return rows.groupBy("list").agg(count.alias(name))

    # One row per list, and lists are bounded by a setting.
    cut = blocks(posted, "held_blocks").join(blocks(routed, "asked_blocks"), "list")
    posted, routed = (rows.join(F.broadcast(cut), "list") for rows in (posted, routed))

    def every(name: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(name) - 1))

    posted = posted.select(
        "list",
        F.pmod("k1", "held_blocks").cast("int").alias("i"),
        every("asked_blocks").alias("j"),
        "vector",
        "ids",
    )
    routed = routed.select(
        "list",
        every("held_blocks").alias("i"),
        F.pmod("k1", "asked_blocks").cast("int").alias("j"),
        "k1",
        "k2",
        "vector",
        "home",
    )
    tile = ["list", "i", "j"]

    def search(asking: pa.Table, holding: pa.Table) -> pa.Table:
        return _search(asking, holding, k)

    def searched(asking: DataFrame) -> DataFrame:
        return asking.groupBy(*tile).cogroup(posted.groupBy(*tile)).applyInArrow(search, FOUND)

    # What a query finds in its nearest list bounds what is worth returning from the others.
    none = F.lit(float("-inf"))
    near = stored(searched(routed.where("home").withColumn("bound", none)))
    order = Window.partitionBy("k1", "k2").orderBy(F.desc("score"))
    last = near.withColumn("_n", F.row_number().over(order)).where(F.col("_n") == k)
    bounds = last.select("k1", "k2", F.col("score").alias("bound"))
    others = routed.where("NOT home").join(bounds, ["k1", "k2"], "left")
    found = near.union(searched(others.withColumn("bound", F.coalesce("bound", none))))
    best = who.drop("vector").withColumnRenamed("vec_id", "query_id").join(
        _top(found, k), ["k1", "k2"]
    )
    order = Window.partitionBy("query_id", "k1", "k2").orderBy(F.desc("score"), "vec_id")
    best = best.where("vec_id <> query_id").withColumn("rank", F.row_number().over(order))
    return best.where(F.col("rank") <= settings.k).select("query_id", "rank", "vec_id", "score")
