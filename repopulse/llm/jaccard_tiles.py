"""N-gram Jaccard join: size-banded tiles, bitmap signatures, exact intersection.

Two sets of a and b shingles whose Jaccard similarity is at least p per cent differ in at most
(a + b)(100 - p) / (100 + p) shingles. Sets of one size band (level) cut the hash space into the same
2^level segments, more than that many differences, so at least one segment is the same in both. A
set sends one key per segment, but only for its first D + 1 non-empty ones (D: its largest possible
number of differences): of these at least one is untouched, and the first untouched one is among the
first D + 1 of the partner too. A set whose band ends within reach of a larger partner sends the
keys of the next band as well, and so does a set with too few non-empty segments. No link is lost.

Sets that share a key are a tile. A link to the tile's smallest member joins most groups of copies.
Within a tile only members of different groups are then compared: first by size, then by bitmap (a
bit set in one and not in the other stands for a shingle only one of them has, which bounds the
overlap from above), then by a bitmap that grows with the set, and what is left by exact intersection.
Large tiles are cut into blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repopulse.llm.components import components
from repopulse.llm.grams import (
    distinct_sets,
    lists,
    mix,
    shingles,
    small_batches,
    span_hashes,
    words_of,
)
from repopulse.llm.store import dropped, spread, stored, text_input

BITMAP_WORDS = 16
TILE_SIDE = 512
BITS_EACH = 8  # of a set's wide bitmap, per shingle at least


def differences(n: np.ndarray, percent: int) -> np.ndarray:
    """The most shingles in which a set of n and any partner similar enough can differ."""
    return (n + n * 100 // percent) * (100 - percent) // (100 + percent)


def _level(n: np.ndarray, percent: int) -> np.ndarray:
    return np.ceil(np.log2(differences(n, percent) + 1)).astype(np.int64)


def tile_keys(
    values: np.ndarray, first: np.ndarray, percent: int
) -> tuple[np.ndarray, np.ndarray]:
    """Keys of ascending sets in a row, and where each set's keys begin."""
    n = np.diff(first)
    owner = np.repeat(np.arange(len(n)), n)
    allowed = differences(n, percent)
    low, high = _level(n, percent), _level(n * 100 // percent, percent)
    found_keys, found_owner = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    level, active = low.copy(), n > 0
    while active.any():
        at = np.flatnonzero(active[owner])
        sets, bits = owner[at], level[owner[at]]
        shift = np.minimum(64 - bits, 63).astype(np.uint64)
        segment = np.where(bits == 0, np.uint64(0), values[at] >> shift)
        opens = np.ones(len(at), bool)
        opens[1:] = (sets[1:] != sets[:-1]) | (segment[1:] != segment[:-1])
        starts = np.flatnonzero(opens)
        ends = np.append(starts[1:], len(at))
        whose = sets[starts]
        filled = np.bincount(whose, minlength=len(n))
        place = np.arange(len(starts)) - (np.cumsum(filled) - filled)[whose]
        kept = place <= allowed[whose]
        hashes = span_hashes(values[at], starts[kept], ends[kept])
        found_keys.append(mix(hashes + level[whose[kept]].astype(np.uint64)))
        found_owner.append(whose[kept])
        active &= (level < high) | (filled <= allowed)
        level += 1
    keys, whose = np.concatenate(found_keys), np.concatenate(found_owner)
    order = np.argsort(whose, kind="stable")
    return keys[order], np.searchsorted(whose[order], np.arange(len(n) + 1))


def bitmaps(values: np.ndarray, first: np.ndarray, words: int = BITMAP_WORDS) -> np.ndarray:
    """One row of `words` 64-bit words per set; the bit of a shingle is a hash of it."""
    n = np.diff(first)
    bit = mix(values) % np.uint64(64 * words)
    flat = np.zeros(len(n) * words * 64, bool)
    flat[np.repeat(np.arange(len(n)), n) * (64 * words) + bit.astype(np.int64)] = True
    return np.packbits(flat, bitorder="little").view(np.uint64).reshape(len(n), words)


def wide_bitmaps(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bitmaps in a row that grow with their set, and where each begins; none where `bitmaps` is as wide.

    Lengths are powers of two, so the narrower bitmap of the same set is the wide one folded.
    """
    n = np.diff(first)
    size = np.int64(1) << np.ceil(np.log2(np.maximum(n * BITS_EACH, 1))).astype(np.int64)
    size = np.where(size > 64 * BITMAP_WORDS, size, 0)
    stop = np.cumsum(size)
    own = np.repeat(size > 0, n)
    sizes, opens = (np.repeat(x, n)[own] for x in (size, stop - size))
    flat = np.zeros(int(size.sum()), bool)
    flat[opens + (mix(values[own]) & (sizes - 1).astype(np.uint64)).astype(np.int64)] = True
    return np.packbits(flat, bitorder="little").view(np.uint64), np.append(0, stop) // 64


def _sets(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray]:
    words = words_of(batch.column("text"))
    hashes, text, _ = shingles(words, size)
    return distinct_sets(hashes, text, batch.num_rows)


def described(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(doc_id, n, d1, d2, keys) per row: set size, 128-bit digest of the set, tile keys.

    Of equal sets in a partition only the first sends keys, so a group of copies of any size sends
    as many as there are partitions at most.
    """

    def work(batches):
        seen: set[tuple[int, int]] = set()
        for whole in batches:
            for batch in small_batches(whole, "text"):
                values, first = _sets(batch, size)
                starts, ends = first[:-1], first[1:]
                d1 = span_hashes(values, starts, ends)
                d2 = span_hashes(mix(values), starts, ends)
                new = np.zeros(len(starts), bool)
                for i, digest in enumerate(zip(d1.tolist(), d2.tolist(), strict=True)):
                    if starts[i] < ends[i] and digest not in seen:
                        seen.add(digest)
                        new[i] = True
                sizes = np.where(new, ends - starts, 0)
                sent = values[np.repeat(new, ends - starts)]
                keys, key_first = tile_keys(sent, np.append(0, np.cumsum(sizes)), percent)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        pa.array((ends - starts).astype(np.int64)),
                        pa.array(d1.view(np.int64)),
                        pa.array(d2.view(np.int64)),
                        lists(keys.view(np.int64), key_first),
                    ],
                    ["doc_id", "n", "d1", "d2", "keys"],
                )

    schema = "doc_id bigint, n bigint, d1 bigint, d2 bigint, keys array<bigint>"
    return docs.mapInArrow(work, schema)


def _with_sets(docs: DataFrame, size: int, whole_sets: bool = True) -> DataFrame:
    """(doc_id, n, shingles, bits, wide) of documents, or without `whole_sets` all but the shingles."""

    def work(batches):
        for whole in batches:
            for batch in small_batches(whole, "text"):
                values, first = _sets(batch, size)
                bits = bitmaps(values, first)
                wide, wide_first = wide_bitmaps(values, first)
                columns = {
                    "doc_id": batch.column("doc_id"),
                    "n": pa.array(np.diff(first).astype(np.int64)),
                    "shingles": lists(values.view(np.int64), first) if whole_sets else None,
                    "bits": lists(
                        bits.reshape(-1).view(np.int64), np.arange(len(bits) + 1) * BITMAP_WORDS
                    ),
                    "wide": lists(wide.view(np.int64), wide_first),
                }
                columns = {name: c for name, c in columns.items() if c is not None}
                yield pa.RecordBatch.from_arrays([*columns.values()], [*columns])

    shingles = "shingles array<bigint>, " if whole_sets else ""
    return docs.mapInArrow(
        work, f"doc_id bigint, n bigint, {shingles}bits array<bigint>, wide array<bigint>"
    )


def _enough(common: Column, a: Column, b: Column, percent: int) -> Column:
    return common * (100 + percent) >= (a + b) * percent


def _only_left(left: str, right: str) -> Column:
    """Bits set on the left and not on the right."""
    both = F.zip_with(left, right, lambda x, y: F.bit_count(x.bitwiseAND(F.bitwise_not(y))))
    return F.aggregate(both, F.lit(0), lambda total, x: total + x)


def _close(batch: pa.RecordBatch, percent: int) -> np.ndarray:
    """Which pairs of sets may be similar enough by their bitmaps, the wider one folded."""
    (a, a_at), (b, b_at) = (
        (column.values.to_numpy().view(np.uint64), column.offsets.to_numpy())
        for column in (batch.column("bits_a"), batch.column("bits_b"))
    )
    kept = np.zeros(batch.num_rows, bool)
    sizes = zip(*[batch.column(c).to_pylist() for c in ("n_a", "n_b")], strict=True)
    for i, (n_a, n_b) in enumerate(sizes):
        x, y = a[a_at[i] : a_at[i + 1]], b[b_at[i] : b_at[i + 1]]
        words = min(len(x), len(y))
        x, y = (np.bitwise_or.reduce(bits.reshape(-1, words), axis=0) for bits in (x, y))
        only_a, only_b = (int(np.bitwise_count(bits).sum()) for bits in (x & ~y, y & ~x))
        common = min(n_a - only_a, n_b - only_b)
        kept[i] = common * (100 + percent) >= (n_a + n_b) * percent
    return kept


def _sifted(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) that wide bitmaps don't rule out."""
    bits = F.when(F.size("wide") > 0, F.col("wide")).otherwise(F.col("bits"))
    for name in ("a", "b"):
        side = [F.col("doc_id").alias(name), F.col("n").alias(f"n_{name}"), bits.alias(f"bits_{name}")]
        pairs = pairs.join(sets.select(side), name)

    def sift(batches):
        for batch in batches:
            yield batch.select(["a", "b"]).filter(pa.array(_close(batch, percent)))

    return pairs.mapInArrow(sift, "a bigint, b bigint")


def _linked(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Those stored pairs (a, b) whose shingles are similar enough, by exact intersection.

    Sets are made for the documents of the pairs only, and go when the pairs are held against each other.
    """
    ends = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    sets = stored(
        _with_sets(docs.join(ends, "doc_id", "left_semi"), size).select("doc_id", "n", "shingles")
    )

    def side(name: str) -> DataFrame:
        return sets.select(
            F.col("doc_id").alias(name),
            F.col("n").alias(f"n_{name}"),
            F.col("shingles").alias(f"shingles_{name}"),
        )

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    common = F.size(F.array_intersect("shingles_a", "shingles_b"))
    enough = _enough(common, F.col("n_a"), F.col("n_b"), percent)
    found = stored(both.where(enough).select("a", "b").distinct())
    dropped(sets, pairs)
    return found


def _members(tiles: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """The members of tiles in which different groups meet, with their bitmaps and blocks."""
    grouped = tiles.join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    grouped = grouped.withColumn("label", F.coalesce("label", "doc_id"))
    mixed = grouped.groupBy("key").agg(
        F.min("label").alias("least"), F.max("label").alias("most"), F.count("*").alias("members")
    )
    blocks = F.ceil(F.col("members") / TILE_SIDE).cast("int").alias("blocks")
    mixed = mixed.where("least < most").select("key", blocks)
    rows = grouped.join(mixed, "key").join(sets.select("doc_id", "n", "bits"), "doc_id")
    return rows.withColumn("block", F.pmod(spread("doc_id"), "blocks").cast("int"))


def _rivals(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of a tile's `_members` from different groups that size and bitmaps don't rule out."""
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))

    def side(name: str) -> DataFrame:
        own, other = ("i", "j") if name == "a" else ("j", "i")
        return rows.select(
            "key",
            F.col("block").alias(own),
            every.alias(other),
            *[F.col(c).alias(f"{c}_{name}") for c in ("doc_id", "label", "n", "bits")],
        )

    overlap = F.least(
        F.col("n_a") - _only_left("bits_a", "bits_b"), F.col("n_b") - _only_left("bits_b", "bits_a")
    )
    possible = _enough(overlap, F.col("n_a"), F.col("n_b"), percent)
    tile = side("a").join(side("b"), ["key", "i", "j"])
    tile = tile.where((F.col("doc_id_a") < F.col("doc_id_b")) & (F.col("label_a") != F.col("label_b")))
    pairs = tile.where(possible).select(F.col("doc_id_a").alias("a"), F.col("doc_id_b").alias("b"))
    return pairs.distinct()


def jaccard_groups(
    docs: DataFrame,
    size: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row: groups of texts linked by similar word shingles.

    Words are lower-cased (A-Z) runs of anything but space and 0x09-0x0D. Two texts link if
    100 |A & B| >= percent |A | B| of their sets of `size`-word shingles; component_id is the
    smallest id reachable by links. Texts are whole, and no link between different sets is lost.

    Null or wordless texts have 0 shingles, link with nothing and keep their own id. Rows without an
    id keep a null component. Rows that share an id are one document: the links of each count. Rows
    that repeat come out as often. An empty table gives an empty one; other columns are ignored.
    """
    docs = text_input(docs, id_col, text_col)
    about = stored(described(docs, size, percent))
    named = about.where("doc_id IS NOT NULL AND n > 0").select("doc_id", "d1", "d2")
    classes = named.groupBy("d1", "d2").agg(F.min("doc_id").alias("class"))
    member = stored(named.join(classes, ["d1", "d2"]).select("doc_id", "class").distinct())
    several = member.groupBy("doc_id").agg(F.min("class").alias("a"), F.max("class").alias("z"))
    same_id = several.where("a < z").join(member, "doc_id").select("a", F.col("class").alias("b"))

    sent = about.where("doc_id IS NOT NULL").select(F.explode("keys").alias("key"), "doc_id")
    ends = sent.groupBy("key").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    shared = sent.join(ends.where("low < high").select("key"), "key")
    tiles = stored(
        shared.join(member, "doc_id").select("key", F.col("class").alias("doc_id")).distinct()
    )
    sizes = stored(about.select("doc_id", "n"))
    dropped(about)
    least = tiles.groupBy("key").agg(
        F.min("doc_id").alias("hub"), F.max("doc_id").alias("most")
    )
    in_tile = tiles.join(least.where("hub < most"), "key").where("doc_id > hub")
    votes = in_tile.groupBy("doc_id", "hub").agg(F.count("*").alias("votes"))
    stars = votes.groupBy("doc_id").agg(
        F.max_by("hub", F.struct("votes", -F.col("hub"))).alias("hub")
    )
    stars = stored(stars.select(F.col("hub").alias("a"), F.col("doc_id").alias("b")))
    wanted = in_tile.select("doc_id").union(in_tile.select("hub")).distinct()
    sketches = stored(_with_sets(docs.join(wanted, "doc_id", "left_semi"), size, whole_sets=False))

    # Whole sets travel only for what the bitmaps leave, and tables go as soon as nothing reads them.
    likely = stored(_sifted(stars, sketches, percent).distinct())
    dropped(stars)
    links = _linked(likely, docs, size, percent).union(same_id)
    labels = components(links)
    rows = stored(_members(tiles, labels, sketches))
    dropped(tiles)
    rivals = stored(_rivals(rows, percent))
    dropped(rows)
    likely = stored(_sifted(rivals, sketches, percent).distinct())
    dropped(rivals, sketches)
    labels = components(links.union(_linked(likely, docs, size, percent)))

    # Copies, then groups: two joins on ids, so that large groups are split like any skewed join.
    labelled = member.join(labels.withColumnRenamed("node", "class"), "class", "left")
    labelled = labelled.groupBy("doc_id").agg(
        F.min(F.coalesce("label", "class")).alias("component_id")
    )
    result = sizes.select("doc_id", F.col("n").alias("n_shingles")).join(labelled, "doc_id", "left")
    return result.select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )
