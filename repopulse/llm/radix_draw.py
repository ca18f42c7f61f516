"""Importance resampling towards a target text collection, ranked by a distributed radix sort.

Features are runs of one and two words, counted in hashed buckets over all documents and over the
target texts. A bucket's gain is the whole-number log ratio of its smoothed shares; the gains are one
array, and a document's weight is the floored mean over its features. Gumbel noise drawn by the id is
added, and the highest scores are drawn.

Ranks come from a least-significant-digit radix sort of the composite key (score descending, id
ascending). Rows have a place; 65,536 places in a row are a block. A pass takes one byte of the key,
counts its digits in every block, turns the counts into global offsets by prefix sums over
(digit, block), and gives each row the offset of its block and digit plus its number among those rows
in the order of places: a stable counting sort. Passes over bytes that are equal in all rows are left
out. After the last pass a row's place is its rank. Only ids, scores and weights move, never texts.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repopulse.llm.grams import bytes_of, small_batches
from repopulse.llm.store import stored

BLOCK_BITS = 16  # places of a block; bounds what one window group holds
DIGIT_BITS = 8
LONG = 64  # bytes; longer words are hashed one by one


@dataclass(frozen=True)
class Settings:
    buckets: int = 10_000
    unit: int = 1_000
    seed: str = "7"
    percent: int = 25
    least_words: int = 20


_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x61:0x7B] = _WORD[0x41:0x5B] = _WORD[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


def _zero_tables() -> np.ndarray:
    """[n][i][b]: a state whose i-th byte is b, after n zero bytes. States combine by exclusive or."""
    tables = np.zeros((LONG + 1, 4, 256), np.uint32)
    for i in range(4):
        tables[0, i] = np.arange(256, dtype=np.uint32) << np.uint32(8 * i)
    for n in range(LONG):
        tables[n + 1] = _TABLE[tables[n] & 255] ^ (tables[n] >> np.uint32(8))
    return tables


_TABLE = _crc_table()
_ZEROS = _zero_tables()
_ONES = np.uint32(0xFFFFFFFF)


def _after_zeros(state: np.ndarray, n: np.ndarray) -> np.ndarray:
    out = np.zeros(len(state), np.uint32)
    for i in range(4):
        out ^= _ZEROS[n, i, (state >> np.uint32(8 * i)) & np.uint32(255)]
    return out


@dataclass
class Words:
    """Words of a batch in order: span in the lower-cased bytes, and the first word of each text."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray


def words_of(texts: pa.Array) -> Words:
    """Words are runs of digits, letters a-z (A-Z are lower-cased) and bytes beyond ASCII."""
    data, bounds = bytes_of(texts)
    inside = _WORD[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edges = bounds[1:-1][(bounds[1:-1] > 0) & (bounds[1:-1] < len(data))]
    opens[edges] = inside[edges]
    closes[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(opens)
    return Words(_LOWER[data], starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, bounds))


def _states(words: Words) -> np.ndarray:
    """Checksum state of each word of at most LONG bytes, from a state of zero."""
    length = words.ends - words.starts
    order = np.argsort(-length, kind="stable")
    order = order[np.searchsorted(-length[order], -LONG) :]
    begin = words.starts[order]
    longest_first = -length[order]
    state = np.zeros(len(order), np.uint32)
    for j in range(int(-longest_first[0]) if len(order) else 0):
        m = np.searchsorted(longest_first, -j)  # words of more than j bytes
        part = state[:m]
        state[:m] = _TABLE[(part ^ words.data[begin[:m] + j]) & np.uint32(255)] ^ (part >> np.uint32(8))
    out = np.zeros(len(length), np.uint32)
    out[order] = state
    return out


def features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """CRC-32 and text number of every word, then of every pair of neighbouring words."""
    text = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    length = words.ends - words.starts
    long = length > LONG
    short = np.where(long, 0, length)
    state = _states(words)
    after = _after_zeros(np.full(len(state), _ONES), short) ^ state
    single = after ^ _ONES
    for i in np.flatnonzero(long):
        single[i] = zlib.crc32(words.data[words.starts[i] : words.ends[i]].tobytes())
    left = np.flatnonzero(text[1:] == text[:-1]) if len(text) else np.zeros(0, np.int64)
    before = single[left] ^ _ONES
    spaced = _TABLE[(before ^ np.uint32(0x20)) & np.uint32(255)] ^ (before >> np.uint32(8))
    pair = (_after_zeros(spaced, short[left + 1]) ^ state[left + 1]) ^ _ONES
    for at in np.flatnonzero(long[left + 1]):
        i = left[at] + 1
        tail = words.data[words.starts[i] : words.ends[i]].tobytes()
        pair[at] = zlib.crc32(tail, int(spaced[at] ^ _ONES))
    return np.concatenate([single, pair]), np.concatenate([text, text[left]])


def bucket_counts(rows: DataFrame, settings: Settings) -> np.ndarray:
    """Features per bucket over all texts (`text`); what comes to the driver is a row per bucket."""
    buckets = settings.buckets

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for whole in batches:
            for batch in small_batches(whole, "text"):
                crc, _ = features(words_of(batch.column("text")))
                total += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    counts = rows.select("text").mapInArrow(count, "bucket bigint, n bigint")
    found = counts.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return out


def gains(raw: np.ndarray, target: np.ndarray, settings: Settings) -> np.ndarray:
    """Whole gain of each bucket."""
    s, t = raw.astype(np.float64), target.astype(np.float64)
    ratio = ((t + 1) * (s.sum() + settings.buckets)) / ((s + 1) * (t.sum() + settings.buckets))
    return np.floor(settings.unit * np.log(ratio)).astype(np.int64)


def weighed(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row of `docs` (doc_id, text)."""

    def weigh(batches):
        for whole in batches:
            for batch in small_batches(whole, "text"):
                words = words_of(batch.column("text"))
                crc, text = features(words)
                n = np.bincount(text, minlength=batch.num_rows)
                total = np.zeros(batch.num_rows, np.int64)
                np.add.at(total, text, gain[crc % np.uint32(len(gain))])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        pa.array(np.diff(words.first).astype(np.int64)),
                        pa.array(n.astype(np.int64)),
                        pa.array(total // np.maximum(n, 1)),
                    ],
                    ["doc_id", "n_words", "n_features", "weight"],
                )

    return docs.mapInArrow(
        weigh, "doc_id bigint, n_words bigint, n_features bigint, weight bigint"
    )


def noise(settings: Settings) -> Column:
    """Whole Gumbel noise of a row, drawn by its id (a null id counts as empty text)."""
    drawn = F.concat(F.lit(f"{settings.seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(drawn, 256), 1, 8), 16, 10).cast("double")
    unit = F.lit(float(-settings.unit))
    return F.floor(unit * F.log(-F.log((h + F.lit(0.5)) / F.lit(float(1 << 32))))).cast("bigint")


# --- radix sort -----------------------------------------------------------------------------------


def _digit(word: str, index: int) -> Column:
    return F.shiftrightunsigned(F.col(word), DIGIT_BITS * index).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1)).cast("int")


def counting_pass(rows: DataFrame, digit: Column) -> DataFrame:
    """Rows with `place` set to their place in the stable order of a digit; places begin at 0.

    Counts are one row per block and digit, so the window over a digit holds one row per block and
    the window over totals one row per digit. A window over rows holds part of one block.
    """
    cut = rows.withColumns({"_block": F.shiftright("place", BLOCK_BITS), "_digit": digit})
    counts = cut.groupBy("_digit", "_block").agg(F.count("*").alias("_n"))
    over = Window.partitionBy("_digit").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    inside = counts.select(
        "_digit", "_block", F.coalesce(F.sum("_n").over(over), F.lit(0)).alias("_inside")
    )
    totals = counts.groupBy("_digit").agg(F.sum("_n").alias("_total"))
    below = Window.orderBy("_digit").rowsBetween(Window.unboundedPreceding, -1)
    below = totals.select("_digit", F.coalesce(F.sum("_total").over(below), F.lit(0)).alias("_below"))
    starts = inside.join(F.broadcast(below), "_digit").select(
        "_digit", "_block", (F.col("_inside") + F.col("_below")).alias("_start")
    )
    order = Window.partitionBy("_digit", "_block").orderBy("place")
    numbered = cut.withColumn("_number", F.row_number().over(order) - 1)
    placed = numbered.join(starts, ["_digit", "_block"])
    return placed.withColumn("place", F.col("_start") + F.col("_number")).select(rows.columns)


def radix_ranked(rows: DataFrame, keys: list[Column]) -> DataFrame:
    """Rows with `rank` 1, 2, 3, ... in the order of bigint keys, ascending as signed numbers.

    Equal rows get ranks of their own, one after another. `rows` must be stored rows, whose order in
    their files is their first order; columns named `place`, `rank` or `_...` are not allowed.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    # With the top bit turned over, the unsigned order of the bytes is the signed order of the key.
    top = F.lit(-(1 << 63))
    keyed = rows.withColumns({n: k.bitwiseXOR(top) for n, k in zip(names, keys, strict=True)})
    keyed = stored(keyed.withColumn("place", F.monotonically_increasing_id()))
    varying = keyed.agg(*[F.bit_or(n).bitwiseXOR(F.bit_and(n)).alias(n) for n in names]).first()
    passes = [
        (n, i)
        for n in reversed(names)
        for i in range(8)
        if ((varying[n] or 0) >> (DIGIT_BITS * i)) & ((1 << DIGIT_BITS) - 1)
    ]
    for word, index in passes or [(names[0], 0)]:
        keyed = stored(counting_pass(keyed, _digit(word, index)))
    return keyed.select(*rows.columns, (F.col("place") + 1).alias("rank"))


def resampled(docs: DataFrame, target: DataFrame, settings: Settings | None = None) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of `docs` (doc_id, text).

    `target` (text) holds the texts to resemble. Of the N rows with at least `least_words` words,
    floor(percent * N / 100) with the highest scores have ranks, ties to smaller ids; repeated rows
    are ranked one by one. Null, empty and wordless texts have no features and weight 0. A null id
    draws its noise as empty text and comes after equal scores. Empty tables give empty ones, and an
    empty target is a uniform one. Other columns are ignored.
    """
    settings = settings or Settings()
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias("text"))
    raw = bucket_counts(docs, settings)
    gain = gains(raw, bucket_counts(target, settings), settings)
    scored = weighed(docs, gain).withColumn("score", F.col("weight") + noise(settings))
    scored = stored(scored)
    columns = ["doc_id", "n_features", "weight", "score"]
    eligible = F.col("n_words") >= settings.least_words
    ranked = radix_ranked(
        scored.where(eligible).select(columns),
        [F.negative("score"), F.coalesce("doc_id", F.lit((1 << 63) - 1))],
    )
    drawn = settings.percent * scored.where(eligible).count() // 100
    rank = F.when(F.col("rank") <= drawn, F.col("rank")).cast("bigint").alias("rank")
    rest = scored.where(~eligible).select(*columns, F.lit(None).cast("bigint").alias("rank"))
    return ranked.select(*columns, rank).unionAll(rest)
