"""Quality classifier by importance resampling.

Two generative models over hashed n-grams, one of the target texts (labelled good) and one of all
raw texts, give every document the weight log p_target(text) - log p_raw(text). Gumbel noise on the
weights and a top-k draw documents without replacement in proportion to them; k is the number of
documents whose weight reaches the cut calibrated on held-out labels.

N-grams are taken over words and over word forms. A form is what can be seen of a word without
reading it: case, first and last character, length, symbols inside, and whether the word repeats the
one before it or any earlier one. Word n-grams tell languages and topics apart, form n-grams prose
from lists, shouting, symbol noise and repetition.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repopulse.llm.grams import mix, small_batches, span_hashes, words_of
from repopulse.llm.store import stored

UNITS = 1_000_000  # weights are whole millionths, so sums don't depend on their order


@dataclass(frozen=True)
class Settings:
    """`labelled` bounds the labelled rows used (the first by a hash of their id)."""

    buckets: int = 1 << 16
    labelled: int = 20_000
    smoothing: float = 16.0
    temperature: float = 1.0
    seed: int = 7
    spare: float = 0.995  # share of held-out good documents the cut must leave


_KIND = np.full(256, 4, np.uint64)  # 0 lower, 1 upper, 2 digit, 3 punctuation of prose, 4 other
_KIND[ord("a") : ord("z") + 1] = 0
_KIND[128:] = 0
_KIND[ord("A") : ord("Z") + 1] = 1
_KIND[ord("0") : ord("9") + 1] = 2
for _mark in b".,;:?'\"()-":
    _KIND[_mark] = 3


def _repeats(words) -> tuple[np.ndarray, np.ndarray]:
    """Whether a word equals the one before it, and any earlier one, in its text."""
    text = np.repeat(np.arange(len(words.counts)), words.counts)
    before = np.zeros(len(text), bool)
    before[1:] = (words.hashes[1:] == words.hashes[:-1]) & (text[1:] == text[:-1])
    order = np.lexsort((words.hashes, text))
    again = np.zeros(len(text), bool)
    same = (words.hashes[order][1:] == words.hashes[order][:-1]) & (
        text[order][1:] == text[order][:-1]
    )
    again[order[1:]] = same
    return before, again


def features(texts: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text number of every hashed n-gram of a batch."""
    words = words_of(texts)
    if not len(words.hashes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kinds = _KIND[words.data]
    sums = {k: np.append(0, np.cumsum(kinds == k)) for k in (1, 4)}
    upper, other = (sums[k][words.ends] - sums[k][words.starts] for k in (1, 4))
    length = np.minimum((words.ends - words.starts) // 4, 7)
    before, again = _repeats(words)
    form = kinds[words.starts]
    for part, base in (
        (kinds[words.ends - 1], 5),
        (length, 8),
        (np.minimum(upper, 2), 3),
        (np.minimum(other, 2), 3),
        (before, 2),
        (again, 2),
    ):
        form = form * np.uint64(base) + part.astype(np.uint64)
    plain = (before * 2 + again).astype(np.uint64)
    text = np.repeat(np.arange(len(words.counts)), words.counts)
    place = np.arange(len(text))
    out_hash, out_text = [], []
    for family, units, size in (
        (1, words.hashes, 1),
        (2, words.hashes, 2),
        (3, form, 1),
        (4, form, 2),
        (5, form, 3),
        (6, plain, 8),
    ):
        whole = place + size <= words.first[1:][text]
        hashes = span_hashes(units.astype(np.uint64), place[whole], place[whole] + size)
        out_hash.append(mix(hashes + np.uint64(family)) % np.uint64(buckets))
        out_text.append(text[whole])
    return np.concatenate(out_hash).astype(np.int64), np.concatenate(out_text)


def labelled_sample(labels: DataFrame, settings: Settings) -> DataFrame:
    """(id, good, held_out) of at most `labelled` documents; one that has any bad label is bad.

    Its size has a bound, so it is broadcast.
    """
    sure = labels.select(
        F.col("doc_id").cast("bigint").alias("_id"), F.col("quality").cast("int").alias("_good")
    ).where("_id IS NOT NULL AND _good IS NOT NULL")
    sure = sure.groupBy("_id").agg(F.min("_good").alias("_good"))
    draw = F.xxhash64("_id", F.lit(settings.seed))
    few = sure.orderBy(draw, "_id").limit(settings.labelled)
    return few.select("_id", "_good", (F.pmod(draw, F.lit(5)) == 0).alias("_held"))


def fit(docs: DataFrame, sample: DataFrame, settings: Settings) -> np.ndarray:
    """Millionths of log p_target - log p_raw per bucket.

    Counts are made over all documents; what comes to the driver is one row per bucket.
    """
    buckets = settings.buckets
    rows = docs.select(F.col("doc_id").cast("bigint").alias("_id"), F.col("text").alias("_text"))
    rows = rows.join(F.broadcast(sample), "_id", "left")
    target = F.coalesce((F.col("_good") == 1) & ~F.col("_held"), F.lit(False))
    rows = rows.select("_text", target.alias("_target"))

    def count(batches):
        total = np.zeros((2, buckets), np.int64)
        for whole in batches:
            for batch in small_batches(whole, "_text"):
                bucket, text = features(batch.column("_text"), buckets)
                total[0] += np.bincount(bucket, minlength=buckets)
                good = batch.column("_target").to_numpy(zero_copy_only=False).astype(bool)
                total[1] += np.bincount(bucket[good[text]], minlength=buckets)
        some = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(some), pa.array(total[0][some]), pa.array(total[1][some])],
            ["bucket", "raw", "target"],
        )

    counts = rows.mapInArrow(count, "bucket bigint, raw bigint, target bigint")
    counts = counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    found = counts.toArrow()
    raw, target_n = np.zeros(buckets), np.zeros(buckets)
    at = found["bucket"].to_numpy()
    raw[at], target_n[at] = found["raw"].to_numpy(), found["target"].to_numpy()
    if not target_n.any():
        return np.zeros(buckets, np.int64)
    share = raw + settings.smoothing
    share = share / share.sum()
    strength = settings.smoothing * buckets
    target_share = (target_n + strength * share) / (target_n.sum() + strength)
    return np.round(UNITS * np.log(target_share / share)).astype(np.int64)


def weights(texts: pa.Array, ratio: np.ndarray) -> np.ndarray:
    """Weight of each text in millionths; a text without words has weight 0."""
    bucket, text = features(texts, len(ratio))
    total = np.zeros(len(texts), np.int64)
    np.add.at(total, text, ratio[bucket])
    return total


def keys(ids: np.ndarray, weight: np.ndarray, settings: Settings) -> np.ndarray:
    """Weight plus Gumbel noise drawn by the id, in millionths."""
    drawn = mix(ids.astype(np.int64).view(np.uint64) + mix(np.uint64([settings.seed])))
    uniform = ((drawn >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53
    noise = -np.log(-np.log(uniform))
    return np.round(weight / settings.temperature + UNITS * noise).astype(np.int64)


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("_id").fill_null(-1).to_numpy(zero_copy_only=False)


def scores(docs: DataFrame, ratio: np.ndarray, settings: Settings) -> DataFrame:
    """(doc_id, weight, key) per row."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("_id"), F.col("text").alias("_text"))

    def score(batches):
        for whole in batches:
            for batch in small_batches(whole, "_text"):
                weight = weights(batch.column("_text"), ratio)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_id"),
                        pa.array(weight),
                        pa.array(keys(_ids(batch), weight, settings)),
                    ],
                    ["doc_id", "weight", "key"],
                )

    return rows.mapInArrow(score, "doc_id bigint, weight bigint, key bigint")


def calibrated_cut(scored: DataFrame, sample: DataFrame, settings: Settings) -> int | None:
    """The weight that best parts good from bad held-out documents; None without both kinds.

    The cut is the one of best balanced accuracy, lowered if need be to spare the set share of good
    documents, and then half way to the next weight below, for a margin. It looks at the bounded
    labelled sample only.
    """
    held = scored.join(F.broadcast(sample.where("_held")), F.col("doc_id") == F.col("_id"))
    rows = held.groupBy("_id").agg(F.min("weight").alias("weight"), F.min("_good").alias("good"))
    found = rows.select("weight", "good").toArrow()
    weight, good = found["weight"].to_numpy(), found["good"].to_numpy() == 1
    if good.all() or not good.any():
        return None
    cuts = np.unique(weight)
    kept_good = 1 - np.searchsorted(np.sort(weight[good]), cuts) / good.sum()
    kept_bad = 1 - np.searchsorted(np.sort(weight[~good]), cuts) / (~good).sum()
    best = cuts[np.argmax(kept_good - kept_bad)]
    spared = np.quantile(weight[good], 1 - settings.spare, method="lower")
    cut = min(best, spared)
    below = weight[weight < cut]
    return int((cut + below.max()) // 2 if len(below) else cut)


def kth_largest(df: DataFrame, column: str, k: int, bins: int = 4096) -> int | None:
    """The k-th largest whole number of a column, by a few counts over equal bins."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    if low is None or k <= 0:
        return None
    rest = k
    while True:
        width = (high - low) // bins + 1
        place = F.floor((F.col(column) - F.lit(low)) / F.lit(width)).cast("bigint")
        if width == 1:
            place = F.col(column) - F.lit(low)
        inside = df.where(F.col(column).between(low, high)).groupBy(place.alias("bin")).count()
        for index, count in sorted(((r[0], r[1]) for r in inside.collect()), reverse=True):
            if rest <= count:
                break
            rest -= count
        else:
            return low
        if width == 1:
            return low + index
        low, high = low + index * width, min(high, low + (index + 1) * width - 1)


@dataclass(frozen=True)
class Draw:
    """The fitted ratio and the smallest key drawn; `least` None keeps everything."""

    ratio: np.ndarray
    least: int | None
    settings: Settings


def draw(docs: DataFrame, labels: DataFrame, settings: Settings | None = None):
    """Fit, weigh and draw; returns the scores of all documents and the draw."""
    settings = settings or Settings()
    sample = stored(labelled_sample(labels, settings))
    ratio = fit(docs, sample, settings)
    scored = stored(scores(docs, ratio, settings))
    cut = calibrated_cut(scored, sample, settings)
    least = None
    if cut is not None:
        k = scored.where(F.col("weight") >= cut).count()
        least = kth_largest(scored, "key", k)
    return scored, Draw(ratio, least, settings)


def judged(docs: DataFrame, labels: DataFrame, settings: Settings | None = None) -> DataFrame:
    """(doc_id, weight, key, kept) of every row of `docs` (doc_id, text).

    Weights and keys are in nats. Rows with the k-th key are all kept. Null, empty and wordless texts
    have weight 0. A null id takes part like any other, with noise of its own. Without good and bad
    held-out labels all rows are kept. Other columns are ignored; an empty table gives an empty one.
    """
    scored, drawn = draw(docs, labels, settings)
    kept = F.lit(True) if drawn.least is None else F.col("key") >= drawn.least
    return scored.select(
        "doc_id",
        (F.col("weight") / UNITS).alias("weight"),
        (F.col("key") / UNITS).alias("key"),
        kept.alias("kept"),
    )


def resampled(docs: DataFrame, labels: DataFrame, settings: Settings | None = None) -> DataFrame:
    """The rows of `docs` that are drawn, with all their columns; see `judged`."""
    _, drawn = draw(docs, labels, settings)
    if drawn.least is None:
        return docs
    ratio, least, settings = drawn.ratio, drawn.least, drawn.settings
    id_at, text_at = docs.columns.index("doc_id"), docs.columns.index("text")

    def keep(batches):
        for whole in batches:
            plain = whole.rename_columns([f"_{i}" for i in range(whole.num_columns)])
            for batch in small_batches(plain, f"_{text_at}"):
                weight = weights(batch.column(text_at), ratio)
                ids = batch.column(id_at).cast(pa.int64()).fill_null(-1)
                key = keys(ids.to_numpy(zero_copy_only=False), weight, settings)
                yield batch.filter(pa.array(key >= least)).rename_columns(whole.schema.names)

    return docs.mapInArrow(keep, docs.schema)
