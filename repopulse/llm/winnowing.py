"""Document fingerprints by winnowing: the least k-gram hash of every window, with its position.

Of every `window` consecutive k-grams of code points the one with the least hash is kept, the
rightmost of equal ones. Any two texts that share a run of window + k - 1 code points therefore share
a kept hash, and the kept positions say where.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from repopulse.llm.grams import bytes_of, lists, small_batches, span_hashes

K = 24
WINDOW = 77
BATCH = 1 << 20


def code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in a row, and where each text begins."""
    data, bounds = bytes_of(texts)
    opens = np.append(0, np.cumsum((data & 0xC0) != 0x80))
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    return points, opens[bounds]


def winnow(
    texts: pa.Array, k: int = K, window: int = WINDOW
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Kept hashes (32 bits) and positions in a row, where each text's begin, and code points.

    A text shorter than k has itself as its only gram, one with fewer grams than a window is one
    window, an empty text has no fingerprint.
    """
    points, first = code_points(texts)
    sizes = np.diff(first)
    grams = np.where(sizes >= k, sizes - k + 1, np.minimum(sizes, 1))
    text = np.repeat(np.arange(len(sizes)), grams)
    gram_first = np.append(0, np.cumsum(grams))
    place = np.arange(len(text)) - gram_first[text]
    at = first[:-1][text] + place
    hashes = span_hashes(points.astype(np.uint64), at, np.minimum(at + k, first[1:][text]))
    # The upper half is the hash, the lower counts down, so the rightmost of equal hashes is least.
    last = np.uint64(0xFFFFFFFF)
    ordered = (hashes >> np.uint64(32) << np.uint64(32)) | (last - place.astype(np.uint64))
    windows = np.where(grams >= window, grams - window + 1, np.minimum(grams, 1))
    text = np.repeat(np.arange(len(sizes)), windows)
    opens = gram_first[text] + np.arange(len(text)) - (np.cumsum(windows) - windows)[text]
    width = np.minimum(window, grams)[text]
    least = np.full(len(text), np.iinfo(np.uint64).max)
    # Minima over runs of 1, 2, 4, ... grams; a window is covered by two runs that may overlap.
    runs, size = ordered, 1
    while len(text):
        fits = (width >= size) & (width < 2 * size)
        front, back = opens[fits], opens[fits] + width[fits] - size
        least[fits] = np.minimum(runs[front], runs[back])
        if 2 * size > window or 2 * size > len(ordered):
            break
        runs = np.minimum(runs[:-size], runs[size:])
        size *= 2
    new = np.ones(len(least), bool)
    new[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1])
    kept, text = least[new], text[new]
    return (
        kept >> np.uint64(32),
        (last - (kept & last)).astype(np.int64),
        np.searchsorted(text, np.arange(len(sizes) + 1)),
        sizes,
    )


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two fingerprints' hashes; two empty ones are alike."""
    a, b = np.unique(a), np.unique(b)
    common = len(np.intersect1d(a, b, assume_unique=True))
    union = len(a) + len(b) - common
    return common / union if union else 1.0


def fingerprints(
    docs: DataFrame,
    k: int = K,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_chars, hashes, positions) per row, over whole texts; null counts as empty."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def work(batches):
        for whole in batches:
            for batch in small_batches(whole, "text", BATCH):
                hashes, positions, first, sizes = winnow(batch.column("text"), k, window)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        pa.array(sizes),
                        lists(hashes.astype(np.int64), first),
                        lists(positions, first),
                    ],
                    ["doc_id", "n_chars", "hashes", "positions"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        work, f"doc_id {kind}, n_chars bigint, hashes array<bigint>, positions array<bigint>"
    )


def _ranges(ids: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Cuts of the ids into at most n ranges of like size, and the largest id of each range.

    Both are bounded by n, the number of shuffle partitions.
    """
    shares = [i / n for i in range(1, n)]
    if not shares or ids.isEmpty():
        cuts = np.zeros(0, np.int64)
    else:
        found = ids.agg(F.percentile_approx("_order", F.array(*map(F.lit, shares)), 10 * n)).first()
        cuts = np.unique(np.array(found[0], np.int64))
    heads = ids.groupBy(_range_of(cuts)("_order").alias("range")).agg(F.max("_order").alias("head"))
    found = sorted((row["range"], row["head"]) for row in heads.collect())
    full = np.array([r for r, _ in found], np.int64)
    return cuts, np.stack([full, np.array([h for _, h in found], np.int64)]).T.reshape(-1, 2)


def _range_of(cuts: np.ndarray):
    @pandas_udf("bigint")
    def number(order):
        import pandas as pd

        return pd.Series(len(cuts) - np.searchsorted(cuts, order.to_numpy(), side="left"))

    return number


def _homes_of(cuts: np.ndarray, heads: np.ndarray):
    """The range of a row and, for the first row of a range, the range before it (cyclically)."""
    before = {
        int(head): int(heads[i - 1, 0]) for i, head in enumerate(heads[:, 1])
    }

    @pandas_udf("array<struct<range:bigint,guest:boolean>>")
    def homes(order):
        import pandas as pd

        own = len(cuts) - np.searchsorted(cuts, order.to_numpy(), side="left")
        out = []
        for value, home in zip(order.tolist(), own.tolist(), strict=True):
            found = [{"range": home, "guest": False}]
            if value in before:
                found.append({"range": before[value], "guest": True})
            out.append(found)
        return pd.Series(out)

    return homes


def _pairs(batches, k: int, window: int):
    """Each row with the next one of its range; rows come sorted, guests last."""
    carried = None
    for whole in batches:
        for batch in small_batches(whole, "text", BATCH):
            table = pa.Table.from_batches([batch] if carried is None else [carried, batch])
            batch = table.combine_chunks().to_batches()[0]
            carried = batch.slice(batch.num_rows - 1)
            if batch.num_rows > 1:
                yield _compared(batch, k, window)


def _compared(batch: pa.RecordBatch, k: int, window: int) -> pa.RecordBatch:
    texts = batch.column("text").fill_null("")
    ranges = batch.column("range").to_numpy()
    guest = batch.column("guest").to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(~guest[:-1] & (ranges[1:] == ranges[:-1]))
    plain = texts.to_pylist()
    edited = []
    for i in rows.tolist():
        text = plain[i]
        cut = len(text) // 3
        edited.append(text[: len(text) - cut] + plain[i + 1][:cut])
    hashes, positions, first, sizes = winnow(texts, k, window)
    new_hashes, _, new_first, _ = winnow(pa.array(edited, pa.string()), k, window)
    marks, new_marks = _hex(hashes, first), _hex(new_hashes, new_first)
    near_edited, near_next = [], []
    for n, i in enumerate(rows.tolist()):
        own = hashes[first[i] : first[i + 1]]
        near_edited.append(likeness(own, new_hashes[new_first[n] : new_first[n + 1]]))
        near_next.append(likeness(own, hashes[first[i + 1] : first[i + 2]]))
    kept = np.repeat(np.isin(np.arange(len(first) - 1), rows), np.diff(first))
    counts = np.diff(first)[rows]
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id").take(pa.array(rows)),
            pa.array(sizes[rows]),
            pa.array([hashlib.sha256(text.encode("utf-8")).hexdigest() for text in edited]),
            pa.array([marks[i] for i in rows.tolist()], pa.string()),
            pa.array(new_marks, pa.string()),
            pa.array(near_edited, pa.float64()),
            pa.array(near_next, pa.float64()),
            lists(positions[kept], np.append(0, np.cumsum(counts))),
        ],
        [
            "doc_id",
            "n_chars",
            "edited_sha256",
            "fingerprint",
            "edited_fingerprint",
            "near_edited",
            "near_next",
            "positions",
        ],
    )


def _hex(hashes: np.ndarray, first: np.ndarray) -> list[str]:
    """Each text's hashes in order, eight hexadecimal digits each."""
    digits = hashes.astype(">u4").tobytes().hex()
    return [digits[8 * a : 8 * b] for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]


def compared_with_next(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness to it and to the next.

    Documents (doc_id, text) follow each other by descending doc_id; the first follows the last. The
    edited text is the text whose last third (floor of its code points / 3) gives way to as many
    first code points of the next text, or all of it. Likeness is the Jaccard similarity of the
    hashes.

    Texts move once: rows are dealt into ranges of ids, and the first row of each range goes to the
    range before it as well.

    Null texts are empty, with an empty fingerprint; two empty fingerprints are alike (1.0). Rows
    without an id come after the smallest id. Rows that share an id follow each other by text. A
    single row is its own next. An empty table gives an empty one; other columns are ignored.
    """
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(2**63))).alias("_order"),
    )
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts, heads = _ranges(rows.select("_order"), n)
    homes = rows.withColumn("home", F.explode(_homes_of(cuts, heads)("_order")))
    homes = homes.select("doc_id", "text", "_order", "home.range", "home.guest")
    dealt = homes.repartition(n, "range").sortWithinPartitions(
        "range", "guest", F.desc("_order"), "text"
    )
    return dealt.select("doc_id", "text", "range", "guest").mapInArrow(
        lambda batches: _pairs(batches, k, window),
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double, positions array<bigint>",
    )
