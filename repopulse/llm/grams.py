"""Words and n-grams of a whole Arrow batch of texts at once, hashed with numpy.

A batch of texts is one array of UTF-8 bytes. A word's hash is the difference of two prefix sums, so
no Python object is made per word. Hashes depend only on the word, not on its batch or place.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
SHIFT = np.uint64(0xD1B54A32D192ED03)

# Bytes 0x09-0x0D and 0x20 part words; other UTF-8 bytes never have these values.
_BREAK = np.zeros(256, bool)
_BREAK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits whose every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(name: str, base: np.uint64, size: int) -> np.ndarray:
    if name not in _powers or len(_powers[name]) < size:
        steps = np.full(max(size, 1 << 16), base, np.uint64)
        steps[0] = 1
        _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers[name][:size]


def span_hashes(units: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of units[start:end] for each span; equal spans have equal hashes wherever they lie."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(units) + 1, np.uint64)
    np.cumsum((units + np.uint64(1)) * _power("base", BASE, len(units)), out=sums[1:])
    plain = (sums[ends] - sums[starts]) * _power("inverse", INVERSE, len(units) + 1)[starts]
    return mix(plain + (ends - starts).astype(np.uint64) * SHIFT)


def prefix_hashes(units: np.ndarray, size: int) -> np.ndarray:
    """`span_hashes` of all runs of `size` units, in order."""
    n = len(units) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(units) + 1, np.uint64)
    np.cumsum((units + np.uint64(1)) * _power("base", BASE, len(units)), out=sums[1:])
    plain = (sums[size:] - sums[:n]) * _power("inverse", INVERSE, len(units) + 1)[:n]
    return mix(plain + np.uint64(size * int(SHIFT) % 2**64))


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and where each begins (one more at the end)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


@dataclass
class Words:
    """Words of a batch in order: hash, byte span, and the first word of each text."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # of each text, one more at the end
    data: np.ndarray  # the batch's bytes
    bounds: np.ndarray  # of the texts in data

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def words_of(texts: pa.Array, lower: bool = True) -> Words:
    """Words are runs of anything but space and 0x09-0x0D; A-Z count as a-z."""
    data, bounds = bytes_of(texts)
    inside = ~_BREAK[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    edges = bounds[:-1][bounds[:-1] < len(data)]
    opens[edges] = inside[edges]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    edges = bounds[1:][bounds[1:] > 0] - 1
    closes[edges] = inside[edges]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    units = _LOWER[data] if lower else data
    hashes = span_hashes(units.astype(np.uint64), starts, ends)
    return Words(hashes, starts, ends, np.searchsorted(starts, bounds), data, bounds)


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingles of `size` words in order: hash, text number, word number in the text.

    A text with fewer words, but at least one, has its whole sequence as its only shingle.
    """
    counts = words.counts
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    text = np.repeat(np.arange(len(counts)), n)
    place = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    at = words.first[:-1][text] + place
    stop = np.minimum(at + size, words.first[1:][text])
    return span_hashes(words.hashes, at, stop), text, place


def distinct_sets(hashes: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes of each text, ascending, in a row; and where each text's begin."""
    order = np.argsort(hashes, kind="stable")
    order = order[np.argsort(text[order], kind="stable")]
    hashes, text = hashes[order], text[order]
    keep = np.ones(len(hashes), bool)
    keep[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    hashes, text = hashes[keep], text[keep]
    return hashes, np.searchsorted(text, np.arange(n + 1))


def lists(values: np.ndarray, first: np.ndarray) -> pa.Array:
    """An Arrow list column whose i-th list is values[first[i]:first[i + 1]]."""
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values))


def small_batches(batch: pa.RecordBatch, text: str, most: int = 1 << 18):
    """Slices of a batch with about `most` bytes of text each (a single text is never cut)."""
    column = batch.column(batch.schema.get_field_index(text))
    sizes = np.nan_to_num(
        pc.binary_length(column).cast(pa.float64()).to_numpy(zero_copy_only=False)
    )
    block = (np.cumsum(sizes) - sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(sizes)]
    for start, stop in zip(cuts, cuts[1:], strict=False):
        if stop > start:
            yield batch.slice(start, stop - start)
