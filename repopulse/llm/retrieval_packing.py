"""Packing by lexical retrieval: a seed document's window is filled with its BM25 neighbours.

Documents are put in order of their most telling tokens, by document frequencies over all of them, and
dealt into shards of a set size along that order, so documents that share rare tokens meet. Each shard
holds an inverted index of its documents, scored by the frequencies and the mean length over all: the
seed's tokens ask it for documents that are not used yet, which fill the window
in order of score. The document that overflows the window is cut and its rest seeds the next one, so
windows are full; what a shard has left over at the end is cut into runs whose lengths are powers of
two. No position is padded.
"""

from __future__ import annotations

import os
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repopulse.llm.grams import bytes_of, small_batches, span_hashes
from repopulse.llm.store import spread, stored, text_input

WINDOW = 2048
SHARD_BYTES = 8 << 20
KEY_TOKENS = 3  # a document's place in the order: 16 bits of each, and 15 bits of salt
RANGES = 8  # of the order, a shard
END_ID = 1
KNOWN_TOKENS = 1 << 23  # of the runs kept, 4 bytes each
PLACES = 1 << 21  # of the table that finds them, 16 bytes each
AT_ONCE = 256  # documents whose tokens are counted at a time
USUAL = 4  # a token held by every fourth document or more has a score for each of them

_encoders: dict[str, WordEncoder] = {}


# Words of these characters are NFC already, have simple lower-case forms and no contractions, so the
# tokenizer's own steps leave runs of letters, single digits and runs of other marks, whose ids its
# model gives directly. Of the two bytes of U+00C0 to U+00FF the first is always 0xC3.
_BREAK, _LETTER, _DIGIT, _MARK, _ODD = range(5)
_KIND = np.full(256, _ODD, np.uint8)
_KIND[0x21:0x7F] = _MARK
_KIND[[0x20, *range(0x09, 0x0E)]] = _BREAK
_KIND[[*b"'<"]] = _ODD
_KIND[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = _LETTER
_KIND[ord("0") : ord("9") + 1] = _DIGIT
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_HIGH = np.zeros(256, bool)  # the second byte of a letter
_HIGH[0x80:0xC0] = True
_HIGH[[0x97, 0xB7]] = False
_UPPER = np.zeros(256, bool)
_UPPER[0x80:0x9F] = _HIGH[0x80:0x9F]


def _byte_letters() -> dict[int, str]:
    """The tokenizer's letter for each byte: itself if it prints, else the next from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(256, 512))
    return {b: chr(b) if b in shown else chr(next(hidden)) for b in range(256)}


@dataclass
class Runs:
    """Runs of a batch in order: hash, byte span, whether an odd word, and the first run of each text."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    odd: np.ndarray
    first: np.ndarray  # of each text, one more at the end
    data: np.ndarray  # the batch's bytes, plain words in lower case


def runs_of(texts: pa.Array) -> Runs:
    """The runs that plain words part into; a word with any other character is one run as it stands."""
    data, bounds = bytes_of(texts)
    kind = _KIND[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    lead = lead[_HIGH[data[lead + 1]]]
    kind[lead] = kind[lead + 1] = _LETTER
    inside = kind != _BREAK
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    edges = bounds[:-1][bounds[:-1] < len(data)]
    opens[edges] = inside[edges]
    word = np.flatnonzero(opens)
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    edges = bounds[1:][bounds[1:] > 0] - 1
    closes[edges] = inside[edges]
    word_ends = np.flatnonzero(closes) + 1
    before = np.append(0, np.cumsum(kind == _ODD, dtype=np.int32))
    odd_word = before[word_ends] > before[word]

    lower = _LOWER[data]
    upper = lead[_UPPER[data[lead + 1]]] + 1
    lower[upper] += 32
    units = lower.astype(np.uint64)
    part = np.zeros(len(data), bool)
    part[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    part &= inside
    for start, end in zip(word[odd_word].tolist(), word_ends[odd_word].tolist(), strict=True):
        part[start:end] = False
        lower[start:end] = data[start:end]
        units[start:end] = data[start:end].astype(np.uint64) + np.uint64(256)
    part[word] = True
    starts = np.flatnonzero(part)
    owner = np.searchsorted(word, starts, side="right") - 1
    ends = word_ends[owner]
    same = owner[1:] == owner[:-1]
    ends[:-1][same] = starts[1:][same]
    hashes = span_hashes(units, starts, ends)
    return Runs(hashes, starts, ends, odd_word[owner], np.searchsorted(starts, bounds), lower)


class WordEncoder:
    """Token ids of whole texts, a batch at a time.

    The tokenizer drops white space and never joins across it, so a text's ids are its runs' ids in
    a row. Runs are kept with their ids, by hash, one in each place of a table; a full store is emptied.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(PLACES, np.uint64)
        self.firsts = np.zeros(PLACES, np.int32)
        self.sizes = np.full(PLACES, -1, np.int32)
        self.ids = np.zeros(1 << 16, np.uint32)
        self.held = 0

    def encode(self, texts: pa.Array | list[str]) -> list[np.ndarray]:
        """The ids of each text; null texts have none."""
        if isinstance(texts, list):
            texts = pa.array(texts, pa.large_string())
        flat, bounds = self.encode_flat(texts)
        return [flat[a:z] for a, z in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]

    def encode_flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's begin (one more at the end)."""
        runs = runs_of(texts)
        if self.held > KNOWN_TOKENS:
            self._forget()
        place = (runs.hashes >> np.uint64(40)).astype(np.int64) & (PLACES - 1)
        size = np.where(self.keys[place] == runs.hashes, self.sizes[place], -1)
        first = self.firsts[place]
        new = np.flatnonzero(size < 0)
        if len(new):
            _, one, which = np.unique(runs.hashes[new], return_index=True, return_inverse=True)
            firsts, sizes = self._learn(runs, new[one])
            first[new], size[new] = firsts[which], sizes[which]
            place = place[new[one]]
            # Of several runs with one place the last stays, with all of its entries.
            self.keys[place], self.firsts[place], self.sizes[place] = runs.hashes[new[one]], firsts, sizes
        ends = np.cumsum(size, dtype=np.int64)
        flat = self.ids[np.repeat(first - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]
        return flat, np.append(0, ends)[runs.first]

    def _learn(self, runs: Runs, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Puts the ids of some runs behind those that are kept; where each run's begin, and how many."""
        data = runs.data.tobytes().decode("latin-1")  # a character for each byte
        spans = [data[a:z] for a, z in zip(runs.starts[at].tolist(), runs.ends[at].tolist(), strict=True)]
        whole = {n: spans[n].encode("latin-1").decode() for n in np.flatnonzero(runs.odd[at]).tolist()}
        odd = self.tokenizer.encode_batch_fast(list(whole.values()), add_special_tokens=False)
        odd = dict(zip(whole, odd, strict=True))
        tokenize, letters = self.model.tokenize, self.letters
        if odd:
            ids = [
                odd[n].ids if n in odd else [t.id for t in tokenize(span.translate(letters))]
                for n, span in enumerate(spans)
            ]
            found = [i for some in ids for i in some]
        else:
            ids = [tokenize(s if s.isascii() else s.translate(letters)) for s in spans]
            found = [t.id for some in ids for t in some]
        sizes = np.fromiter(map(len, ids), np.int32, len(ids))
        firsts = (self.held + np.cumsum(sizes, dtype=np.int64) - sizes).astype(np.int32)
        stop = self.held + len(found)
        if stop > len(self.ids):
            self.ids = np.append(self.ids[: self.held], np.zeros(2 * stop - self.held, np.uint32))
        self.ids[self.held : stop] = found
        self.held = stop
        return firsts, sizes


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


@dataclass(frozen=True)
class Corpus:
    """Over all documents: their number, mean length, and how many hold each token id."""

    documents: int
    mean: float
    held: np.ndarray

    def idf(self, held: np.ndarray) -> np.ndarray:
        return np.log1p((self.documents - held + 0.5) / (held + 0.5))

    def rarity(self) -> np.ndarray:
        """The place of each token id from the rarest that two documents hold; others come last."""
        order = np.argsort(np.where(self.held < 2, 1 << 62, self.held), kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        place[self.held < 2] = 65_535
        return np.minimum(place, 65_535)


def _distinct(values: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct values (whole numbers) of each of n owners, ascending; how often; and where each owner's begin."""
    bits = int(values.max()).bit_length() if len(values) else 0
    kind = np.uint32 if bits + n.bit_length() <= 32 else np.uint64
    both = owner.astype(kind) << kind(bits)
    both |= values.astype(kind)
    both.sort()
    at = np.flatnonzero(np.append(True, both[1:] != both[:-1])[: len(both)])
    times = np.diff(np.append(at, len(both)))
    both = both[at]
    first = np.searchsorted(both, np.arange(n + 1).astype(kind) << kind(bits))
    return (both & kind((1 << bits) - 1)).astype(np.int64), times, first


def _keys(flat: np.ndarray, bounds: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """Each document's place in the order: its rarest tokens, 16 bits each; none is the last value."""
    n = len(bounds) - 1
    owner = np.repeat(np.arange(n), np.diff(bounds))
    places, _, first = _distinct(rarity[flat], owner, n)
    key = np.zeros(n, np.int64)
    for step in range(KEY_TOKENS):
        at = first[:-1] + step
        some = at < first[1:]
        place = np.full(n, 65_535, np.int64)
        place[some] = places[at[some]]
        key = (key << 16) | place
    return key


def id_kind(path: str) -> np.dtype:
    """Little-endian numbers that hold any id of a tokenizer: two bytes each, or four."""
    from tokenizers import Tokenizer

    ids = Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values()
    return np.dtype("<u2" if max(ids, default=0) < 1 << 16 else "<u4")


def _flat(column: pa.Array | pa.ChunkedArray, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a binary column in a row, and where each row's begin (one more at the end)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    data, bounds = bytes_of(column.cast(pa.large_binary()).view(pa.large_string()))
    return np.frombuffer(data, kind), bounds // kind.itemsize


class Index:
    """BM25 over the token ids of a shard's documents, which are a corpus if none is given.

    A token that many of them hold has a row with a score for each document, others have lists.
    """

    def __init__(
        self,
        ids: list[np.ndarray],
        corpus: Corpus | None = None,
        k1: float = 1.2,
        b: float = 0.75,
    ) -> None:
        n = len(ids)
        lengths = np.array([len(x) for x in ids], np.int64)
        counted = []
        for at in range(0, n, AT_ONCE):
            some = ids[at : at + AT_ONCE]
            owner = np.repeat(np.arange(len(some)), lengths[at : at + AT_ONCE])
            counted.append(_distinct(np.concatenate(some), owner, len(some)))
        tokens, times = (
            np.concatenate([c[i] for c in counted]) if n else np.zeros(0, np.int64) for i in (0, 1)
        )
        sizes = np.concatenate([np.diff(c[2]) for c in counted]) if n else np.zeros(0, np.int64)
        first = np.append(0, np.cumsum(sizes))
        owner = np.repeat(np.arange(n), sizes)
        small = tokens.astype(np.uint16) if len(tokens) and tokens.max() < 1 << 16 else tokens
        order = np.argsort(small, kind="stable")
        if corpus is None:
            corpus = Corpus(n, float(lengths.mean()) if n else 0.0, np.bincount(tokens))
        norm = k1 * (1 - b + b * lengths / max(corpus.mean, 1.0))
        self.tokens, self.first, held = np.unique(
            tokens[order], return_index=True, return_counts=True
        )
        self.stop = self.first + held
        self.idf = corpus.idf(corpus.held[self.tokens])
        self.idf[held < 2] = 0.0  # such a token leads to no other document
        self.docs = owner[order]
        times = times[order]
        self.score = np.repeat(self.idf, held) * times * (k1 + 1) / (times + norm[self.docs])
        self.own = [tokens[a:z] for a, z in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
        usual = (held * USUAL >= n) & (self.idf > 0)
        self.row = np.where(usual, np.cumsum(usual) - 1, -1)
        self.rows = np.zeros((int(usual.sum()), n))
        of = np.repeat(usual, held)
        self.rows[np.repeat(self.row, held)[of], self.docs[of]] = self.score[of]
        self.listed = np.arange(n)  # the documents that lists and rows are of
        self._cut(~of)
        # What a query gathers goes to the same place each time.
        self._docs, self._score = np.empty_like(self.docs), np.empty_like(self.score)

    def keep(self, unused: np.ndarray) -> None:
        """Takes the entries of used documents out of the lists; all else stays as it is."""
        kept = unused[self.listed]
        self._cut(kept[self.docs])
        self.docs = (np.cumsum(kept) - 1)[self.docs]
        self.rows, self.listed = self.rows[:, kept], self.listed[kept]

    def _cut(self, kept: np.ndarray) -> None:
        before = np.append(0, np.cumsum(kept))
        self.first, self.stop = before[self.first], before[self.stop]
        self.docs, self.score = self.docs[kept], self.score[kept]

    def neighbours(self, doc: int, unused: np.ndarray) -> np.ndarray:
        """Unused documents that share a token with a document, best first by all its tokens."""
        telling = np.searchsorted(self.tokens, self.own[doc])
        telling = telling[self.idf[telling] > 0]
        if not len(telling):
            return telling
        row = self.row[telling]
        usual, telling = row[row >= 0].tolist(), telling[row < 0]
        bounds = zip(self.first[telling].tolist(), self.stop[telling].tolist(), strict=True)
        spans = [slice(a, z) for a, z in bounds]
        size = int((self.stop[telling] - self.first[telling]).sum())
        docs, parts = self._docs[:size], self._score[:size]
        score = np.zeros(len(self.listed))
        for i in usual:
            score += self.rows[i]
        if spans:
            np.concatenate([self.docs[s] for s in spans], out=docs)
            np.concatenate([self.score[s] for s in spans], out=parts)
            score += np.bincount(docs, parts, len(score))
        score[~unused[self.listed]] = 0
        found = np.flatnonzero(score)
        worst = -score[found]
        order = np.argsort(worst)
        ranked = worst[order]
        if (ranked[1:] == ranked[:-1]).any():
            order = np.argsort(worst, kind="stable")
        return self.listed[found[order]]


def fill(sizes: list[int], index: Index, window: int) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) that hold every token once."""
    unused = np.ones(len(sizes), bool)
    listed, left = len(sizes), len(sizes)  # documents that the index lists, and that are not used
    pieces: list[tuple[int, int, int, int, int]] = []
    sequence, room = 0, window
    upcoming, place = np.zeros(0, np.int64), 0  # neighbours of the seed, best first, and the next
    at = 0
    while True:
        while place < len(upcoming) and not unused[upcoming[place]]:
            place += 1
        if place < len(upcoming):
            doc = int(upcoming[place])
            place += 1
        else:
            while at < len(sizes) and not unused[at]:
                at += 1
            if at == len(sizes):
                break
            doc = at
        unused[doc] = False
        left -= 1
        start = 0
        seeds = room == window
        while start < sizes[doc]:
            length = min(room, sizes[doc] - start)
            pieces.append((doc, start, length, sequence, window - room))
            start, room = start + length, room - length
            if room == 0:
                sequence, room = sequence + 1, window
                seeds = True
        if seeds or place == len(upcoming):
            if left < listed - listed // 4:
                index.keep(unused)
                listed = left
            upcoming, place = index.neighbours(doc, unused), 0
    return _tail_cut(pieces, sequence, window)


def _tail_cut(pieces, sequence: int, window: int):
    """The last, partly filled sequence as runs whose lengths are powers of two, longest first."""
    cut = len(pieces)
    while cut and pieces[cut - 1][3] == sequence:
        cut -= 1
    out, tail = pieces[:cut], pieces[cut:]
    left = sum(piece[2] for piece in tail)
    room, offset = 0, 0
    number = sequence - 1
    for doc, start, length, _, _ in tail:
        while length:
            if room == 0:
                room, offset, number = 1 << (left.bit_length() - 1), 0, number + 1
            taken = min(room, length)
            out.append((doc, start, taken, number, offset))
            start, length, left = start + taken, length - taken, left - taken
            room, offset = room - taken, offset + taken
    return out


def _corpus(tokens: DataFrame, kind: np.dtype) -> Corpus:
    """One row a token id comes to the driver."""

    def count(batches):
        held, documents, length = np.zeros(0, np.int64), 0, 0
        for batch in batches:
            for part in small_batches(batch, "ids"):
                flat, bounds = _flat(part.column("ids"), kind)
                documents, length = documents + len(bounds) - 1, length + len(flat)
                owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
                own = np.bincount(_distinct(flat, owner, len(bounds) - 1)[0], minlength=len(held))
                own[: len(held)] += held
                held = own
        token = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.append(token, [-1, -2])),
                pa.array(np.append(held[token], [documents, length])),
            ],
            ["token", "n"],
        )

    counted = tokens.select("ids").mapInArrow(count, "token bigint, n bigint")
    found = {r["token"]: r["n"] for r in counted.groupBy("token").agg(F.sum("n").alias("n")).collect()}
    documents, length = found.pop(-1, 0), found.pop(-2, 0)
    held = np.zeros(max(found, default=0) + 1, np.int64)
    held[list(found)] = list(found.values())
    return Corpus(documents, length / max(documents, 1), held)


def _dealt(
    tokens: DataFrame, corpus: Corpus, shards: int, shard_bytes: int, kind: np.dtype
) -> DataFrame:
    """`tokens` with the shard of each row: runs of the order by rare tokens, of like bytes.

    Rows of equal tokens lie in the order by a salt, so that runs can be cut among them too.
    """
    if shards == 1:
        return tokens.withColumn("shard", F.lit(0).cast("bigint"))
    rarity = corpus.rarity()

    def keys_of(part: pa.RecordBatch) -> np.ndarray:
        key = _keys(*_flat(part.column("ids"), kind), rarity)
        return (key << 15) + part.column("salt").to_numpy(zero_copy_only=False)

    def key(batches):
        for batch in batches:
            for part in small_batches(batch, "ids"):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys_of(part)), part.column("bytes")], ["key", "bytes"]
                )

    salt = F.pmod(spread("doc_id", "ids"), F.lit(1 << 15))
    salted = tokens.withColumn("salt", salt)
    n = RANGES * shards
    keys = stored(salted.select("ids", "salt", "bytes").mapInArrow(key, "key bigint, bytes bigint"))
    shares = F.array(*[F.lit(i / n) for i in range(1, n)])
    cuts = keys.agg(F.percentile_approx("key", shares, 10 * n)).first()[0]
    cuts = np.array(sorted(set(cuts or ())), np.int64)

    @F.pandas_udf("bigint")
    def range_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, key.to_numpy(), side="left"))

    sizes = np.zeros(len(cuts) + 1, np.int64)
    at = range_of("key").alias("at")
    for row in keys.select(at, "bytes").groupBy("at").agg(F.sum("bytes").alias("bytes")).collect():
        sizes[row["at"]] = row["bytes"]
    names = (np.cumsum(sizes) - sizes // 2) // shard_bytes

    def deal(batches):
        for batch in batches:
            for part in small_batches(batch, "ids"):
                shard = names[np.searchsorted(cuts, keys_of(part), side="left")]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("ids"), pa.array(shard)],
                    ["doc_id", "ids", "shard"],
                )

    salted = salted.select("doc_id", "ids", "salt")
    return salted.mapInArrow(deal, "doc_id bigint, ids binary, shard bigint")


def packed(
    docs: DataFrame,
    tokenizer: str,
    window: int = WINDOW,
    shard_bytes: int = SHARD_BYTES,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of documents (doc_id, text) in sequences of at most `window` tokens.

    Columns: doc_id, start (tokens of its document before it), length, ids_crc32 (of the ids as
    little-endian 32-bit numbers), doc_tokens (with the end id), sequence_id, offset, and the ids
    with `with_ids`. A document is its token ids and END_ID. Each token is in exactly one piece; a
    sequence is as long as the window or a power of two.

    Null and empty texts are a single END_ID. Rows without an id, and rows that repeat, are packed
    like any other. A text of any length is cut over windows. An empty table gives an empty one;
    other columns are ignored.
    """
    rows = text_input(docs, "doc_id", "text")
    kind = id_kind(tokenizer)

    def encode(batches):
        for whole in batches:
            for batch in small_batches(whole, "text"):
                flat, bounds = encoder(tokenizer).encode_flat(batch.column("text"))
                bounds = pa.py_buffer((bounds * kind.itemsize).astype(np.int64).tobytes())
                data = pa.py_buffer(flat.astype(kind).tobytes())
                ids = pa.Array.from_buffers(pa.large_binary(), batch.num_rows, [None, bounds, data])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("bytes"), ids.cast(pa.binary())],
                    ["doc_id", "bytes", "ids"],
                )

    rows = rows.withColumn("bytes", F.octet_length("text").cast("bigint") + 1)
    rows = stored(rows.mapInArrow(encode, "doc_id bigint, bytes bigint, ids binary"))
    size = rows.agg(F.sum("bytes")).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))
    corpus = _corpus(rows, kind)
    rows = _dealt(rows, corpus, shards, shard_bytes, kind).select("doc_id", "ids", "shard")

    def pack(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("ids", "ascending")])
        names = table.column("doc_id").to_pylist()
        flat, bounds = _flat(table.column("ids"), kind)
        plain = [flat[a:z] for a, z in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        index = Index(plain, corpus)
        tokens = [np.append(x, END_ID).astype("<u4") for x in plain]
        pieces = fill([len(x) for x in tokens], index, window)
        doc, start, length, sequence, offset = (
            np.array(column, np.int64) for column in zip(*pieces, strict=True)
        )
        parts = [tokens[d][s : s + n] for d, s, n, _, _ in pieces]
        columns = {
            "doc_id": pa.array([names[d] for d in doc.tolist()], pa.int64()),
            "start": pa.array(start),
            "length": pa.array(length),
            "ids_crc32": pa.array([zlib.crc32(part.tobytes()) for part in parts], pa.int64()),
            "doc_tokens": pa.array(np.array([len(x) for x in tokens], np.int64)[doc]),
            "sequence_id": pa.array((key[0].as_py() << 32) + sequence),
            "offset": pa.array(offset),
        }
        if with_ids:
            columns["ids"] = pa.array([part.astype(np.int32) for part in parts], pa.list_(pa.int32()))
        return pa.table(columns)

    schema = (
        "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
        "sequence_id bigint, offset bigint" + (", ids array<int>" if with_ids else "")
    )
    return rows.groupBy("shard").applyInArrow(pack, schema)
