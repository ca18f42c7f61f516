"""SentencePiece encoding and decoding by lattices of pieces.

A word's lattice has an edge for every substring of bounded length that is a piece: the substrings of
all new words of a batch are hashed and joined to the sorted hashes of the piece table. Edges are
grouped by word and end, and a fold over the ends keeps the last piece of the best path to each.

The model merges pairs (BPE), and the sum of piece scores along a path does not decide its result. A
path is the model's result just if every two neighbouring pieces come out as themselves when their
text is encoded alone, and of the paths to one end exactly one has this property. The fold takes the
edge that goes with the last piece at its start; of several it would take the one of best score.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repopulse.llm.grams import lists, mix, small_batches, span_hashes

MARK = "▁"
KNOWN_WORDS = 800_000
GROUP = 1 << 18  # cells of a fold: words times length
BYTE = "<0x{:02X}>"
BATCH = 1 << 20  # bytes of text, so that a lattice holds many words
TOP = np.uint64(44)  # a hash's upper 20 bits are its place in a table


class Pieces:
    """The vocabulary of a model file: ordinary pieces by hash, by text and by id."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        self.texts = [model.id_to_piece(i) for i in range(size)]
        self.scores = np.array([model.get_score(i) for i in range(size)])
        other = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in range(size)]
        ordinary = np.array([i for i in range(size) if not other[i]], np.int64)
        self.by_text = {self.texts[i]: i for i in ordinary.tolist()}
        self.longest = max(map(len, self.by_text))
        points = np.frombuffer(
            "".join(self.texts[i] for i in ordinary).encode("utf-32-le"), np.uint32
        )
        ends = np.cumsum([len(self.texts[i]) for i in ordinary])
        starts = np.append(0, ends[:-1])
        hashes = span_hashes(points.astype(np.uint64), starts, ends)
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], ordinary[order]
        self.some = np.zeros(1 << 20, bool)  # places with a piece, to look up few others
        self.some[self.hashes >> TOP] = True
        self.of_byte = [model.piece_to_id(BYTE.format(b)) for b in range(256)]
        self.out = [
            b"" if model.is_control(i) or model.is_unknown(i) else t.replace(MARK, " ").encode()
            for i, t in enumerate(self.texts)
        ]
        for value, i in enumerate(self.of_byte):
            self.out[i] = bytes([value])
        self.size = size
        self.fits: dict[int, bool] = {}
        # The pair last asked for in each place and its answer, for all pairs of a call at once.
        self.pairs, self.answers = np.full(1 << 20, -1, np.int64), np.zeros(1 << 20, bool)

    def merged(self, text: str) -> list[str]:
        """A short text by the model's own rule: the best-scored neighbours merge, leftmost first."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                piece = self.by_text.get(parts[i] + parts[i + 1])
                if piece is not None and (best is None or self.scores[piece] > best):
                    best, at = self.scores[piece], i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def go_together(self, pairs: np.ndarray) -> np.ndarray:
        """Whether two pieces (first * size + second) can be neighbours."""
        place = mix(pairs.astype(np.uint64)) >> TOP
        found = self.answers[place]
        other = np.flatnonzero(self.pairs[place] != pairs)
        if len(other):
            found[other] = self._asked(pairs[other])
            self.pairs[place[other]] = pairs[other]
            self.answers[place[other]] = found[other]
        return found

    def _asked(self, pairs: np.ndarray) -> np.ndarray:
        distinct, place = np.unique(pairs, return_inverse=True)
        known = self.fits
        if len(known) > 4_000_000:
            known.clear()
        answers = np.empty(len(distinct), bool)
        for n, pair in enumerate(distinct.tolist()):
            answer = known.get(pair)
            if answer is None:
                a, b = self.texts[pair // self.size], self.texts[pair % self.size]
                answer = known[pair] = self.merged(a + b) == [a, b]
            answers[n] = answer
        return answers[place]


def edges(words: list[str], pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Pieces by (word, end, length), -1 where there is none; and the words' code points.

    A character that is no piece has an edge of its own, its code point above the piece ids.
    """
    sizes = np.array([len(word) for word in words])
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    first = np.cumsum(sizes) - sizes
    longest = min(pieces.longest, int(sizes.max()))
    table = np.full((len(words), int(sizes.max()) + 1, longest + 1), -1, np.int32)
    word = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(points)) - first[word]
    units = points.astype(np.uint64)
    for length in range(1, longest + 1):
        at = np.flatnonzero(place + length <= sizes[word])
        hashes = span_hashes(units, at, at + length)
        maybe = np.flatnonzero(pieces.some[hashes >> TOP])
        near = np.searchsorted(pieces.hashes, hashes[maybe])
        near = np.minimum(near, len(pieces.hashes) - 1)
        same = pieces.hashes[near] == hashes[maybe]
        if length == 1:
            found = pieces.size + points[at]
            found[maybe[same]] = pieces.ids[near[same]]
        else:
            at, found = at[maybe[same]], pieces.ids[near[same]]
        table[word[at], place[at] + length, length] = found
    return table, sizes


def fold(
    table: np.ndarray, sizes: np.ndarray, pieces: Pieces
) -> tuple[np.ndarray, np.ndarray]:
    """The paths of all words' lattices in a row, and where each ends.

    Paths are piece ids; single characters that are no piece have theirs above the piece ids.
    """
    n, ends, longest = table.shape
    last = np.full((n, ends), -1, np.int32)
    taken = np.zeros((n, ends), np.int32)
    for end in range(1, ends):
        lengths = np.arange(1, min(longest - 1, end) + 1)
        piece = table[:, end, lengths]
        before = last[:, end - lengths]
        plain = (before < 0) | (before >= pieces.size) | (piece >= pieces.size)
        starts = (end - lengths == 0)[None, :]
        good = (piece >= 0) & (starts | (before >= 0)) & (starts | plain)
        ask = (piece >= 0) & (before >= 0) & ~starts & ~plain
        row, col = np.nonzero(ask)
        if len(row):
            pairs = before[row, col].astype(np.int64) * pieces.size + piece[row, col]
            good[row, col] = pieces.go_together(pairs)
        score = np.full(piece.shape, -np.inf)
        row, col = np.nonzero(good)
        own = piece[row, col]
        score[row, col] = np.where(
            own < pieces.size, pieces.scores[np.minimum(own, pieces.size - 1)], 0.0
        )
        best = score.argmax(axis=1)
        some = good.any(axis=1)
        every = np.arange(n)
        last[:, end] = np.where(some, piece[every, best], -1)
        taken[:, end] = np.where(some, lengths[best], 0)
    at, rows, found = sizes.copy(), np.arange(n), []
    while True:
        on = at > 0
        if not on.any():
            break
        found.append(np.where(on, last[rows, at], -1))
        at = at - np.where(on, taken[rows, at], 0)
    path = np.stack(found[::-1], axis=1) if found else np.zeros((n, 0), np.int64)
    return path[path >= 0], np.cumsum((path >= 0).sum(axis=1))


class Encoder:
    """Ids of whole texts, word by word; words are kept with their ids as bytes."""

    def __init__(self, path: str) -> None:
        self.pieces = Pieces(path)
        self.known: dict[str, bytes] = {}

    def words(self, text: str) -> list[str]:
        """A space goes with what follows it, runs of spaces stay together, a line end starts a word."""
        if not text:
            return []
        if "  " in text or text[0] == " " or MARK in text:
            marked = (" " + text).replace(MARK, " ")
            out, at = [], 0
            for i in range(1, len(marked)):
                if (marked[i] == " " and marked[i - 1] != " ") or marked[i] == "\n":
                    out.append(marked[at:i])
                    at = i
            return [*out, marked[at:]]
        lines = text.split("\n")
        out = [" " + word for word in lines[0].split(" ")] if lines[0] else [" "]
        for line in lines[1:]:
            words = line.split(" ")
            out.append("\n" + words[0])
            out.extend([" " + word for word in words[1:]])
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        known, out = self.known, []
        split = [self.words(text) for text in texts]
        new = {word for words in split for word in words if word not in known}
        self._learn(sorted(new, key=len))
        for words in split:
            out.append(np.frombuffer(b"".join(map(known.__getitem__, words)), np.uint32))
        if len(known) > KNOWN_WORDS:
            known.clear()
        return out

    def _learn(self, words: list[str]) -> None:
        """Words come by length, so a fold's words are about equally long."""
        at = 0
        while at < len(words):
            stop = at + 1
            while stop < len(words) and (stop - at + 1) * len(words[stop]) <= GROUP:
                stop += 1
            group = [word.replace(" ", MARK) for word in words[at:stop]]
            table, sizes = edges(group, self.pieces)
            path, ends = fold(table, sizes, self.pieces)
            whole = path.astype(np.uint32).tobytes()
            single = np.append(0, np.cumsum(path >= self.pieces.size))
            start = 0
            for word, end in zip(words[at:stop], ends.tolist(), strict=True):
                plain = single[start] == single[end]
                self.known[word] = whole[4 * start : 4 * end] if plain else self._ids(path[start:end])
                start = end
            at = stop

    def _ids(self, path: np.ndarray) -> bytes:
        ids: list[int] = []
        for i in path.tolist():
            if i < self.pieces.size:
                ids.append(i)
            else:
                ids += [self.pieces.of_byte[b] for b in chr(i - self.pieces.size).encode("utf-8")]
        return np.array(ids, np.uint32).tobytes()

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.pieces.out.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encoded(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) per row: the ids of a model file's pieces for each whole text.

    Characters that are no piece become the ids of their UTF-8 bytes. Null and empty texts have no
    ids; a word of any length is one lattice. Rows that repeat and rows without an id are encoded like
    any other. An empty table gives an empty one; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def work(batches):
        for whole in batches:
            for batch in small_batches(whole, "text", BATCH):
                texts = batch.column("text").fill_null("").to_pylist()
                ids = encoder(model).encode(texts)
                first = np.append(0, np.cumsum([len(x) for x in ids]))
                flat = np.concatenate(ids).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), lists(flat, first)], ["doc_id", "ids"]
                )

    return rows.mapInArrow(work, f"doc_id {kind}, ids array<int>")


def decoded(rows: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) per row of ids; null or no ids give an empty text, null ids in a list none.

    Byte pieces are put together to characters; what is no UTF-8 comes out as replacement characters.
    """
    rows = rows.select(
        F.col(id_col).alias("doc_id"),
        F.filter(F.col(ids_col).cast("array<int>"), lambda x: x.isNotNull()).alias("ids"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()

    def work(batches):
        for batch in batches:
            texts = [encoder(model).decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"]
            )

    return rows.mapInArrow(work, f"doc_id {kind}, text string")


def round_trip(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_ids, ids_crc32, same) per row: each text encoded, decoded and held against itself.

    ids_crc32 is of the ids as little-endian 32-bit numbers. `same` is false for a text that holds
    the word mark itself, which decodes to a space. Nulls and odd rows are treated as by `encoded`.
    """
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def work(batches):
        names = ["doc_id", "n_ids", "ids_crc32", "same"]
        for whole in batches:
            for batch in small_batches(whole, "text", BATCH):
                texts = batch.column("text").fill_null("").to_pylist()
                ids = encoder(model).encode(texts)
                same = [
                    encoder(model).decode(x.tolist()) == text
                    for x, text in zip(ids, texts, strict=True)
                ]
                checks = [zlib.crc32(x.astype("<u4").tobytes()) for x in ids]
                columns = [
                    batch.column("doc_id"),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array(checks, pa.int64()),
                    pa.array(same),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(work, f"doc_id {kind}, n_ids bigint, ids_crc32 bigint, same boolean")
