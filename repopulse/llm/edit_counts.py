"""Token counts that follow edits, by a segment tree over each document's pre-tokens.

A leaf is a pre-token run: white space and the word behind it, which the tokenizer's own pattern cuts
further but never joins to the next. Inner nodes hold the characters and tokens below them. An edit
finds its leaves by character sums, encodes only their changed text with one leaf of context on
either side, and updates the sums on the paths above; the rest of the document is not looked at.
"""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repopulse.llm.grams import small_batches

KNOWN_RUNS = 300_000
# White space by the Unicode property that the tokenizer's pattern goes by.
_SPACE = r"\t-\r \x85\xa0  -     　"
_RUN = re.compile(rf"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")


class Counter:
    """Tokens of a pre-token run, kept by its text; a full store is emptied."""

    def __init__(self, ranks_file: str, pattern: str) -> None:
        import tiktoken

        with open(ranks_file, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        self.known: dict[str, int] = {}

    def counts(self, runs: list[str]) -> list[int]:
        known = self.known
        try:
            return [known[run] for run in runs]
        except KeyError:
            if len(known) > KNOWN_RUNS:
                known.clear()
            for run in set(runs):
                if run not in known:
                    known[run] = len(self.encoding.encode_ordinary(run))
            return [known[run] for run in runs]


class CountTree:
    """Sums of characters and tokens over the leaves of one text; leaf i is node `width` + i."""

    def __init__(self, text: str, counter: Counter) -> None:
        self.counter = counter
        self.leaves = _RUN.findall(text)
        self.width = 1 << max(0, (len(self.leaves) - 1).bit_length())
        self.encoded = len(self.leaves)
        self.chars = self._sums([len(leaf) for leaf in self.leaves])
        self.tokens = self._sums(counter.counts(self.leaves))

    def _sums(self, values: list[int]) -> list[int]:
        level = np.zeros(self.width, np.int64)
        level[: len(values)] = values
        levels = [level]
        while len(level) > 1:
            level = level[::2] + level[1::2]
            levels.append(level)
        return np.concatenate([np.zeros(1, np.int64), *levels[::-1]]).tolist()

    @property
    def total(self) -> int:
        return self.tokens[1]

    @property
    def length(self) -> int:
        return self.chars[1]

    def text(self) -> str:
        return "".join(self.leaves)

    def _leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds a character and where the leaf begins; the last one for the end."""
        node, begin = 1, 0
        while node < self.width:
            node *= 2
            left = self.chars[node]
            if place - begin >= left:
                begin += left
                node += 1
        return node - self.width, begin

    def _put(self, leaf: int, text: str) -> None:
        """Another text for a leaf, which may by now be several runs, and new sums above it."""
        runs = _RUN.findall(text)
        self.encoded += len(runs)
        self.leaves[leaf] = text
        node = leaf + self.width
        chars = len(text) - self.chars[node]
        tokens = sum(self.counter.counts(runs)) - self.tokens[node]
        while node:
            self.chars[node] += chars
            self.tokens[node] += tokens
            node //= 2

    def _beside(self, leaf: int, step: int) -> int | None:
        """The next leaf with any text before or behind one."""
        leaf += step
        while 0 <= leaf < len(self.leaves):
            if self.leaves[leaf]:
                return leaf
            leaf += step
        return None

    def replace(self, start: int, stop: int, text: str) -> None:
        """Put `text` for the characters [start, stop), both limited to the text's length.

        The changed leaves and one of context on either side become one leaf, the first of them.
        """
        start = min(max(start, 0), self.length)
        stop = min(max(stop, start), self.length)
        if not self.leaves:
            self.leaves = [""]
        if self.length == 0:
            self._put(0, text)
            return
        first, begin = self._leaf_at(min(start, self.length - 1))
        last, _ = self._leaf_at(min(max(stop - 1, start), self.length - 1))
        before, behind = self._beside(first, -1), self._beside(last, 1)
        if before is not None:
            begin -= len(self.leaves[before])
            first = before
        if behind is not None:
            last = behind
        joined = "".join(self.leaves[first : last + 1])
        joined = joined[: start - begin] + text + joined[stop - begin :]
        for leaf in range(first + 1, last + 1):
            if self.leaves[leaf]:
                self._put(leaf, "")
        self._put(first, joined)


_counters: dict[str, Counter] = {}


def counter(ranks_file: str, pattern: str) -> Counter:
    if ranks_file not in _counters:
        _counters[ranks_file] = Counter(ranks_file, pattern)
    return _counters[ranks_file]


def counted_edits(
    docs: DataFrame, edits: Column, ranks_file: str, pattern: str, id_col: str = "doc_id"
) -> DataFrame:
    """Token counts of each text before and after its edits.

    `edits` is an array of (start, stop, text), places in code points of the text as the edits before
    have left it, applied in order. Columns: doc_id, n_tokens, runs (leaves of the tree),
    edited_tokens, edited_chars, encoded_again (runs the edits had to encode), edited_text.

    Null texts count as empty, null edits as none; an edit with a null place is passed over, a null
    text puts nothing in. Places beyond the end mean the end. Rows that repeat and rows without an id
    are counted like any other. An empty table gives an empty one; other columns are ignored.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        edits.cast("array<struct<start:bigint,stop:bigint,text:string>>").alias("edits"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()

    def work(batches):
        names = "n_tokens runs edited_tokens edited_chars encoded_again edited_text".split()
        for whole in batches:
            for batch in small_batches(whole, "text"):
                found: list[list] = [[] for _ in names]
                count = counter(ranks_file, pattern)
                texts, changes = (batch.column(c).to_pylist() for c in ("text", "edits"))
                for text, some in zip(texts, changes, strict=True):
                    tree = CountTree(text, count)
                    before, runs = tree.total, tree.encoded
                    for edit in some or ():
                        if edit and edit["start"] is not None and edit["stop"] is not None:
                            tree.replace(edit["start"], edit["stop"], edit["text"] or "")
                    values = (before, runs, tree.total, tree.length, tree.encoded - runs, tree.text())
                    for column, value in zip(found, values, strict=True):
                        column.append(value)
                arrays = [pa.array(c, pa.int64()) for c in found[:-1]]
                arrays.append(pa.array(found[-1], pa.string()))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], ["doc_id", *names])

    return rows.mapInArrow(
        work,
        f"doc_id {kind}, n_tokens bigint, runs bigint, edited_tokens bigint, edited_chars bigint, "
        "encoded_again bigint, edited_text string",
    )
