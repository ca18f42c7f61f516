"""Chat formatting by a grammar whose output is read back before it is accepted.

    text := turn*
    turn := "### " role ": " body newline "</turn>" newline

Control strings are `</turn>` and `### `. Inside a body, a control string with a backslash before it
is text, and stands for itself with one backslash less; a role is URL-encoded, so it holds neither a
colon nor a space. The parser follows these rules alone: it parts the text at bare `</turn>`, asks for
exactly one bare `### ` in a turn, at its start, and turns the rest back. What does not follow the
grammar has no turns at all.

A conversation is rendered as it is and parsed. If the turns found are not the source's, the texts
that conflict are escaped, first `</turn>`, then `### ` as well, and parsed again, until both are
identical. Everything is made of DataFrame functions; every pattern takes linear time and no recursion.

Long conversations are formatted in parts of 64 turn numbers, so that no task gathers one whole.
Rows that share a turn number share a part.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repopulse.functions.once import with_once

HEAD, MIDDLE, END = "### ", ": ", "</turn>"
PART_BITS = 6  # a part holds the turns of 64 numbers in a row
#: What each round escapes, as a pattern.
ROUNDS = ("", END, f"{END}|{HEAD}")


def escaped(text: Column, controls: str) -> Column:
    """One more backslash before every control string that the pattern names."""
    if not controls:
        return text
    some = reduce(or_, [F.contains(text, F.lit(c)) for c in controls.split("|")])
    more = F.regexp_replace(text, rf"(?<!\\)(\\*+)({controls})", r"\\$1$2")
    return F.when(some, more).otherwise(text)


def unescaped(body: Column) -> Column:
    """One backslash less before every control string that has any."""
    less = F.regexp_replace(body, rf"(?<!\\)\\(\\*+)({ROUNDS[-1]})", "$1$2")
    return F.when(F.contains(body, F.lit("\\")), less).otherwise(body)


def _heading(turn: Column) -> Column:
    return F.concat(F.lit(HEAD), F.url_encode(turn["role"]), F.lit(MIDDLE))


def _closing() -> Column:
    return F.lit(f"\n{END}\n")


def rendered(turns: Column, controls: str) -> Column:
    """The text of a list of turns, control strings of the pattern escaped."""
    return F.array_join(
        F.transform(
            turns, lambda t: F.concat(_heading(t), escaped(t["text"], controls), _closing())
        ),
        "",
    )


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """An expression of a value that is computed once, however often the expression names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _pieces(text: Column) -> Column:
    return F.split(text, rf"(?<!\\){END}", -1)


def parsed(text: Column) -> Column:
    """The turns (role, text) of a formatted text; null if it doesn't follow the grammar."""

    def follows(piece: Column, i: Column) -> Column:
        """Whether a piece is a turn. All but the first begin with the newline behind the one before."""
        start = F.when(i == 0, F.lit(HEAD)).otherwise(F.lit(f"\n{HEAD}"))
        heads = F.size(F.split(piece, rf"(?<!\\){HEAD}", -1)) - 1
        framed = F.startswith(piece, start) & F.endswith(piece, F.lit("\n"))
        return framed & (F.instr(piece, MIDDLE) > 0) & (heads == 1)

    def turn_of(piece: Column, i: Column) -> Column:
        begin = F.when(i == 0, len(HEAD) + 1).otherwise(len(HEAD) + 2)

        def parts(colon: Column) -> Column:
            rest = colon + len(MIDDLE)
            return F.struct(
                F.try_url_decode(F.substring(piece, begin, colon - begin)).alias("role"),
                unescaped(F.substring(piece, rest, F.length(piece) - rest)).alias("text"),
            )

        return _with(F.instr(piece, MIDDLE), parts)

    def turns(pieces: Column) -> Column:
        """All pieces but the last are turns; behind the last turn there is one newline."""
        last = F.when(F.size(pieces) == 1, F.lit("")).otherwise(F.lit("\n"))
        some = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
        whole = (F.element_at(pieces, -1) == last) & F.forall(
            F.transform(some, follows), lambda good: good
        )
        return F.when(whole, F.transform(some, turn_of))

    return _with(_pieces(text), turns)


def _until_identical(turns: Column) -> Column:
    """The least escaped rendering that parses to the turns; an error if there is none."""

    def checked(controls: str) -> Column:
        return _with(
            rendered(turns, controls),
            lambda attempt: F.when(parsed(attempt).eqNullSafe(turns), attempt),
        )

    never = F.raise_error(F.lit("turns do not come back from their formatted text"))
    return F.coalesce(*[checked(controls) for controls in ROUNDS], never)


def loss_spans(turns: Column, text: Column, roles: tuple[str, ...]) -> Column:
    """(start, length) of the escaped bodies, in code points, of the turns that are to be learnt.

    Lengths are taken from the formatted text itself: its turns part at the bare end marks.
    """
    spans = "array<struct<start:int,length:int>>"

    def sized(pieces: Column) -> Column:
        return F.transform(
            F.slice(pieces, F.lit(1), F.size(pieces) - 1),
            # Behind the first turn a piece begins with the newline of the turn before.
            lambda p, i: F.length(p) - F.when(i == 0, 0).otherwise(1),
        )

    both = F.zip_with(
        turns,
        _with(_pieces(text), sized),
        lambda t, size: F.struct(
            t["role"].isin(*roles).alias("learn"), F.length(_heading(t)).alias("head"), size.alias("size")
        ),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast(spans).alias("found"))

    def step(seen: Column, s: Column) -> Column:
        span = F.struct(
            (seen["at"] + s["head"]).alias("start"), (s["size"] - s["head"] - 1).alias("length")
        )
        more = F.when(s["learn"], F.array(span)).otherwise(F.array().cast(spans))
        after = seen["at"] + s["size"] + len(END) + 1
        return F.struct(after.alias("at"), F.concat(seen["found"], more).alias("found"))

    return F.aggregate(both, start, step)["found"]


def masked(text: Column, spans: Column) -> Column:
    """What stands under a loss mask, unescaped, nothing between."""
    return F.array_join(
        F.transform(spans, lambda s: unescaped(F.substring(text, s["start"] + 1, s["length"]))), ""
    )


def formatted(turns: DataFrame, learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """(conv_id, part, text, loss) of conversations (conv_id, turn, role, text).

    The text of a conversation is that of its parts in order; `loss` are the spans of a part's text
    that are to be learnt, those of `learn` turns. Turns stand by (turn, role, text), so repeated
    rows and ties come out side by side and a null turn first; a null role or text counts as empty,
    and rows without a conv_id are one conversation. Any text comes back, whatever control strings
    and backslashes it holds. Empty tables give empty ones; other columns are ignored.
    """
    rows = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.shiftright(F.col("turn").cast("bigint"), PART_BITS).alias("part"),
        F.struct(
            F.col("turn").cast("bigint").alias("turn"),
            F.coalesce(F.col("role"), F.lit("")).alias("role"),
            F.coalesce(F.col("text"), F.lit("")).alias("text"),
        ).alias("row"),
    )
    parts = rows.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    plain = F.transform("rows", lambda r: F.struct(r["role"].alias("role"), r["text"].alias("text")))
    parts = with_once(parts.select("conv_id", "part", "rows"), turns=plain)
    parts = with_once(parts.drop("rows"), text=_until_identical(F.col("turns")))
    spans = loss_spans(F.col("turns"), F.col("text"), learn)
    return parts.select("conv_id", "part", "text", spans.alias("loss"))


def digests(parts: DataFrame) -> DataFrame:
    """One row per conversation, read back from its formatted parts.

    A digest is taken of one whole value, so here, and only here, the parts of a conversation meet.
    """
    back = with_once(parts, turns=parsed(F.col("text")))
    listing = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    back = back.select(
        "conv_id",
        F.struct(
            "part",
            F.size("turns").cast("bigint").alias("n"),
            F.length("text").cast("bigint").alias("chars"),
            listing.alias("listing"),
            masked(F.col("text"), F.col("loss")).alias("learnt"),
        ).alias("piece"),
    )
    whole = back.groupBy("conv_id").agg(F.sort_array(F.collect_list("piece")).alias("pieces"))

    def total(field: str) -> Column:
        return F.aggregate("pieces", F.lit(0).cast("bigint"), lambda a, p: a + p[field])

    def text(field: str) -> Column:
        return F.array_join(F.transform("pieces", lambda p: p[field]), "")

    return whole.select(
        "conv_id",
        total("n").alias("n_turns"),
        F.sha2(text("listing"), 256).alias("turns_sha256"),
        F.length(text("learnt")).cast("bigint").alias("loss_chars"),
        F.sha2(text("learnt"), 256).alias("loss_sha256"),
        total("chars").alias("formatted_chars"),
    )
