"""Plain models of the operators, for small inputs."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from difflib import SequenceMatcher

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(LOWER))


def shingle_set(text: str | None, size: int) -> frozenset:
    w = words(text)
    if len(w) >= size:
        return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    return frozenset([tuple(w)] if w else [])


def groups(rows: list[tuple[int, str | None]], size: int, percent: int) -> dict[int, int]:
    """Smallest id reachable by links, of every id."""
    sets = {i: shingle_set(t, size) for i, t in rows}
    holders = defaultdict(list)
    for i, s in sets.items():
        for gram in s:
            holders[gram].append(i)
    top = {i: i for i in sets}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i, s in sets.items():
        for j, n in Counter(j for gram in s for j in holders[gram] if j > i).items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                top[b] = a
    return {i: find(i) for i in sets}


def repeated_words(rows: list[tuple[int, str | None]], length: int) -> dict[int, list[bool]]:
    """Which words of a text lie in a run of `length` words that an earlier text has too."""
    first: dict[tuple, int] = {}
    out = {}
    for i, text in sorted(rows):
        w = words(text)
        hit = [False] * len(w)
        for at in range(len(w) - length + 1):
            run = tuple(w[at : at + length])
            if first.setdefault(run, i) != i:
                hit[at : at + length] = [True] * length
        out[i] = hit
    return out


def best_match(i: int, texts: dict[int, str | None]) -> float:
    """The share of a text's words that lie, in order, in the earlier text most like it."""
    own, grams = words(texts[i]), shingle_set(texts[i], 6)
    best = 0.0
    for j, text in texts.items():
        if j < i and grams & shingle_set(text, 6):
            found = SequenceMatcher(None, own, words(text), autojunk=False)
            best = max(best, sum(m.size for m in found.get_matching_blocks()) / len(own))
    return best
