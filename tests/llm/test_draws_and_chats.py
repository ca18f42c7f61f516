"""Centroid clustering, the radix-sorted draw and chat formatting."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from repopulse.llm import chat_grammar, heap_clusters, radix_draw
from repopulse.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


# --- clusters -------------------------------------------------------------------------------------


def brute_clusters(rows, k=8, rounds=10):
    """(assigned number, squared distance) of each whole-number vector, by full scans."""
    seeds = sorted(
        range(len(rows)), key=lambda i: (hashlib.sha256(b"3:%d" % rows[i][0]).hexdigest(), rows[i][1])
    )
    middle = [list(rows[i][1]) for i in seeds[:k]]

    def assign():
        out = []
        for _, x in rows:
            d = [sum((a - b) ** 2 for a, b in zip(x, m, strict=True)) for m in middle]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        where = assign()
        for c in range(len(middle)):
            own = [x for (_, x), (n, _) in zip(rows, where, strict=True) if n == c]
            if own:
                middle[c] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    return assign(), middle


def vectors(spark, rows):
    return spark.createDataFrame(
        [(i, v, "x", 1.5, [1]) for i, v in rows],
        "vec_id bigint, embedding array<double>, cluster string, key double, point array<int>",
    )


@pytest.mark.parametrize("spread", [0.05, 1.0, 900.0])
def test_clusters_equal_full_scans(spark, spread):
    draw = np.random.default_rng(5)
    heads = draw.normal(size=(6, 4))
    rows = [(i, (heads[i % 6] + spread * draw.normal(size=4)).tolist()) for i in range(400)]
    rows += [(1000 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(150)]  # one vector very many times
    settings = heap_clusters.Settings(dims=4)
    found = heap_clusters.clustered(vectors(spark, rows), settings)
    whole = [(i, tuple(math.floor(1024 * x) for x in v)) for i, v in rows]
    want, middle = brute_clusters(whole)
    got = {r.vec_id: (r.cluster, r.distance) for r in found.assigned.collect()}
    assert got == {i: w for (i, _), w in zip(whole, want, strict=True)}
    assert found.centroids == middle
    sums = heap_clusters.with_inertia(found).collect()
    assert {r.inertia for r in sums} == {sum(d for _, d in want)}
    for r in sums:
        assert r.cluster_inertia == sum(d for n, d in want if n == r.cluster)


def test_later_rounds_pop_only_what_may_have_changed(spark):
    draw = np.random.default_rng(9)
    heads = draw.normal(size=(8, 64)) * 5
    rows = [(i, (heads[i % 8] + 0.05 * draw.normal(size=64)).tolist()) for i in range(800)]
    found = heap_clusters.clustered(vectors(spark, rows))
    sizes = [run.count() for run in found.runs]
    assert sizes[0] == 800 and sum(sizes[1:]) < 800 * (len(sizes) - 1) / 2
    assert found.assigned.count() == 800
    # A row enters a run above its cluster's offset, and in the order of the heaps.
    keys = [r.key for r in found.runs[0].collect()]
    assert min(keys) > 0


def test_odd_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, -0.0001]), (1, [1.0, -0.0001]), (None, [3.0, 1e300]), (2, [-1e30, 2.0])]
    odd = [(3, None), (4, [1.0]), (5, [1.0, None]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [1.0, -inf])]
    settings = heap_clusters.Settings(dims=2, clusters=3)
    found = heap_clusters.clustered(vectors(spark, rows + odd), settings)
    got = Counter((r.vec_id, r.distance) for r in found.assigned.collect())
    limit = heap_clusters.LIMIT
    assert set(i for i, _ in got) == {1, 2, None} and sum(got.values()) == 4
    assert [1024, -1] in found.centroids and [-limit, 2048] in found.centroids
    empty = heap_clusters.clustered(vectors(spark, odd), settings)
    assert empty.centroids == [] and heap_clusters.with_inertia(empty).count() == 0
    one = heap_clusters.clustered(vectors(spark, rows[:2]), heap_clusters.Settings(dims=2, clusters=1))
    assert [(r.cluster, r.distance) for r in one.assigned.collect()] == [(0, 0)] * 2


# --- draw -----------------------------------------------------------------------------------------


def plain_features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    pairs = [f"{a} {b}" for a, b in zip(words, words[1:])]
    return words, [zlib.crc32(f.encode()) for f in words + pairs]


TEXTS = [
    "", None, "...", "A b  C", "naïve Über-größe", "x" * 200 + " y " + "z" * 65 + " " + "q" * 64,
    "one", "日本語 テキスト 1", "a\x00b\x7fc", "end ", "next", "w " * 3000 + "ß" * 70_000,
]


def test_checksums_of_all_runs_of_one_and_two_words():
    crc, text = radix_draw.features(radix_draw.words_of(pa.array(TEXTS)))
    for i, plain in enumerate(TEXTS):
        words, want = plain_features(plain)
        assert Counter(crc[text == i].tolist()) == Counter(want)
    crc, text = radix_draw.features(radix_draw.words_of(pa.array([], pa.string())))
    assert len(crc) == len(text) == 0


def brute_draw(rows, target, percent=25, least=20):
    raw, want = Counter(), Counter()
    for _, t in rows:
        raw.update(c % 10_000 for c in plain_features(t)[1])
    for t in target:
        want.update(c % 10_000 for c in plain_features(t)[1])
    s, t = sum(raw.values()), sum(want.values())
    gain = {
        b: math.floor(1000 * math.log((want[b] + 1) * (s + 10_000) / ((raw[b] + 1) * (t + 10_000))))
        for b in raw
    }
    out, eligible = [], []
    for i, text in rows:
        words, found = plain_features(text)
        weight = sum(gain[c % 10_000] for c in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((i, len(found), weight, score))
        if len(words) >= least:
            eligible.append(out[-1])
    order = sorted(eligible, key=lambda r: (-r[3], math.inf if r[0] is None else r[0]))
    drawn = order[: percent * len(eligible) // 100]
    ranked = Counter((*r, n) for n, r in enumerate(drawn, 1))
    rest = Counter(out) - Counter(drawn)
    return ranked + Counter({(*r, None): n for r, n in rest.items()})


@pytest.mark.parametrize("bits", [2, 16])
def test_draw_equals_plain_sort(spark, monkeypatch, bits):
    monkeypatch.setattr(radix_draw, "BLOCK_BITS", bits)
    draw = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)]
    rows = [(i * 977 - 5000, " ".join(draw.choices(vocabulary, k=draw.randint(0, 60)))) for i in range(120)]
    rows += [(7, "w1 " * 30)] * 3 + [(None, "w2 " * 25)] * 2 + [(-1 << 63, "w3 " * 25), ((1 << 63) - 1, "w3 " * 25)]
    rows += [(9000 + i, t) for i, t in enumerate(TEXTS)]
    target = ["w1 w2 w3 w4 w5", None, ""]
    docs = spark.createDataFrame(
        [(i, t, 0, "r", 1.0) for i, t in rows], "doc_id bigint, text string, place int, rank string, weight double"
    )
    goal = spark.createDataFrame([(t, 1) for t in target], "text string, doc_id int")
    found = radix_draw.resampled(docs.repartition(3), goal)
    assert Counter(map(tuple, found.collect())) == brute_draw(rows, target)
    assert radix_draw.resampled(docs.limit(0), goal).count() == 0
    few = radix_draw.resampled(docs.limit(2), goal.limit(0)).collect()
    assert [r.rank for r in few] == [None, None]


def test_ranks_of_whole_numbers_of_any_size(spark, monkeypatch):
    monkeypatch.setattr(radix_draw, "BLOCK_BITS", 3)
    draw = random.Random(1)
    values = [draw.choice([1, -1]) * draw.getrandbits(draw.choice([1, 9, 40, 62])) for _ in range(300)]
    values += [5] * 80
    rows = spark.createDataFrame([(v, i % 3) for i, v in enumerate(values)], "a bigint, b bigint")
    found = radix_draw.radix_ranked(rows, [F.col("b"), F.col("a")]).orderBy("rank").collect()
    assert [(r.b, r.a) for r in found] == sorted((i % 3, v) for i, v in enumerate(values))
    assert [r.rank for r in found] == list(range(1, len(values) + 1))
    same = spark.createDataFrame([(1,)] * 20, "a bigint")
    assert sorted(r.rank for r in radix_draw.radix_ranked(same, [F.col("a")]).collect()) == list(range(1, 21))


# --- chats ----------------------------------------------------------------------------------------

PIECES = [
    "\\", "</turn>", "### ", "###", "#", "\n", ": ", "user", "### assistant: ", " ", "é", "𝄞", "%zz", "+",
    "\n</turn>\n### user: ", "</turn", ">", "$1", "", "x",
]


def chat_rows():
    draw = random.Random(11)
    rows = []
    for conv in range(120):
        for turn in range(draw.randint(1, 6)):
            role = draw.choice(["system", "user", "assistant", "assistant", "", "a: b", "### ", "%41", "é+ü</turn>"])
            text = "".join(draw.choices(PIECES, k=draw.randint(0, 8)))
            rows.append((conv, turn, role, text))
    rows += [(500, t, "user" if t % 2 else "assistant", f"turn {t}") for t in range(-130, 200)]
    rows += [(501, 0, "user", None), (501, 1, None, "x"), (501, 2, "assistant", "y" * 300_000 + "\\" * 100_000)]
    rows += [(502, 0, "assistant", "\\" * 50_000 + "</turn>" * 20_000)]
    return rows


def brute_chats(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted((t, r or "", x or "") for c, t, r, x in rows if c == conv)
        listing = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        learnt = "".join(x for _, r, x in turns if r == "assistant")
        digest = [hashlib.sha256(s.encode()).hexdigest() for s in (listing, learnt)]
        out[conv] = (len(turns), digest[0], len(learnt), digest[1])
    return out


def test_any_conversation_comes_back(spark):
    rows = chat_rows()
    frame = spark.createDataFrame(
        [(*r, "p", [1]) for r in rows],
        "conv_id bigint, turn bigint, role string, text string, part string, loss array<int>",
    )
    parts = chat_grammar.formatted(frame.repartition(3))
    found = chat_grammar.digests(parts).collect()
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in found}
    assert len(found) == len(got) and got == brute_chats(rows)
    texts = {(r.conv_id, r.part): r for r in parts.collect()}
    assert sum(len(r.text) for r in texts.values()) == sum(r.formatted_chars for r in found)
    assert len([k for k in texts if k[0] == 500]) == 7
    for r in texts.values():
        # Bare marks open and close turns, and nothing else.
        bare = re.findall(r"(?<!\\)(?:</turn>|### )", r.text)
        assert bare == ["### ", "</turn>"] * (len(bare) // 2)
        for start, length in r.loss:
            assert r.text[start + length :].startswith("\n</turn>\n") and r.text[start - 2 : start] == ": "


def test_only_what_conflicts_is_escaped(spark):
    rows = [(1, 0, "user", "a \\ b"), (2, 0, "user", "</turn>"), (3, 0, "assistant", "\\### </turn>")]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")
    found = {r.conv_id: r for r in chat_grammar.formatted(frame).collect()}
    assert found[1].text == "### user: a \\ b\n</turn>\n" and found[1].loss == []
    assert found[2].text == "### user: \\</turn>\n</turn>\n"
    assert found[3].text == "### assistant: \\\\### \\</turn>\n</turn>\n"
    assert [tuple(s) for s in found[3].loss] == [(15, 14)]
    bad = ["x", "### user: a", "### user a\n</turn>\n", "### user: ### \n</turn>\n", "### u: a\n</turn>"]
    texts = spark.createDataFrame([(t,) for t in bad], "text string")
    assert [r[0] for r in texts.select(chat_grammar.parsed(F.col("text"))).collect()] == [None] * len(bad)
    empty = chat_grammar.digests(chat_grammar.formatted(frame.limit(0)))
    assert empty.count() == 0


def test_ties_repeats_and_missing_ids(spark):
    rows = [(None, None, "user", "a"), (None, 1, "assistant", "b"), (4, 1, "user", "d"), (4, 1, "user", "c"), (4, 1, "user", "c")]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    found = {r.conv_id: r for r in chat_grammar.digests(chat_grammar.formatted(frame)).collect()}
    listing = {None: "user\na\nassistant\nb\n", 4: "user\nc\nuser\nc\nuser\nd\n"}
    for conv, text in listing.items():
        assert found[conv].turns_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_chats_stay_native(spark):
    found = QUERIES["op13_chat_formatting"](spark, SMALL)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|BatchEval", plan)
    row = found.where("conv_id = -7").first()
    text = "\\### Assistant: </turn> ok"
    assert row.n_turns == 2 and row.loss_chars == len(text)
    assert row.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
