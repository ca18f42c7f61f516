from __future__ import annotations

import hashlib
import pathlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from repopulse.llm import (
    chaining,
    edit_counts,
    grams,
    importance,
    jaccard_tiles,
    piece_lattice,
    retrieval_packing,
    store,
    winnowing,
)
from repopulse.session import shared_dir
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one"),
    (5, "ONE"),
    (6, "é☃ \x0b日本 x" * 3),
    (7, "word " * 1500),
    (8, "x" * 9_000),
    (9, None),
    (None, "no id at all here"),
    (10, "same row"),
    (10, "same row"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").cache()


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, long and repeated rows, with columns that clash with the operators' own."""
    rows = [(i, t, "x", 1, 2, "k", 0, 5.0) for i, t in ODD]
    schema = (
        "doc_id bigint, text string, lang string, n bigint, size bigint, key string, shard int, "
        "weight double"
    )
    return spark.createDataFrame(rows, schema)


def random_texts(seed: int, n: int) -> list[tuple[int, str]]:
    """Texts over few words, with edited copies, so that many are near the threshold."""
    draw = random.Random(seed)
    texts: list[list[str]] = []
    for _ in range(n):
        if texts and draw.random() < 0.6:
            words = list(draw.choice(texts))
            for _ in range(draw.randint(0, 4)):
                at = draw.randrange(len(words))
                words[at : at + draw.randint(0, 1)] = [f"w{draw.randint(0, 400)}"]
                words = words or ["w"]
        else:
            words = [f"w{draw.randint(0, 400)}" for _ in range(draw.choice([1, 3, 5, 8, 20, 60, 90]))]
        texts.append(words)
    return [(i, " ".join(words)) for i, words in enumerate(texts)]


def test_words_and_hashes_do_not_depend_on_the_batch():
    texts = ["A b\x0bC", None, "  x ", "", "zé ZÉ", "b"]
    together = grams.words_of(pa.array(texts))
    alone = [grams.words_of(pa.array([t], pa.string())).hashes for t in texts]
    assert together.counts.tolist() == [len(brute.words(t)) for t in texts]
    assert together.hashes.tolist() == np.concatenate(alone).tolist()
    assert len(set(together.hashes.tolist())) == 6


@pytest.mark.parametrize("size,percent", [(4, 85), (2, 70)])
def test_jaccard_groups_lose_no_link(spark, size, percent):
    rows = random_texts(size, 250)
    found = jaccard_tiles.jaccard_groups(
        spark.createDataFrame(rows, "doc_id bigint, text string"), size, percent
    )
    want = brute.groups(rows, size, percent)
    assert {r.doc_id: r.component_id for r in found.collect()} == want
    assert {r.doc_id: r.n_shingles for r in found.collect()} == {
        i: len(brute.shingle_set(t, size)) for i, t in rows
    }


def test_jaccard_tiles_larger_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(jaccard_tiles, "TILE_SIDE", 20)
    rows = random_texts(9, 120)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = jaccard_tiles.jaccard_groups(frame, 3, 75)
    assert {r.doc_id: r.component_id for r in found.collect()} == brute.groups(rows, 3, 75)


def test_jaccard_leaves_no_tables_of_sets_and_keys_behind(spark):
    frame = spark.createDataFrame(
        [(i, " ".join(f"w{i // 3}_{j}" for j in range(60 - i % 3))) for i in range(60)],
        "doc_id bigint, text string",
    )
    folder = pathlib.Path(shared_dir(spark)) / "llm"
    before = set(folder.glob("*"))
    found = jaccard_tiles.jaccard_groups(frame, 4, 80)
    left = {c for p in set(folder.glob("*")) - before for c in spark.read.parquet(str(p)).columns}
    assert not left & {"keys", "shingles", "bits", "wide"}
    assert {r.component_id for r in found.collect()} == set(range(0, 60, 3))


def test_jaccard_rivals_of_many_shingles_are_sifted_without_loss(spark):
    draw = random.Random(12)
    fresh = lambda n: [f"w{draw.randint(0, 10**6)}" for _ in range(n)]
    start, rows = fresh(3000), []
    for i in range(8):  # half of the words are their own, or few, or a part is left out
        rows.append((i, start[:1500] + fresh(1500)))
        rows.append((10 + i, start[: 2950 - 60 * i] + fresh(40 * i)))
        rows.append((20 + i, start[i : 60 + 30 * i] + fresh(3 * i)))
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id bigint, text string")
    sets = jaccard_tiles._with_sets(frame, 4)
    held = {i: brute.shingle_set(" ".join(w), 4) for i, w in rows}
    pairs = [(a, b) for a in held for b in held if a < b]
    links = {
        (a, b)
        for a, b in pairs
        if 100 * len(held[a] & held[b]) >= 85 * len(held[a] | held[b])
    }
    n = {i: len(s) for i, s in held.items()}
    near = [(a, b) for a, b in pairs if 100 * min(n[a], n[b]) >= 85 * max(n[a], n[b])]
    found = jaccard_tiles._sifted(spark.createDataFrame(near, "a bigint, b bigint"), sets, 85)
    found = {tuple(r) for r in found.collect()}
    assert links and links <= found and len(found) <= len(links) + 5
    assert len(near) > len(found) + 20


def test_jaccard_odd_rows(odd, rows):
    found = rows(jaccard_tiles.jaccard_groups(odd, 4, 85), "doc_id", "component_id")
    assert found == sorted(
        [(i, 4 if i == 5 else i) for i, _ in ODD], key=repr
    )
    assert rows(jaccard_tiles.jaccard_groups(odd.limit(0))) == []


def test_jaccard_rows_that_share_an_id(spark):
    rows = [(1, "a b c d e f"), (2, "p q r s t u"), (2, "a b c d e f"), (3, "p q r s t u")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = jaccard_tiles.jaccard_groups(frame)
    assert {r.component_id for r in found.collect()} == {1} and found.count() == 4


def winnowed(text: str, k: int, window: int) -> list[tuple[int, int]]:
    if not text:
        return []
    units = np.array([ord(c) for c in text], np.uint64)
    at = np.arange(max(len(text) - k + 1, 1))
    hashes = grams.span_hashes(units, at, np.minimum(at + k, len(text))) >> np.uint64(32)
    out = []
    for start in range(max(len(hashes) - window + 1, 1)):
        part = hashes[start : start + window].tolist()
        best = len(part) - 1 - part[::-1].index(min(part))
        if not out or out[-1] != (part[best], start + best):
            out.append((part[best], start + best))
    return out


def test_winnowing_keeps_the_rightmost_least_hash_of_each_window():
    texts = ["ab" * 60, "", None, "x", "mississippi" * 9, "é日☃" * 40]
    for k, window in ((3, 4), (5, 9), (24, 77), (2, 1)):
        hashes, places, first, sizes = winnowing.winnow(pa.array(texts), k, window)
        assert sizes.tolist() == [len(t or "") for t in texts]
        for i, text in enumerate(texts):
            part = slice(first[i], first[i + 1])
            found = list(zip(hashes[part].tolist(), places[part].tolist(), strict=True))
            assert found == winnowed(text or "", k, window)


def test_winnowing_guarantee():
    draw = random.Random(3)
    shared = "".join(draw.choices("abcdef", k=winnowing.K + winnowing.WINDOW - 1))
    a, b = ("".join(draw.choices("ghijk", k=150)) for _ in range(2))
    hashes, _, first, _ = winnowing.winnow(pa.array([a + shared, shared + b]))
    assert set(hashes[: first[1]].tolist()) & set(hashes[first[1] :].tolist())


def test_compared_with_next(spark, odd, docs):
    for frame in (docs.select("doc_id", "text"), odd, odd.where("doc_id = 7")):
        rows = [(r.doc_id, r.text or "") for r in frame.collect()]
        rows.sort(key=lambda r: (-(r[0] if r[0] is not None else -(2**63)), r[1]))
        want = []
        for i, (name, text) in enumerate(rows):
            after = rows[(i + 1) % len(rows)][1]
            cut = len(text) // 3
            edited = text[: len(text) - cut] + after[:cut]
            sets = [
                {h for h, _ in winnowed(t, winnowing.K, winnowing.WINDOW)}
                for t in (text, edited, after)
            ]
            near = [len(sets[0] & s) / len(sets[0] | s) if sets[0] | s else 1.0 for s in sets[1:]]
            digest = hashlib.sha256(edited.encode()).hexdigest()
            marks = winnowed(text, winnowing.K, winnowing.WINDOW)
            want.append((name, len(text), digest, "".join(f"{h:08x}" for h, _ in marks), *near))
        found = winnowing.compared_with_next(frame).select(
            "doc_id", "n_chars", "edited_sha256", "fingerprint", "near_edited", "near_next"
        )
        assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)
    assert winnowing.compared_with_next(odd.limit(0)).count() == 0
    assert winnowing.fingerprints(odd).count() == len(ODD)


def test_quality_on_held_out_labels(spark, docs, odd):
    labels = spark.read.parquet(f"{SMALL.replace('0.001', '0.01')}/labels.parquet")
    more = spark.read.parquet(f"{SMALL.replace('0.001', '0.01')}/documents.parquet")
    half = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(2))
    judged = importance.judged(more, labels.where(half == 0))
    seen = judged.join(labels.where(half == 1), "doc_id").select("kept", "quality").collect()
    right = sum(r.kept == (r.quality == 1) for r in seen) / len(seen)
    good = [r.kept for r in seen if r.quality == 1]
    assert right > 0.95 and sum(good) / len(good) > 0.97
    kept = importance.resampled(more, labels.where(half == 0))
    assert kept.columns == more.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(
        r.doc_id for r in judged.where("kept").collect()
    )
    assert importance.judged(odd, labels).count() == len(ODD)
    assert importance.resampled(odd, labels.limit(0)).count() == len(ODD)
    assert importance.judged(docs.limit(0), labels).count() == 0
    nulls = spark.createDataFrame([(None, 1, 0), (3, None, 0)], labels.schema)
    assert importance.judged(odd, nulls).where("kept").count() == len(ODD)


def test_kth_largest(spark):
    values = [random.Random(5).randint(-(10**9), 10**9) for _ in range(500)] + [7] * 40
    frame = spark.createDataFrame([(v,) for v in values], "v bigint")
    ordered = sorted(values, reverse=True)
    for k in (1, 2, 250, 270, 540):
        assert importance.kth_largest(frame, "v", k, bins=16) == ordered[k - 1]


def test_passages_cover_repeats_and_spare_the_rest(spark):
    draw = random.Random(4)
    fresh = lambda n: [f"v{draw.randint(0, 50_000)}" for _ in range(n)]
    passage, short = fresh(70), fresh(30)
    fuzzy = list(passage)
    fuzzy[30:31] = ["changed", "twice"]
    parts = [
        fresh(40) + passage + fresh(40),
        fresh(10) + passage + fresh(90),
        fresh(60) + short + fresh(5),
        short + fresh(80),
        fresh(25) + fuzzy + fresh(30),
        passage,
        fresh(200),
    ]
    rows = [(10 + i, " ".join(p)) for i, p in enumerate(parts)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = chaining.passages(frame)
    spans = {r.doc_id: r.spans for r in chaining.merged(found).collect()}
    assert set(spans) == {11, 14, 15}
    assert [(s.start, s.stop) for s in spans[11]] == [(10, 80)]
    assert [(s.start, s.stop) for s in spans[14]] == [(25, 96)]
    assert {r.source_id for r in found.collect()} == {10}
    left = {r.doc_id: r.text.split() for r in chaining.without_passages(frame, found).collect()}
    assert 15 not in left and left[10] == parts[0] and left[16] == parts[6]
    assert left[11] == parts[1][:10] + parts[1][80:]
    assert left[14] == parts[4][:25] + parts[4][96:]


def test_passages_find_every_exact_repeat(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = chaining.passages(docs)
    spans = {r.doc_id: r.spans for r in chaining.merged(found).collect()}
    for i, hit in brute.repeated_words(rows, 50).items():
        covered = {w for s in spans.get(i, ()) for w in range(s.start, s.stop)}
        assert {w for w, h in enumerate(hit) if h} <= covered


def test_passages_on_both_sides_of_foreign_words(spark):
    draw = random.Random(11)
    fresh = lambda n: [f"v{draw.randint(0, 50_000)}" for _ in range(n)]
    copy, one, two, long, footer = fresh(400), fresh(60), fresh(60), fresh(900), fresh(25)
    parts = [
        copy,
        fresh(15) + one + fresh(35) + two + fresh(20),
        long + fresh(60) + footer,
        fresh(10) + copy[:300] + fresh(220) + copy[300:],
        one + fresh(35) + two,
        long + fresh(150) + footer,
    ]
    rows = [(i, " ".join(p)) for i, p in enumerate(parts)]
    found = chaining.passages(spark.createDataFrame(rows, "doc_id bigint, text string"))
    spans = {r.doc_id: [tuple(s) for s in r.spans] for r in chaining.merged(found).collect()}
    assert spans == {3: [(10, 310), (530, 630)], 4: [(0, 60), (95, 155)], 5: [(0, 900)]}
    sources = {(r.doc_id, r.start, r.source_start, r.source_stop) for r in found.collect()}
    assert {(3, 10, 0, 300), (3, 530, 300, 400), (4, 95, 110, 170)} <= sources


def test_passages_with_many_edits(spark):
    draw = random.Random(3)
    fresh = lambda n: [f"v{draw.randint(0, 20_000)}" for _ in range(n)]

    def edited(words: list[str], rate: float) -> list[str]:
        out = []
        for word in words:
            kind = draw.random() if draw.random() < rate else 1.0
            out += fresh(1) if kind < 0.6 else [] if kind < 0.8 else [word]
            out += fresh(1) if 0.8 <= kind < 1.0 else []
        return out

    rows, planted = [], {}
    for i in range(160):
        rate = (0.05, 0.1, 0.15, 0.2)[i % 4]
        passage = fresh(draw.randint(56, 80))
        repeat = edited(passage, rate)
        rows.append((i, " ".join(fresh(40) + passage + fresh(40))))
        rows.append((1000 + i, " ".join(fresh(40) + repeat + fresh(40))))
        if len(repeat) >= 50:
            planted.setdefault(rate, {})[1000 + i] = (40, 40 + len(repeat))
    passage = fresh(60)
    sixth = [*passage]
    sixth[5::6] = fresh(10)
    rows += [(500, " ".join(passage)), (2000, " ".join(fresh(30) + sixth + fresh(30)))]
    found = chaining.passages(spark.createDataFrame(rows, "doc_id bigint, text string"))
    spans = {r.doc_id: r.spans for r in chaining.merged(found).collect()}
    assert [(s.start, s.stop) for s in spans.pop(2000)] == [(30, 89)]
    for rate, least in ((0.05, 0.97), (0.1, 0.95), (0.15, 0.85), (0.2, 0.6)):
        covered = sum(
            max(0, min(s.stop, stop) - max(s.start, start))
            for i, (start, stop) in planted[rate].items()
            for s in spans.get(i, ())
        )
        assert covered >= least * sum(stop - start for start, stop in planted[rate].values()), rate
    assert min(spans) >= 1000


def test_passages_whose_seeds_were_first_seen_apart(spark):
    draw = random.Random(8)
    fresh = lambda n: [f"v{draw.randint(0, 50_000)}" for _ in range(n)]
    passage, lines = fresh(54), [fresh(18) for _ in range(3)]
    parts = {i: fresh(30) + passage[3 * i : 3 * i + 18] + fresh(30) for i in range(13)}
    parts |= {20 + i: fresh(30) + line + fresh(30) for i, line in enumerate(lines)}
    for i in (50, 60, 70):
        parts[i] = fresh(20) + passage + fresh(50) + sum(lines, []) + fresh(10 + i)
    frame = spark.createDataFrame(
        [(i, " ".join(p)) for i, p in parts.items()], "doc_id bigint, text string"
    )
    found = chaining.passages(frame)
    spans = {r.doc_id: [tuple(s) for s in r.spans] for r in chaining.merged(found).collect()}
    assert spans == {60: [(20, 74), (124, 178)], 70: [(20, 74), (124, 178)]}
    assert {r.source_id for r in found.where("matched >= 50").collect()} == {50}


def test_edited_passages_whose_seeds_were_all_first_seen_elsewhere(spark, monkeypatch):
    draw = random.Random(11)
    fresh = lambda n: [f"u{draw.randint(0, 50_000)}" for _ in range(n)]
    passage = fresh(72)
    edited = [*passage]
    edited[11::12] = fresh(6)
    # Each run of 11 words that stays lies in a document of its own first, then the passage in one.
    parts = {i: fresh(30) + passage[12 * i : 12 * i + 11] + fresh(30) for i in range(6)}
    parts |= {50: fresh(20) + passage + fresh(20), 55: fresh(20) + passage + fresh(25)}
    parts |= {60: fresh(40) + edited + fresh(40)}
    rows = [(i, " ".join(p)) for i, p in parts.items()]
    assert chaining._sides(0, 9) == 0 and chaining._sides(9.0 * chaining.LEAST_BLOCK, 9) == 3
    for sides, tables in ((1, 64), (2, 1)):  # in one block, and in four
        monkeypatch.setattr(chaining, "_sides", lambda pairs, places, n=sides: n)
        monkeypatch.setattr(chaining, "TABLES", tables)
        found = chaining.passages(spark.createDataFrame(rows, "doc_id bigint, text string"))
        spans = {r.doc_id: [tuple(s) for s in r.spans] for r in chaining.merged(found).collect()}
        assert spans == {55: [(20, 92)], 60: [(40, 111)]}
        assert found.where("doc_id = 60").agg(F.min("source_id")).first()[0] == 50


def test_a_common_line_does_not_pair_all_documents_that_have_it(spark, monkeypatch):
    draw = random.Random(5)
    fresh = lambda n: [f"c{draw.randint(0, 10**6)}" for _ in range(n)]
    line, passage = fresh(14), fresh(60)
    edited = [*passage]
    edited[5::6] = fresh(10)
    parts = {i: fresh(60) + line + fresh(60) for i in range(150)}
    # Each run of words that stays is first seen in a document of its own, together with the line.
    parts |= {i: parts[i] + passage[6 * i : 6 * i + 5] + fresh(50) for i in range(10)}
    parts |= {200: fresh(9) + passage + line + fresh(9), 300: fresh(40) + edited + line + fresh(40)}
    held, sides = [], chaining._sides
    monkeypatch.setattr(chaining, "_sides", lambda pairs, n: held.append(pairs) or sides(pairs, n))
    monkeypatch.setattr(chaining, "PLACES", 40)
    rows = [(i, " ".join(p)) for i, p in parts.items()]
    found = chaining.passages(spark.createDataFrame(rows, "doc_id bigint, text string"))
    spans = {r.doc_id: [tuple(s) for s in r.spans] for r in chaining.merged(found).collect()}
    assert spans == {300: [(40, 114)]} and held[0] < 300


def test_runs_of_one_word_are_covered_by_later_holders(spark):
    draw = random.Random(6)
    fresh = lambda n: [f"r{draw.randint(0, 10**6)}" for _ in range(n)]
    parts = {1: fresh(30) + ["the"] * 10 + fresh(30), 2: fresh(30) + ["the"] * 42 + fresh(30)}
    parts |= {3: fresh(30) + ["the"] * 109 + fresh(30)}
    rows = [(i, " ".join(p)) for i, p in parts.items()]
    found = chaining.passages(spark.createDataFrame(rows, "doc_id bigint, text string"))
    spans = {r.doc_id: [tuple(s) for s in r.spans] for r in chaining.merged(found).collect()}
    assert spans == {3: [(30, 139)]}


def test_shared_seeds_are_kept_by_document_with_their_first_holder(spark):
    draw = random.Random(3)
    words = [f"s{i}" for i in range(12)]
    rows = [(i // 2 if i > 40 else i, " ".join(draw.choices(words, k=draw.randint(0, 40)))) for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    settings = chaining.Settings()
    held: dict[int, list[tuple[int, int]]] = {}
    batch = pa.RecordBatch.from_pydict({"doc_id": [i for i, _ in rows], "text": [t for _, t in rows]})
    for seed, text, pos in zip(*(x.tolist() for x in chaining._seeds(batch, settings)), strict=True):
        held.setdefault(seed, []).append((rows[text][0], pos))
    wanted = sorted(
        (doc, pos, np.uint64(seed).view(np.int64), *min(places))
        for seed, places in held.items()
        for doc, pos in places
        if len({d for d, _ in places}) > 1
    )
    found = []
    for r in chaining._shared(frame, 7, settings).collect():
        pos, homes = (np.frombuffer(x, "<i4").tolist() for x in (r.pos, r.homes))
        seeds, firsts = (np.frombuffer(x, "<i8").tolist() for x in (r.seeds, r.firsts))
        found += zip([r.doc_id] * len(pos), pos, seeds, firsts, homes, strict=True)
    assert sorted(found) == wanted and wanted


def test_chains_made_at_once_are_those_of_each_two_documents():
    rng, settings = np.random.default_rng(4), chaining.Settings(flank=10)
    for _ in range(30):
        n = int(rng.integers(1, 300))
        doc, other = rng.integers(0, 3, n), rng.integers(0, 4, n)
        x = rng.integers(0, int(rng.choice([40, 400, 4000])), n)
        y = np.maximum(x + rng.integers(-9, 9, n) * rng.integers(0, 2), 0)
        order = np.lexsort((y, x, other, doc))
        doc, other, x, y = (c[order] for c in (doc, other, x, y))
        wanted = []
        for d, o in sorted({*zip(doc.tolist(), other.tolist(), strict=True)}):
            at = np.flatnonzero((doc == d) & (other == o))
            for found, _ in chaining.chains(x[at], y[at], settings):
                px, py = x[at][found], y[at][found]
                cut = np.flatnonzero(np.maximum(np.diff(px), np.diff(py)) > settings.stretch) + 1
                for part in np.split(np.arange(len(px)), cut):
                    wanted.append((d, o, px[part].tolist(), py[part].tolist()))
        rows = chaining._chain_rows(doc, other, x, y, settings, by_pair=True).to_pylist()
        assert sorted((r["doc_id"], r["other"], r["pos"], r["other_pos"]) for r in rows) == sorted(wanted)


def test_chains_that_take_their_words_in_halves_give_the_same_passages(spark, monkeypatch):
    draw = random.Random(21)
    lines = [" ".join(f"h{draw.randint(0, 10**6)}" for _ in range(30)) for _ in range(12)]
    rows = [(i, " ".join(draw.sample(lines, 5))) for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    whole = {tuple(r) for r in chaining.passages(frame).collect()}
    monkeypatch.setattr(chaining, "FEW_CHAINS", 0)
    assert {tuple(r) for r in chaining.passages(frame).collect()} == whole != set()


def test_passages_leave_no_tables_of_seeds_and_words_behind(spark):
    line = " ".join(f"p{j}" for j in range(60))
    frame = spark.createDataFrame(
        [(i, f"a{i} " * i + line) for i in range(9)], "doc_id bigint, text string"
    )
    folder = pathlib.Path(shared_dir(spark)) / "llm"
    before = set(folder.glob("*"))
    found = chaining.passages(frame)
    left = {c for p in set(folder.glob("*")) - before for c in spark.read.parquet(str(p)).columns}
    assert left == {"doc_id", "source_id", "start", "stop", "source_start", "source_stop", "matched"}
    assert {r.doc_id for r in found.collect()} == set(range(1, 9))


def test_sifted_places_are_those_with_enough_in_common():
    rng = np.random.default_rng(8)
    texts = [rng.integers(0, 9 if i % 2 else 60_000, 60).astype("<u2") for i in range(80)]
    for i in range(0, 70, 5):
        texts[i + 1] = np.concatenate([texts[i][:35], texts[i + 1][35:]])
        texts[i + 2] = np.concatenate([texts[i + 2][:41], texts[i][: 16 + i // 5]])
    column = pa.array([t.tobytes() for t in texts], pa.binary())
    grams = chaining._grams(column, np.zeros(80, np.int64))
    asking, asked = np.arange(0, 80, 2), np.arange(50)
    counts = [Counter(zip(t, t[1:], t[2:], strict=False)) for t in texts]
    pairs = {(a, b) for a in asking.tolist() for b in asked.tolist() if a != b}
    for least in (3, 18):
        wanted = {(a, b) for a, b in pairs if (counts[a] & counts[b]).total() >= least}
        found = {*zip(*(x.tolist() for x in chaining._sifted(grams, asking, asked, least)), strict=True)}
        assert wanted and found == wanted
    assert chaining._least_common(chaining.Settings()) == 18


def test_passages_odd_rows(odd, docs):
    assert chaining.passages(odd.limit(0)).count() == 0
    found = chaining.passages(odd)
    assert found.count() == 0
    kept = chaining.without_passages(odd, found)
    assert kept.columns == odd.columns and kept.count() == len(ODD)
    twice = docs.limit(20).union(docs.limit(20).withColumn("doc_id", F.col("doc_id") + 1000))
    found = chaining.passages(twice.union(twice))
    assert found.count() > 0 and chaining.without_passages(twice, found).count() < 40


def test_chains_follow_order_in_both_texts():
    settings = chaining.Settings()
    pos, other = np.array([0, 5, 10, 15, 20, 200]), np.array([50, 55, 2, 65, 70, 80])
    best = [found.tolist() for found, _ in chaining.chains(pos, other, settings)]
    assert best[0] == [0, 1, 3, 4] and sorted(map(tuple, best[1:])) == [(2,), (5,)]


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_packing_holds_every_token_once(which, request):
    from tokenizers import Tokenizer

    frame = request.getfixturevalue(which)
    tokenizer = Tokenizer.from_file(WORD_BPE)
    rows = retrieval_packing.packed(frame, WORD_BPE, shard_bytes=100_000, with_ids=True).collect()
    texts = sorted(
        tuple(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + (1,)
        for r in frame.collect()
    )
    whole: dict = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id >> 32, r.start)):
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        assert len(r.ids) == r.length > 0
        whole.setdefault(r.doc_id, []).append(r)
    for i, pieces in whole.items():
        if i == 10 and which == "odd":
            continue
        ids = tuple(x for r in pieces for x in r.ids)
        assert ids in texts and {r.doc_tokens for r in pieces} == {len(ids)}
    assert sum(r.length for r in rows) == sum(map(len, texts))
    sequences: dict = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == sequences.get(r.sequence_id, 0)
        sequences[r.sequence_id] = r.offset + r.length
    assert all(n <= 2048 and n & (n - 1) == 0 for n in sequences.values())
    assert retrieval_packing.packed(frame.limit(0), WORD_BPE).count() == 0


def test_packing_brings_like_documents_together(spark):
    draw = random.Random(6)
    word = lambda: "".join(draw.choice("bdfgklmnprst") + draw.choice("aeiou") for _ in range(3))
    common = [word() for _ in range(200)]
    rows = []
    for i in range(300):
        text = [draw.choice(common) for _ in range(150)]
        text += [word() for _ in range(20)]
        rows += [(i, " ".join(text)), (1000 + i, " ".join(text))]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
    found = retrieval_packing.packed(frame, WORD_BPE, shard_bytes=20_000).collect()
    shards: dict = {}
    for r in found:
        shards.setdefault(r.doc_id, set()).add(r.sequence_id >> 32)
    assert len(set.union(*shards.values())) > 15
    assert sum(shards[i] == shards[1000 + i] for i in range(300)) >= 270


def test_scores_go_by_all_documents():
    ids = [np.array(x, np.uint32) for x in ([1, 2], [1, 5], [2, 6], [7])]
    unused = np.array([False, True, True, True])
    held = np.array([0, 90, 3, 0, 0, 2, 2, 2])
    assert retrieval_packing.Index(ids).neighbours(0, unused).tolist() == [1, 2]
    corpus = retrieval_packing.Corpus(100, 2.0, held)
    assert retrieval_packing.Index(ids, corpus).neighbours(0, unused).tolist() == [2, 1]


def test_seed_asks_with_all_its_tokens():
    rare, usual = np.arange(100, 160), np.arange(200, 260)
    parts = [[rare, usual], [rare[:1]], [usual], [rare], [usual], [usual]]
    ids = [np.concatenate(p).astype(np.uint32) for p in parts]
    found = retrieval_packing.Index(ids).neighbours(0, np.arange(6) > 0).tolist()
    assert sorted(found) == [1, 2, 3, 4, 5] and found[-1] == 1


def test_seed_asks_for_its_neighbours():
    ids = [np.array(x, np.uint32) for x in ([1, 2, 3], [9, 8], [2, 3, 4], [3, 7], [])]
    index = retrieval_packing.Index(ids)
    unused = np.array([False, True, True, True, True])
    assert index.neighbours(0, unused).tolist() == [2, 3]
    pieces = retrieval_packing.fill([3, 2, 3, 2, 1], index, 8)
    assert [p[0] for p in pieces[:3]] == [0, 2, 3]


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_pieces_are_the_models(which, request):
    import sentencepiece

    frame = request.getfixturevalue(which)
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    found = piece_lattice.encoded(frame, PIECES)
    want = sorted(model.encode([r.text or "" for r in frame.collect()], num_threads=1))
    assert sorted(r.ids for r in found.collect()) == want
    back = piece_lattice.decoded(found, PIECES)
    assert sorted(r.text for r in back.collect()) == sorted(r.text or "" for r in frame.collect())
    assert piece_lattice.round_trip(frame, PIECES).where("NOT same").count() == 0
    assert piece_lattice.encoded(frame.limit(0), PIECES).count() == 0


def test_pieces_of_odd_texts():
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = ["  a", "a  b\n\n c ", "▁a b", "<s> <0x41>", "aaaaaaaaaaa lllll", "☃🎉 x", "\n", " "]
    found = piece_lattice.encoder(PIECES).encode(texts)
    assert [x.tolist() for x in found] == model.encode(texts, num_threads=1)


def test_pieces_null_ids(spark):
    frame = spark.createDataFrame(
        [(1, None), (2, [None]), (3, [])], "doc_id bigint, ids array<int>"
    )
    assert [r.text for r in piece_lattice.decoded(frame, PIECES).collect()] == ["", "", ""]


def test_edits_keep_the_counts_right():
    counter = edit_counts.Counter(RANKS, public_tokenizers.PATTERN)
    draw = random.Random(6)
    count = lambda t: len(counter.encoding.encode_ordinary(t))
    for start in ("", " ", "a  b \n c", "it's 12 34..   q é日本  x", "word " * 300):
        text = start
        tree = edit_counts.CountTree(text, counter)
        for _ in range(60):
            a = draw.randint(0, len(text))
            b = min(len(text), a + draw.choice([0, 0, 1, 4, 40]))
            new = draw.choice(["", " ", "\n", "abc", " the", "'s", "  ", " ", "1 2", "\t\n"])
            tree.replace(a, b, new)
            text = text[:a] + new + text[b:]
            assert (tree.text(), tree.total, tree.length) == (text, count(text), len(text))


def test_edits_encode_only_what_they_touch():
    counter = edit_counts.Counter(RANKS, public_tokenizers.PATTERN)
    tree = edit_counts.CountTree("some words " * 5000, counter)
    before = tree.encoded
    tree.replace(30_000, 30_003, "abc")
    assert tree.encoded - before <= 4


def test_counted_edits_odd_rows(odd):
    edits = F.when(
        F.col("doc_id") != 4,
        F.array(
            F.struct(F.lit(None).alias("start"), F.lit(3).alias("stop"), F.lit("q").alias("text")),
            F.struct(F.lit(1).alias("start"), F.lit(9**9).alias("stop"), F.lit(" z").alias("text")),
        ),
    )
    found = edit_counts.counted_edits(odd, edits, RANKS, public_tokenizers.PATTERN)
    texts = {r.doc_id: r.edited_text for r in found.collect()}
    assert found.count() == len(ODD) and texts[4] == "one" and texts[5] == "O z"
    assert texts[1] == texts[2] == " z"
    empty = edit_counts.counted_edits(odd.limit(0), edits, RANKS, public_tokenizers.PATTERN)
    assert empty.count() == 0


def test_extensions_of_many_pairs_equal_those_of_one():
    rng = np.random.default_rng(5)
    for wide, words in ((6, 2), (20, 4), (46, 30)):
        a, b = np.full((40, wide), -1), np.full((40, wide), -2)
        for row in range(40):
            text = rng.integers(0, words, wide)
            edited = np.where(rng.random(wide) < 0.2, rng.integers(0, words, wide), text)
            edited = edited[rng.random(wide) > 0.1]
            own = text[: rng.integers(0, wide + 1)]
            a[row, : len(own)], b[row, : len(edited)] = own, edited
        found = chaining.extended_many(a, b)
        for row in range(40):
            expected = np.full(wide, -1)
            for i, j in chaining.extended(a[row][a[row] >= 0].tolist(), b[row][b[row] >= 0].tolist()):
                expected[i] = j
            assert found[row].tolist() == expected.tolist()


def test_chains_of_ascending_pairs_have_the_best_predecessors():
    rng = np.random.default_rng(6)
    settings = chaining.Settings()
    for _ in range(100):
        n = int(rng.integers(1, 30))
        x, y = (np.cumsum(rng.integers(1, 25, n)) for _ in range(2))
        best = []
        for i in range(n):
            cost = [settings.gap_cost * (x[i] - x[j] + y[i] - y[j]) for j in range(i)]
            best.append(settings.k + max([0.0, *(s - c for s, c in zip(best, cost, strict=True))]))
        found = list(chaining.chains(x, y, settings))
        assert sorted(i for part, _ in found for i in part.tolist()) == list(range(n))
        assert max(score for _, score in found) == max(best)


def test_stored_tables_leave_no_setting_behind(spark):
    before = spark.conf.get(store.SHUFFLES_GO, None)
    assert store.stored(spark.range(10).groupBy("id").count()).count() == 10
    assert spark.conf.get(store.SHUFFLES_GO, None) == before


def test_piece_pairs_are_worked_out_once(monkeypatch):
    pieces = piece_lattice.Pieces(PIECES)
    rng = np.random.default_rng(5)
    ordinary = np.sort(pieces.ids)
    pairs = rng.choice(ordinary, 6000) * pieces.size + rng.choice(ordinary, 6000)
    places = grams.mix(pairs.astype(np.uint64)) >> piece_lattice.TOP
    assert len(np.unique(places)) < len(np.unique(pairs))  # some pairs share a place
    texts = [(pieces.texts[p // pieces.size], pieces.texts[p % pieces.size]) for p in pairs.tolist()]
    expected = [pieces.merged(a + b) == [a, b] for a, b in texts]
    assert pieces.go_together(pairs).tolist() == expected
    assert pieces.go_together(pairs[::-1]).tolist() == expected[::-1]
    some, last = pairs[:50], expected[:50]
    assert pieces.go_together(some).tolist() == last
    pieces.fits.clear()
    monkeypatch.setattr(pieces, "merged", None)
    assert pieces.go_together(some).tolist() == last


def test_packing_ids_are_the_tokenizers_own_and_few_are_kept(monkeypatch):
    from tokenizers import Tokenizer

    rng = random.Random(3)
    letters = "aB zé É×÷ßÿĀñ'<>`~_09 \n\t\r\v\f\x00\x1c\x85\xa0 中İǅ日😀 AbC  dE.,;-ÀÖØÞ"
    texts = ["".join(rng.choices(letters, k=rng.randrange(30))) for _ in range(3000)]
    texts += ["", "é", "É", "Ã\x97", "a" * 5000, "don't STOP,now1234 (Ünder) x y"]
    own = Tokenizer.from_file(WORD_BPE).encode_batch_fast(texts, add_special_tokens=False)
    monkeypatch.setattr(retrieval_packing, "KNOWN_TOKENS", 500)
    monkeypatch.setattr(retrieval_packing, "PLACES", 64)  # most runs share a place with others
    encoder = retrieval_packing.WordEncoder(WORD_BPE)
    for at in range(0, len(texts), 20):
        found = encoder.encode([*texts[at : at + 20], None])
        assert [x.tolist() for x in found] == [x.ids for x in own[at : at + 20]] + [[]]
        assert len(encoder.keys) == 64 and len(encoder.ids) <= 1 << 16
    assert retrieval_packing.id_kind(WORD_BPE) == np.dtype("<u2")


def test_packing_order_and_neighbours_as_one_by_one():
    rng = np.random.default_rng(4)
    ids = [rng.integers(0, 300, n).astype(np.uint32) for n in rng.integers(0, 40, 600)]
    corpus = retrieval_packing.Corpus(600, 20.0, np.bincount(np.concatenate(ids), minlength=300))
    rarity = corpus.rarity()
    bounds = np.append(0, np.cumsum([len(x) for x in ids]))
    for doc, key in enumerate(retrieval_packing._keys(np.concatenate(ids), bounds, rarity).tolist()):
        places = np.unique(rarity[ids[doc]])[:3].tolist() + [65_535] * 3
        assert key == (places[0] << 32) + (places[1] << 16) + places[2]
    whole, kept = retrieval_packing.Index(ids, corpus), retrieval_packing.Index(ids, corpus)
    unused = rng.random(600) < 0.5
    kept.keep(unused)
    assert len(kept.docs) < len(whole.docs)
    for doc in range(0, 600, 7):
        found = whole.neighbours(doc, unused)
        assert found.tolist() == kept.neighbours(doc, unused).tolist()


@pytest.mark.parametrize("usual", [1, 4, 1000])
def test_rows_of_usual_tokens_score_like_lists(monkeypatch, usual):
    rng = np.random.default_rng(6)
    ids = [np.unique(rng.zipf(1.3, 60) % 400).astype(np.uint32) for _ in range(200)]
    held = np.bincount(np.concatenate(ids), minlength=400)
    monkeypatch.setattr(retrieval_packing, "USUAL", usual)
    index = retrieval_packing.Index(ids, retrieval_packing.Corpus(200, 40.0, held))
    assert (len(index.rows) > 0) == bool((held * usual >= 200).any())
    unused = np.ones(200, bool)
    for gone in (0, 60, 120):
        unused[:gone] = False
        index.keep(unused)
        unused[gone : gone + 9] = False
        for doc in range(0, 200, 11):
            score = np.zeros(200)
            for token in ids[doc][held[ids[doc]] > 1]:
                with_it = [d for d in range(200) if token in ids[d]]
                lengths = np.array([len(ids[d]) for d in with_it])
                idf = np.log1p((200 - held[token] + 0.5) / (held[token] + 0.5))
                score[with_it] += idf * 2.2 / (1 + 1.2 * (0.25 + 0.75 * lengths / 40.0))
            score[~unused] = 0
            found = index.neighbours(doc, unused)
            assert sorted(found.tolist()) == np.flatnonzero(score).tolist()
            assert (np.diff(score[found]) <= 1e-9).all()


def test_stored_tables_reach_python_in_batches_of_a_few_mb(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["size"])

    before = spark.conf.get(store.BATCH_BYTES)
    long = spark.range(0, 400, 1, 1).select(F.repeat(F.lit("word "), 10_000).alias("text"))
    found = store.stored(long.mapInArrow(sizes, "size bigint")).collect()
    assert sum(r["size"] for r in found) > 19_000_000 and max(r["size"] for r in found) < 5_000_000
    assert spark.conf.get(store.BATCH_BYTES) == before
