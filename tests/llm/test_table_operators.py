from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from repopulse.checks.compare import connect, differences
from repopulse.llm import hilbert, posting_lists, url_models
from repopulse.llm.oracle import ORACLE
from repopulse.llm.queries import QUERIES, URL_RULES

SMALL = "/root/testdata/sf0.001"


# --- registration ---------------------------------------------------------------------------------


def test_every_operator_is_registered():
    names = set(registry.queries())
    assert {int(n[2:].split("_")[0]) for n in names if n in QUERIES} == set(range(1, 14))
    assert "pipeline" in names and set(ORACLE) <= names


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, name):
    assert differences(spark, connect(SMALL), SMALL, QUERIES[name], ORACLE[name]) is None


# --- addresses ------------------------------------------------------------------------------------


def test_host_path_and_longest_rule(spark):
    cases = {
        "http://A.Example.ORG/en/2?q#f": ("a.example.org", "/en/2", "org/", "allow"),
        "http://example.org/en/17": ("example.org", "/en/17", "example.org/en/1", "block"),
        "https://m.example.org/es/": ("m.example.org", "/es/", "example.org/es/", "block"),
        "x://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"),
        "http://org/": ("org", "/", "org/", "allow"),
        "http://b.com/de/x": ("b.com", "/de/x", "com/de/", "block"),
        "http://b.com/DE/x": ("b.com", "/DE/x", None, None),
        "http://a.org?x=/": ("a.org", "", None, None),
        "http://É.net/a://b": ("É.net", "/a://b", None, None),
        "://#": ("", "", None, None),
        "a.org/": ("", "", None, None),
        "": ("", "", None, None),
        None: ("", "", None, None),
    }
    frame = spark.createDataFrame(
        [(u, i, "host", "k", 1.0) for i, u in enumerate(cases)],
        "url string, page_id int, host string, gram string, score double",
    )
    found = url_models.judged(frame.union(frame), URL_RULES).collect()
    assert len(found) == 2 * len(cases)
    urls = list(cases)
    for row in found:
        host, path, rule, verdict = cases[urls[row.page_id]]
        assert (row.host, row.path, row.rule) == (host, path, rule)
        assert row.verdict == (verdict or row.verdict) and row.verdict in ("allow", "block")
    assert url_models.judged(frame.limit(0), URL_RULES).count() == 0
    alone = url_models.judged(frame, []).collect()
    assert {r.verdict for r in alone} == {"allow"} and len(alone) == len(cases)


def test_models_tell_unseen_addresses_apart(spark):
    good = [f"http://n{i}.net/garden/{i * 7}-flowers" for i in range(120)]
    bad = [f"http://n{i}.net/casino/{i * 7}-win-cash" for i in range(120)]
    rules = [url_models.Rule("allow", "net/garden/"), url_models.Rule("block", "net/casino/")]
    new = [f"http://q{i}.com/garden/{i}-flowers" for i in range(20)] + [
        f"http://q{i}.com/casino/{i}-win-cash" for i in range(20)
    ]
    frame = spark.createDataFrame(
        [(i, u) for i, u in enumerate(good + bad + new)], "page_id bigint, url string"
    )
    found = url_models.judged(frame, rules).where("rule IS NULL").orderBy("page_id").collect()
    assert [r.verdict for r in found] == ["allow"] * 20 + ["block"] * 20


def test_url_plan_has_no_python(spark):
    plan = QUERIES["op1_url_filter"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


# --- neighbours -----------------------------------------------------------------------------------


def brute_nearest(rows, queries, k):
    out = {}
    for q, v in queries:
        scored = sorted(
            (-sum(float(a) * float(b) for a, b in zip(v, w, strict=True)), i) for i, w in rows if i != q
        )
        out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def test_neighbours_recall_on_many_lists(spark):
    draw = np.random.default_rng(1)
    centres = draw.normal(size=(12, 16))
    vectors = (centres[draw.integers(0, 12, 1500)] + draw.normal(size=(1500, 16))).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    settings = posting_lists.Settings(k=10, list_rows=32, block=20, trial=40)
    found = posting_lists.nearest(frame, frame.where("vec_id % 20 = 0"), settings=settings)
    want = brute_nearest(rows, [r for r in rows if r[0] % 20 == 0], 10)
    got: dict = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    assert set(got) == set(want)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)
    exact = {q: dict(pairs) for q, pairs in want.items()}
    for q, pairs in got.items():
        assert all(abs(exact[q].get(i, s) - s) < 1e-12 for i, s in pairs)


def test_neighbours_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    same = [0.6, 0.8]
    rows = [
        (0, same),
        (20, same),
        (20, same),
        (1, same),
        (2, [0.8, 0.6]),
        (3, [-2.0, 1.0]),
        (4, None),
        (40, [0.0, 0.0]),
        (60, [1.0, None]),
        (5, [nan, 1.0]),
        (80, [inf, 1.0]),
        (6, [1.0]),
        (7, []),
        (None, same),
    ]
    frame = spark.createDataFrame(
        [(*r, 1.0, 2, "x") for r in rows],
        "vec_id bigint, embedding array<float>, score double, rank int, list string",
    )
    found = posting_lists.nearest(frame, frame.where("vec_id % 20 = 0"))
    usable = [(i, v) for i, v in rows[:6] if i is not None]
    usable.remove((20, same))
    want = brute_nearest(usable, [(0, np.float32(same)), (20, np.float32(same))], 20)
    got: dict = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {q: [i for i, _ in pairs] for q, pairs in want.items()}
    assert got[0] == [1, 20, 2, 3]
    assert posting_lists.nearest(frame.limit(0), frame).count() == 0
    assert posting_lists.nearest(frame, frame.where("vec_id = 40")).count() == 0


def test_equal_vectors_keep_the_smallest_ids(spark):
    rows = [(i, [1.0, 0.0]) for i in range(300)] + [(300 + i, [0.5, 0.1 * i]) for i in range(5)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    found = posting_lists.nearest(frame, frame.where("vec_id % 20 = 0"))
    for q in (0, 100, 280):
        ids = [r.vec_id for r in found.where(F.col("query_id") == q).orderBy("rank").collect()]
        assert ids == [i for i in range(21) if i != q][:20]


# --- shards ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2), (1, 5), (2, 1)])
def test_curve_visits_each_cell_once_in_unit_steps(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), -1).reshape(-1, dims)
    index = hilbert.curve_index(cells, bits)
    assert sorted(index.tolist()) == list(range(len(cells)))
    steps = np.abs(np.diff(cells[np.argsort(index)], axis=0)).sum(axis=1)
    assert (steps == 1).all()


def test_shards_hold_every_row_once(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (5, "é", "en", None, -3), (5, "é", "en", None, -3)],
        docs.schema,
    )
    odd = docs.union(odd).withColumns({"shard": F.lit("x"), "slot": F.lit(1), "size": F.lit(None)})
    found = hilbert.sharded(odd, ["lang", "source", "n_chars", "doc_id"]).collect()
    n = docs.count() + 3
    counts = Counter(r.shard for r in found)
    assert len(found) == n and set(counts) == set(range(16))
    assert max(counts.values()) - min(counts.values()) <= 1
    for shard, count in counts.items():
        assert sorted(r.slot for r in found if r.shard == shard) == list(range(count))
    texts = Counter(
        (r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode()))
        for r in odd.collect()
    )
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == texts
    order = sorted(found, key=lambda r: (r.shard, r.slot))
    assert [r.curve for r in order] == sorted(r.curve for r in found)
    assert hilbert.sharded(docs.limit(0), ["lang"]).count() == 0
    few = hilbert.sharded(docs.limit(3), ["n_chars"]).collect()
    assert sorted(r.slot for r in few) == [0, 0, 0]


def test_texts_that_begin_alike_have_cells_of_their_own(spark):
    rows = [(i, "x", f"https://common-crawl-{i % 16:02d}.org") for i in range(640)]
    rows += [(1000, "x", None), (1001, "x", "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    grid = hilbert.fit_grid(docs, ["source"])
    cells = {r.source: r.curve for r in hilbert.with_curve(docs, grid).collect()}
    named = sorted(k for k in cells if k)
    assert len({cells[k] for k in named}) == 16 and cells[None] == cells[""] == 0
    assert [cells[k] for k in named] == sorted(cells[k] for k in named)
    shards = hilbert.sharded(docs, ["source"]).join(docs, "doc_id").where("source > ''")
    per = shards.groupBy("shard").agg(F.countDistinct("source").alias("n")).collect()
    assert max(r.n for r in per) <= 2


def test_shards_can_be_skipped_by_several_columns(spark):
    docs = spark.read.parquet(f"{SMALL.replace('0.001', '0.01')}/documents.parquet")
    shards = hilbert.sharded(docs, ["n_chars", "doc_id"]).select("doc_id", "shard")
    joined = docs.join(shards, "doc_id").groupBy("shard").agg(
        *[f(c) for c in ("n_chars", "doc_id") for f in (F.min, F.max)]
    )
    rows = joined.collect()
    for column in ("n_chars", "doc_id"):
        middle = docs.approxQuantile(column, [0.5], 0.0)[0]
        read = [r for r in rows if r[f"min({column})"] <= middle <= r[f"max({column})"]]
        assert len(read) <= 8
