import math

import numpy as np
import pytest

from rollbook.llm import topk


def brute(rows, k):
    good = {i: np.floor(64 * np.array(v, dtype=float)).astype(int) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q in good:
        if q % 20 == 0:
            found = sorted((-int(good[q] @ good[v]), v) for v in good if v != q and len(good[v]) == len(good[q]))
            out += [(q, n + 1, v, -s) for n, (s, v) in enumerate(found[:k])]
    return sorted(out)


@pytest.mark.parametrize("vectors, queries", [(8192, 1024), (40, 3)])
def test_against_brute_force(spark, monkeypatch, vectors, queries):
    monkeypatch.setattr(topk, "VECTORS_PER_BLOCK", vectors)
    monkeypatch.setattr(topk, "QUERIES_PER_BLOCK", queries)
    rng = np.random.default_rng(5)
    rows = [(i, (rng.integers(-3, 4, 8) / 8).tolist()) for i in range(300)]  # many ties
    rows += [(1000 + i, [0.5] * 8) for i in range(60)]  # one very common vector
    rows += [(400, None), (420, [None] * 8), (440, [math.nan] + [0.1] * 7), (460, [math.inf] * 8), (480, [0.25] * 3), (481, [0.75] * 3), (500, [])]
    table = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, rank int")
    whole = topk.whole_vectors(table)
    got = topk.top_k(whole, whole.filter("vec_id % 20 = 0"), 7)
    assert sorted(map(tuple, got.collect())) == brute([(i, [None if x is None else float(np.float32(x)) for x in v] if v is not None else None) for i, v in rows], 7)


@pytest.mark.parametrize("kind", [np.float64, object])
def test_reading_stops_early_and_stays_exact(kind):
    rng = np.random.default_rng(7)
    x = np.floor(rng.exponential(3, (4000, 4)) ** 2)
    ids = np.arange(4000)
    q = np.array([[9.0, 1.0, 0.0, -2.0]])
    lists = topk.Lists(ids, x.astype(np.int64).astype(kind))
    i, vec, score, reads = topk.bounded_search(lists, np.array([5]), q.astype(np.int64).astype(kind), 20)
    want = sorted((-s, j) for j, s in enumerate((x @ q[0]).tolist()) if j != 5)[:20]
    assert [(-s, j) for s, j in zip(score, vec, strict=True)] == want
    assert reads < 0.5 * 3 * 4000  # three lists have a weight


def test_every_entry_is_read_once_at_most():
    rng = np.random.default_rng(8)
    x = rng.integers(-50, 50, (500, 16)).astype(np.float64)
    q = rng.integers(-50, 50, (3, 16)).astype(np.float64)
    *_, reads = topk.bounded_search(topk.Lists(np.arange(500), x), np.array([0, 1, 2]), q, 20)
    assert reads <= 3 * 16 * 500


def test_very_large_components_and_long_vectors(spark):
    rows = [(i, [float((i * 37 % 11) * 2.0**40), float(i % 7), -(2.0**30) * (i % 3)]) for i in range(60)]
    rows += [(100 + i, [float((i * j) % 5) for j in range(5000)]) for i in range(0, 41, 4)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = topk.whole_vectors(table)
    few = [r for r in rows if r[0] < 100 and r[1][0] < 2.0**43]
    got = topk.top_k(whole.filter(topk.F.col("v")[0] < 2**50), whole.filter("vec_id % 20 = 0").filter(topk.F.col("v")[0] < 2**16), 7)
    want = []
    for q, v in rows:
        if q % 20 == 0 and 64 * v[0] < 2**16:
            a = [int(64 * t) for t in v]
            found = sorted((-sum(s * int(64 * t) for s, t in zip(a, w)), i) for i, w in rows if i != q and len(w) == len(v) and 64 * w[0] < 2**50)
            want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found[:7])]
    assert sorted(map(tuple, got.collect())) == sorted(want) and few


def test_empty(spark):
    none = topk.whole_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert topk.top_k(none, none).count() == 0
