import random
import re
import tracemalloc

import numpy as np
import pytest

from rollbook.llm import graph, jaccard
from rollbook.llm.queries import op5_ngram_jaccard

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, ngram=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(lowered)
    if len(w) < ngram:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + ngram]) for i in range(len(w) - ngram + 1)}


def brute(texts, ngram=3, percent=90):
    """doc_id -> (n_shingles, smallest doc_id in reach), all pairs compared."""
    sets = {i: shingles(t, ngram) for i, t in texts.items()}
    root = {i: i for i in sets}
    ids = sorted(sets)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_copies(seed, groups=6, each=12, words=130):
    """Groups of copies with more and more edits, so that similarity straddles the limit."""
    rng, texts = random.Random(seed), {}
    passage = " ".join(f"p{i}" for i in range(40))
    for g in range(groups):
        base = [f"g{g}w{rng.randrange(400)}" for _ in range(words)]
        for k in range(each):
            copy = list(base)
            for _ in range(rng.randrange(0, 6)):
                copy[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
            text = " ".join(copy) + (" " + passage if g % 2 else "")
            texts[len(texts)] = text
    for _ in range(60):  # the same passage in documents that are otherwise alone
        texts[len(texts)] = " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(20, 200))) + " " + passage
    for n in range(1, 14):  # short texts, around the sizes where one word decides
        texts[len(texts)] = " ".join(f"s{i}" for i in range(n))
        texts[len(texts)] = " ".join(f"S{i}" for i in range(n))
    return texts


@pytest.mark.parametrize("seed, frequent, paired, block", [(1, 16, 16, 1500), (2, 3, 2, 20), (3, 10**9, 1, 7)])
def test_against_all_pairs(spark, monkeypatch, seed, frequent, paired, block):
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    monkeypatch.setattr(jaccard, "PAIRED", paired)
    monkeypatch.setattr(jaccard, "BLOCK_SETS", block)
    texts = near_copies(seed)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs).collect()}
    assert got == brute(texts)


@pytest.mark.parametrize("share", [0.0, 0.5, 0.9, 1.0])
def test_similar_sets_share_a_signature(share):
    """Whatever part of the tokens is frequent, and at every size."""
    rng = np.random.default_rng(int(share * 10))
    for size in [*range(9, 60), 150, 600, 2500]:
        pool = np.unique(rng.integers(0, 2**63, size + 400, dtype=np.uint64))
        rng.shuffle(pool)
        frequent = np.sort(pool[rng.random(len(pool)) < share])
        a = pool[:size]
        apart = size - jaccard.needed(size, 90)
        for drop in {0, apart // 2, apart}:
            b = pool[: size - drop]
            more = (100 * len(b) - 90 * size) // 90
            b = np.concatenate([b, pool[size : size + max(0, more)]])
            both = size - drop
            assert 100 * both >= 90 * (size + len(b) - both)
            x, y = (set(jaccard.signatures(np.sort(s), frequent, 90).tolist()) for s in (a, b))
            assert x & y or set(a) == set(b)


@pytest.mark.parametrize("percent", [80, 90])
def test_sketches_tell_long_sets_apart(percent):
    """Chance made any two sets of over 5,400 tokens close, so all of them were one bundle."""
    rng = np.random.default_rng(3)
    tokens = rng.integers(0, 2**63, 100_000, dtype=np.uint64)
    sets = {}
    for size in [0, 1, 40, 300, 2048, 2049, 4096, 4100, 6000, 9000, 17_000]:
        for extra in (0, size // 12):
            sets[size, extra] = np.unique(rng.choice(tokens, size + extra, replace=False))
    sets["near", 0] = np.unique(np.concatenate([sets[9000, 0][200:], tokens[:150]]))
    names = list(sets)
    drawn = {name: jaccard.sketch(s).tobytes() for name, s in sets.items()}
    a, b = zip(*[(x, y) for x in names for y in names], strict=True)
    apart = jaccard.sketches_apart([drawn[x] for x in a], [drawn[y] for y in b])
    for x, y, d in zip(a, b, apart.tolist(), strict=True):
        total = len(sets[x]) + len(sets[y])
        both = len(np.intersect1d(sets[x], sets[y]))
        assert d <= total - 2 * both
        close = d * (100 + percent) <= total * (100 - percent)
        linked = 100 * both >= percent * (total - both)
        assert close == linked or {x[0], y[0]} == {9000, "near"}


def test_similar_sets_share_several_signatures():
    """As many as both promise; sets of frequent tokens share one with their kind."""
    rng = np.random.default_rng(5)
    for share in (0.0, 0.3, 0.85, 0.95):
        for size in [*range(4, 40), 150, 600]:
            pool = np.unique(rng.integers(0, 2**63, size + 400, dtype=np.uint64))
            rng.shuffle(pool)
            frequent = np.sort(pool[rng.random(len(pool)) < share])
            drop = rng.integers(0, size - jaccard.needed(size, 80) + 1)
            a, b = np.sort(pool[:size]), pool[: size - drop]
            more = (100 * len(b) - 80 * size) // 80
            b = np.sort(np.concatenate([b, pool[size : size + max(0, more)]]))
            (x, m), (y, n) = (jaccard.shared_signatures(s, frequent, 80) for s in (a, b))
            if set(a) != set(b):
                assert len(set(x.tolist()) & set(y.tolist())) >= (min(m, n) or max(m, n) or 1)


@pytest.mark.parametrize("signed, sets", [(10, 4_000), (10**9, 40)])
def test_stars_are_parted(spark, monkeypatch, signed, sets):
    """Sets that hang together by a common passage alone are not verified together."""
    for name, value in {"FREQUENT": 10**9, "SIGNED": signed, "PAIRED": 2, "BLOCK_SETS": 30, "SCREEN_SETS": sets}.items():
        monkeypatch.setattr(jaccard, name, value)
    texts = near_copies(7)
    docs = spark.createDataFrame(list(texts.items()) * 2, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs).collect()}
    assert got == brute(texts)


def test_close_sets_meet_whatever_their_cells():
    rng = np.random.default_rng(9)
    base = rng.integers(0, 2**63, 6000, dtype=np.uint64)
    sets = [np.unique(base[: 3800 + 40 * k]) for k in range(12)]  # 512 to 1024 cells
    sets += [np.unique(rng.integers(0, 2**63, 4000 + k, dtype=np.uint64)) for k in range(6)]
    sets.sort(key=len)
    n = np.array([len(s) for s in sets])
    links = jaccard._close_forest(n, [jaccard.sketch(s).tobytes() for s in sets], 90)
    linked = {i for link in links for i in link}
    assert len(links) == 11
    assert linked == {i for i, s in enumerate(sets) if np.isin(s, base).all()}


def test_frequent_tokens_reach_the_driver_packed(spark):
    """A row for each took some 100 bytes in the driver; a packed token takes 8."""
    many = 200_000
    often = spark.range(many).selectExpr("xxhash64(id) h1", "100 n", "cast(id % 7 as int) step")
    tracemalloc.start()
    got = jaccard._most_frequent(often)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    want = np.array([r.h for r in spark.range(many).selectExpr("xxhash64(id) h").collect()], dtype=np.int64)
    assert got.dtype == np.uint64 and np.array_equal(got, np.sort(want.view(np.uint64)))
    assert most < 50 * many
    assert not len(jaccard._most_frequent(often.limit(0)))


def test_awkward_rows(spark, odd_docs, odd_rows, no_docs):
    got = jaccard.jaccard_components(odd_docs)
    want = brute({r[0]: r[1] for r in odd_rows if r[0] is not None})
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == want
    assert got.count() == len([r for r in odd_rows if r[0] is not None])
    assert jaccard.jaccard_components(no_docs).count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(7, 7), (3, 2)]
    random.Random(1).shuffle(edges)
    df = spark.createDataFrame(edges, "a long, b long")
    roots = {r.node: r.root for r in graph.components(df).collect()}
    assert roots == {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(300)}
    assert graph.components(df.limit(0)).count() == 0


def test_query(spark):
    texts = dict(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect())
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in op5_ngram_jaccard(spark, "/root/testdata/sf0.001").collect()}
    assert got == brute(texts)
