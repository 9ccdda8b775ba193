import hashlib
import random

import numpy as np
import pytest

from rollbook.llm import suffix_dedup
from rollbook.llm.queries import op4_suffix_dedup


def brute(texts):
    """doc_id -> (n_bytes, n_removed, n_spans, hash of the rest), string by string."""
    first, out = {}, {}
    for i in sorted(texts):
        data = (texts[i] or "").encode()
        gone = np.zeros(len(data), dtype=bool)
        for p in range(len(data) - 49):
            if first.setdefault(data[p : p + 50], i) < i:
                gone[p : p + 50] = True
        runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        rest = np.frombuffer(data, np.uint8)[~gone].tobytes()
        out[i] = (len(data), int(gone.sum()), runs, hashlib.sha256(rest).hexdigest())
    return out


def digest(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


def tangled(seed):
    """Passages cut at odd places, overlapping, repeated within and across documents."""
    rng = random.Random(seed)
    stock = ["".join(rng.choice("abcdé ") for _ in range(rng.randrange(30, 200))) for _ in range(25)]
    texts = {}
    for i in range(120):
        parts = []
        for _ in range(rng.randrange(0, 6)):
            s = rng.choice(stock)
            a = rng.randrange(0, 20)
            parts.append(s[a : len(s) - rng.randrange(0, 20)] if rng.random() < 0.5 else s)
            parts.append("".join(rng.choice("xyz") for _ in range(rng.randrange(0, 30))))
        texts[i * 3] = "".join(parts)
    texts |= {1: "a" * 300, 4: "a" * 120, 7: "ab" * 90, 10: "ab" * 200 + "c", 13: "The " * 200, 16: "The " * 70, 19: "z" * 49, 22: "z" * 50, 25: "z" * 50, 28: None, 31: ""}
    return texts


@pytest.mark.parametrize(
    "seed, bucket, step, many, cut, hot",
    [
        (1, 300_000, 1 << 20, 64, 2_000, 50_000),
        (2, 50, 1 << 10, 2, 2, 50_000),
        (3, 500, 256, 1, 3, 3),
        (4, 50, 256, 64, 1, 2),
        (5, 300_000, 1 << 20, 64, 1, 50_000),
    ],
)
def test_against_brute_force(spark, monkeypatch, seed, bucket, step, many, cut, hot):
    monkeypatch.setattr(suffix_dedup, "CUT_CONTEXTS", cut)
    monkeypatch.setattr(suffix_dedup, "MANY_CONTEXTS", many)
    monkeypatch.setattr(suffix_dedup, "HOT_CONTEXTS", hot)
    monkeypatch.setattr(suffix_dedup, "BUCKET_ANCHORS", bucket)
    monkeypatch.setattr(suffix_dedup, "STEP", step)
    texts = tangled(seed)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    assert digest(suffix_dedup.dedup_digest(docs)) == brute(texts)


def test_suffix_order_is_sorted():
    rng = np.random.default_rng(4)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    data[1000:1400] = data[:400]
    data = np.concatenate([data, np.full(200, 97, np.uint8)])
    at = np.arange(3100)
    group = (at % 3).astype(np.int64)
    order = suffix_dedup.suffix_order(data, suffix_dedup.PrefixHashes(data), at, group, 50)
    keys = [(group[i], data[at[i] : at[i] + 50].tobytes()) for i in order]
    assert keys == sorted(keys) and sorted(order) == list(range(3100))


def test_awkward_rows(spark, odd_docs, odd_rows, no_docs):
    got = suffix_dedup.dedup_digest(odd_docs).collect()
    assert len(got) == len(odd_rows)
    want = brute({r[0]: r[1] for r in odd_rows if r[0] is not None})
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got if r.doc_id is not None} == want
    assert [r.n_removed for r in got if r.doc_id is None] == [0]
    assert suffix_dedup.dedup_digest(no_docs).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    texts = dict(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect())
    assert digest(op4_suffix_dedup(spark, folder)) == brute(texts)
