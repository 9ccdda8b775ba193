import re

import pytest

from rollbook.llm import mixing
from rollbook.llm.queries import op6_source_mix


def targets(sizes):
    """Water filling, one full source at a time."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    budget, full = 1.5 * sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in full]
        if not rest:
            return full
        left = budget - sum(full.values())
        share = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        over = [s for s in rest if share[s] > 2 * sizes[s] + 1e-9]
        if not over:
            return full | share
        full |= {s: 2.0 * sizes[s] for s in over}


def check(rows):
    sizes, taken, longest = {}, {}, {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
        longest[r.source] = max(longest.get(r.source, 0), r["size"])
    want = targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert r.taken in (0, r["size"], 2 * r["size"])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= longest[s] / 2 + 1e-6


def test_hot_and_tiny_sources(spark, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_PER_RANGE", 100)  # several ranges on few rows
    rows = [(i, "hot", 10 + i % 90) for i in range(3000)] + [(5000 + i, ("a", "z", None)[i % 3], i % 50) for i in range(200)]
    sized = spark.createDataFrame(rows, "doc_id long, source string, size long")
    first, again = (mixing.mix(sized.repartition(n)).collect() for n in (2, 5))
    check(first)
    assert sorted(map(str, first)) == sorted(map(str, again))


def test_quality_weights_favour_good_documents(spark):
    rows = [(i, "big" if i < 2000 else "small", 10) for i in range(4000)]
    sized = spark.createDataFrame(rows, "doc_id long, source string, size long")
    labels = spark.range(4000).selectExpr("id as doc_id", "cast(id % 2 as int) as quality")
    mixed = mixing.mix(sized, mixing.quality_weights(labels), share=1.0)
    means = {r.good: r.m for r in mixed.filter("source = 'small'").groupBy((mixed.doc_id % 2 == 1).alias("good")).agg({"copies": "avg"}).withColumnRenamed("avg(copies)", "m").collect()}
    assert means[True] > means[False]


def test_awkward_rows(spark, odd_docs, odd_rows, no_docs, no_labels):
    rows = mixing.mix(mixing.sizes(odd_docs), mixing.quality_weights(no_labels)).collect()
    assert len(rows) == len(odd_rows)
    check(rows)
    assert mixing.mix(mixing.sizes(no_docs)).count() == 0
    blank = spark.createDataFrame([(1, "s", 0)], "doc_id long, source string, size long")
    assert mixing.mix(blank).first().taken == 0


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op6_source_mix(spark, folder).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", docs[r.doc_id].text or ""))
