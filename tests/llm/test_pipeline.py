import re

import corpus_pipeline
import pytest

from rollbook.llm.queries import all_queries
from rollbook.llm.oracles import all_oracles
import __spark_entry__ as entry_file
import compare

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_every_query_is_registered():
    assert set(all_queries()) | {"pipeline"} <= set(entry_file.queries())
    assert set(all_oracles()) <= set(all_queries())


@pytest.mark.parametrize("name", sorted(all_oracles()))
def test_query_matches_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    assert compare.differences(all_queries()[name](spark, folder), compare.connect(folder), all_oracles()[name]) == []


def test_stages_against_brute_force(spark, tmp_path):
    from test_jaccard import brute as similar
    from test_pii import brute as personal
    from test_quality import brute as counted

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, rows = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        rows[name] = docs.collect()
        assert name == "best-fit packing" or docs.columns == columns
    source = spark.read.parquet(f"{folder}/documents.parquet").collect()
    good, single, masked, mixed, packed = rows.values()
    # too few labels to certify a cutoff here: the base rules alone decide
    assert sorted(r.doc_id for r in good) == sorted(r.doc_id for r in source if not counted(r.text)[-1])
    roots = similar({r.doc_id: r.text for r in good}, corpus_pipeline.NEAR_NGRAM, corpus_pipeline.NEAR_PERCENT)
    assert (corpus_pipeline.NEAR_NGRAM, corpus_pipeline.NEAR_PERCENT) == (5, 80)
    assert sorted(r.doc_id for r in single) == sorted(i for i, (_, root) in roots.items() if root == i)
    texts = {r.doc_id: r.text for r in single}
    assert sorted(texts) == sorted(r.doc_id for r in masked)
    for r in masked:
        assert not personal(r.text) and (personal(texts[r.doc_id]) or len(r.text) <= len(texts[r.doc_id]))
    size = {r.doc_id: len(WORD.findall(r.text)) for r in masked}
    times = {}
    for r in mixed:
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    assert set(times) <= set(size) and max(times.values()) <= 2
    total = sum(size.values())
    assert abs(sum(size[i] * n for i, n in times.items()) - 1.5 * total) < 0.05 * total
    assert {r.doc_id for r in packed} == set(times)
    fills = {}
    for r in packed:
        fills[r.sequence_id] = fills.get(r.sequence_id, 0) + r.length
    assert max(fills.values()) <= 1024


def test_empty_documents(spark, no_labels, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    no_labels.write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_awkward_rows_pass_all_stages(spark, odd_docs, no_labels, tmp_path):
    no_labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs = odd_docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert name == "best-fit packing" or out.columns == odd_docs.columns
        docs = out
    assert docs.count() > 0
