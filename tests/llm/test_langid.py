import zlib

import numpy as np
import pytest

from rollbook.llm import langid
from rollbook.llm.queries import op2_language_id


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    truth = dict(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect())
    rows = op2_language_id(spark, folder).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    held = [r.lang_pred == truth[r.doc_id] for r in rows if r.held_out]
    assert len(held) > 100 and np.mean(held) > 0.97


def test_matches_plain_bayes(spark):
    rows = [(1, "der hund und die katze", "de"), (2, "the dog and the cat", "en"), (3, "un chat et le chien", "fr"), (4, None, "en"), (5, "le", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    counts = {lang: sum(langid.bucket_counts(t) for _, t, x in rows if x == lang and t) for lang in ("de", "en", "fr")}
    for text in ("die", "The Cat", "chien " * 40_000):
        found = langid.bucket_counts(text)
        logs = []
        for lang, prior in (("de", 1 / 4), ("en", 2 / 4), ("fr", 1 / 4)):
            smooth = counts[lang] + langid.SMOOTHING
            logs.append(np.log(prior) + found @ np.log(smooth / smooth.sum()))
        lang, score = model.predict(["x", text, None, text])[1]
        assert lang == ("de", "en", "fr")[int(np.argmax(logs))]
        assert score == pytest.approx(1 / np.exp(logs - max(logs)).sum(), rel=1e-9, abs=1e-12)


def test_awkward_rows(spark, odd_docs, odd_rows, no_docs):
    out = langid.predict_languages(odd_docs, langid.fit(odd_docs)).collect()
    assert len(out) == len(odd_rows)
    by_id = {r.doc_id: r for r in out}
    assert all(by_id[i].lang_pred == "und" for i in (3, 4, 5))
    assert {r.lang_pred for r in out} <= {"en", "fr", "und"}
    empty = langid.fit(no_docs)
    assert langid.predict_languages(no_docs, empty).count() == 0
    assert {r.lang_pred for r in langid.predict_languages(odd_docs, empty).collect()} == {"und"}


def test_a_batch_scores_like_single_texts(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "aé b c", "x"), (2, "d e f g", "y")], "doc_id long, text string, lang string")
    model = langid.fit(docs)
    texts = ["a", "b c d", None, "", "12", "é" * 50, "g f e d c b a " * 9, "a"]
    alone = [model.predict([t])[0] for t in texts]
    assert model.predict(texts) == alone
    monkeypatch.setattr(langid, "STEP", 7)
    assert [lang for lang, _ in model.predict(texts)] == [lang for lang, _ in alone]
    assert [s for _, s in model.predict(texts)] == pytest.approx([s for _, s in alone])


def test_too_many_languages_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(langid, "LANGUAGES", 2)
    docs = spark.createDataFrame([(i, "text", f"l{i}") for i in range(3)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError):
        langid.fit(docs)


def test_clashing_names(odd_docs):
    named = odd_docs.withColumnRenamed("key_", "text_").withColumnRenamed("weight", "lang_pred")
    assert langid.predict_languages(named, langid.fit(named)).count() == odd_docs.count()
