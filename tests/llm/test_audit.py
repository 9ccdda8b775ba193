import random
import re
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest

from compare import connect, differences
from rollbook.llm import audit
from rollbook.llm.oracles import OP11
from rollbook.llm.queries import op11_filter_audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_measures(text):
    words = WORD.findall(text)
    return (len(words), len(set(words)), len(re.findall("[A-Z]", text)), len(text), len(re.findall(r"[#$%&*|]", text)))


def test_transducer_against_regular_expressions(monkeypatch):
    monkeypatch.setattr(audit, "STEP", 40)  # texts in many passes, and longer than one
    rng = random.Random(5)
    texts = ["".join(rng.choice("aaAB #$ \t\n\x1c\x85 éß日𝄞") for _ in range(rng.randrange(90))) for _ in range(400)]
    texts += ["", None, " ", "word", "x" * 500, "a b " * 300]
    found = audit.measures(pa.array(texts, pa.string()))
    assert list(zip(*[v.tolist() for v in found.values()])) == [plain_measures(t or "") for t in texts]


def test_words_of_equal_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(audit, "mix64", lambda h: h & np.uint64(3))  # nearly all words collide
    found = audit.measures(pa.array(["a b c d a b " * 4 + "a", "d c b a", "abcd dcba abcd"]))
    assert found["n_distinct"].tolist() == [4, 4, 2]


def plain_audit(rows, labels):
    first = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            first[text or ""] = min(doc_id, first.get(text or "", doc_id))
    docs = []
    for doc_id, text, source in rows:
        words, distinct, capitals, points, symbols = plain_measures(text or "")
        fails = "".join(
            f for f, x in zip("ABCDE", (
                words < 200, 100 * distinct < 50 * words, 100 * capitals > 2 * points, symbols > 0,
                doc_id is not None and first[text or ""] < doc_id,
            )) if x
        )
        marks = [m for d, *m in labels if d == doc_id and d is not None]
        docs.append((source or "", fails, any(q == 1 for q, _ in marks), any(t == 1 for _, t in marks)))
    out = {}
    shapley = {}
    for part in {d[0] for d in docs}:
        for order in map("".join, permutations("ABCDE")):
            left = [d for d in docs if d[0] == part]
            for k, f in enumerate(order):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                failing = [d for d in docs if d[0] == part and f in d[1]]
                shapley[part, f] = shapley.get((part, f), 0) + len(gone)
                out[part, order, k + 1] = (
                    len(left), len(gone), len(failing) - len(gone), sum(d[1] == f for d in failing),
                    sum(d[2] for d in gone), sum(d[3] for d in gone),
                )
    return {(p, o, k, *v, shapley[p, o[k - 1]]) for (p, o, k), v in out.items()}


def test_awkward_rows(spark, odd_docs, odd_rows, no_docs, no_labels):
    labels = [(i, i % 2, (i // 2) % 2) for i in range(15)] + [(3, 0, 1), (3, 1, 0), (None, 1, 1), (99, 1, 1), (5, None, None)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = [(r[0], r[1], r[3]) for r in odd_rows]
    got = {tuple(r) for r in audit.filter_audit(odd_docs, table).collect()}
    assert got == plain_audit(rows, labels)
    unlabelled = {tuple(r) for r in audit.filter_audit(odd_docs, no_labels).collect()}
    assert unlabelled == plain_audit(rows, [])
    assert audit.filter_audit(no_docs, table).count() == 0


def test_carried_columns_may_have_any_name(odd_docs):
    named = odd_docs.withColumnRenamed("key_", "copy").withColumnRenamed("weight", "fails")
    assert audit.failing_sets(named.withColumnRenamed("n", "part")).count() == odd_docs.count()


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_query(spark, folder):
    got = op11_filter_audit(spark, folder)
    assert differences(got, connect(folder), OP11) == []
