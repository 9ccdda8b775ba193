import random
import re

from rollbook.llm import licenses
from rollbook.llm.queries import op8_license_scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(lowered)
    at = [
        (i, name)
        for i in range(len(w))
        for name, p in licenses.PHRASES.items()
        if tuple(w[i : i + len(p)]) == p
    ]
    places = [i for i, _ in at]
    return (len(w), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({n for _, n in at})))


def test_base(spark, odd_docs, odd_rows):
    got = licenses.license_digest(odd_docs).collect()
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels"]
    assert sorted(str((r.doc_id, *(r[n] for n in names))) for r in got) == sorted(str((r[0], *brute(r[1]))) for r in odd_rows)
    marked = [r for r in got if r.doc_id == 14]
    assert {r.labels for r in marked} == {"all-rights-reserved,cc-by,cc-by-nc,reserved"}
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in got)


def test_spans_merge_neighbouring_diagonals(spark):
    whole = licenses.TEMPLATES["mit-permission"]
    changed = whole.replace("free of", "freely and without any of").replace("documentation", "docs")
    rows = [(1, "pre " + whole + " post"), (2, changed), (3, whole + " gap " * 9 + whole), (4, "permission is hereby")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    documents, spans = licenses.scan_licenses(docs)
    found = {}
    for s in spans.filter("label = 'mit-permission'").collect():
        found.setdefault(s.doc_id, []).append((s.first_word, s.last_word, round(s.coverage, 2)))
    n = len(whole.split())
    assert found[1] == [(1, n, 1.0)]
    assert len(found[2]) == 1 and 0.6 <= found[2][0][2] < 1.0
    assert sorted(found[3]) == [(0, n - 1, 1.0), (n + 9, 2 * n + 8, 1.0)]
    assert 4 not in found
    assert documents.count() == 4


def plain_spans(text, templates):
    """(label, first word, last word, coverage) by comparing every word with every template."""
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w, out = WORD.findall(lowered), []
    for label, template in templates.items():
        t = template.split()
        hits = {}
        for i in range(len(w) - 2):
            for j in range(len(t) - 2):
                if w[i : i + 3] == t[j : j + 3]:
                    hits.setdefault(i - j, []).append((i, j))
        groups, last = [], None
        for diagonal in sorted(hits):
            if last is None or diagonal - last > licenses.NEAR:
                groups.append([])
            groups[-1] += hits[diagonal]
            last = diagonal
        for g in groups:
            covered = {j + k for _, j in g for k in range(3)}
            if len(covered) >= licenses.COVER * len(t):
                out.append((label, min(i for i, _ in g), max(i for i, _ in g) + 2, round(len(covered) / len(t), 6)))
    return sorted(out)


def mixed_texts():
    """Templates whole, cut, with words changed, put in and left out, between other words."""
    rng, rows = random.Random(11), []
    names = sorted(licenses.TEMPLATES)
    for i in range(60):
        parts = []
        for _ in range(rng.randrange(4)):
            t = licenses.TEMPLATES[rng.choice(names)].split()
            for _ in range(rng.randrange(4)):
                at = rng.randrange(len(t))
                t[at : at + rng.randrange(3)] = [rng.choice(["the", "license", "OTHER", "É"])] * rng.randrange(3)
            parts += [" ".join(t).title() if rng.random() < 0.3 else " ".join(t), "filler " * rng.randrange(5)]
        rows.append((i, ", ".join(parts)))
    return rows


def test_labels_and_scores_against_brute_force(spark):
    rows = mixed_texts() + [(900, None), (901, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {i: plain_spans(t, licenses.TEMPLATES) for i, t in rows}
    assert sum(map(len, want.values())) > 60
    _, spans = licenses.scan_licenses(docs)
    got = {i: [] for i, _ in rows}
    for s in spans.collect():
        got[s.doc_id].append((s.label, s.first_word, s.last_word, round(s.coverage, 6)))
    assert {i: sorted(v) for i, v in got.items()} == want
    for r in licenses.license_digest(docs).collect():
        labels = {x[0] for x in want[r.doc_id]} | set(filter(None, r.base_labels.split(",")))
        assert r.labels == ",".join(sorted(labels))
        assert round(r.score, 6) == max((x[3] for x in want[r.doc_id]), default=0.0)


def test_own_templates_and_colliding_hashes(spark, monkeypatch):
    texts = {"long": " ".join(f"w{i % 50}x{i}" for i in range(400)), "short": "two words", "Mixed": "Some Words Here now"}
    docs = spark.createDataFrame([(1, "a " + texts["long"] + " b"), (2, "two words"), (3, "SOME words, here: now")], "doc_id long, text string")
    table = licenses.template_table(spark, texts)
    found = {(s.doc_id, s.label, s.coverage) for s in licenses.scan_licenses(docs, table)[1].collect()}
    assert found == {(1, "long", 1.0), (3, "Mixed", 1.0)}
    monkeypatch.setattr(licenses, "BROADCAST_GRAMS", 0)  # many templates: no broadcast
    assert {(s.doc_id, s.label, s.coverage) for s in licenses.scan_licenses(docs, table)[1].collect()} == found
    # every gram has one hash: the words alone decide
    monkeypatch.setattr(licenses.F, "xxhash64", lambda *c: licenses.F.lit(7).cast("long"))
    few = licenses.template_table(spark, {"Mixed": texts["Mixed"]})
    assert {(s.doc_id, s.label) for s in licenses.scan_licenses(docs, few)[1].collect()} == {(3, "Mixed")}


def test_only_ascii_letters_are_lowered(spark):
    docs = spark.createDataFrame([(1, "general public license GENERAL PUBLIC LICENSE"), (2, "\u212a\u212a cc by"), (3, "ALL RİGHTS RESERVED")], "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in licenses.license_digest(docs).collect()}
    assert got == {r.doc_id: brute(r.text) for r in docs.collect()}


def test_empty_and_query(spark, no_docs):
    assert licenses.license_digest(no_docs).count() == 0
    texts = dict(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect())
    for r in op8_license_scan(spark, "/root/testdata/sf0.001").collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(texts[r.doc_id])
