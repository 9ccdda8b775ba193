import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rollbook.llm import pii
from rollbook.llm.queries import op7_personal_data

PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def valid(kind, text):
    digits = [int(c) for c in text if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        back = digits[::-1]
        luhn = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(back)) % 10 == 0
        return 14 <= len(digits) <= 19 and luhn
    return kind == "email" or 10 <= len(digits) <= 15


def brute(text):
    found = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        found += [(m.start(), k, m.end()) for m in pattern.finditer(text or "") if valid(kind, m.group())]
    return sorted(found)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="01259+-. ()@ab_é", max_size=60))
def test_rules_equal_the_plain_patterns(text):
    assert pii.base_spans(text) == brute(text)


def test_rules_on_written_cases():
    text = "x_y@b.c_d@e.f-g 300.1.1.1.2.3.4 4111 1111 1111 1111 +1 (212) 555-0199 a@b.c."
    assert pii.base_spans(text) == brute(text) and len(brute(text)) == 4
    assert pii.base_spans("1" * 200_000 + "@" * 50_000) == []


def test_repeated_token_takes_the_label_of_its_twin():
    """A secret that is named once is found again, far away and without its name."""
    other = "0123abcd4567ef890123abcd4567ef89"
    secret = "feedbeef0123456789abcdef01234567"
    text = f'token = "{secret}" ' + "word " * 3000 + f"see {secret} but not 12 or 77"
    weights = np.zeros((pii.BUCKETS, pii.OTHER + 1))
    named, bare = (pii.features(t, t.index(secret), t.index(secret) + len(secret)) for t in (f'token = "{secret}"', f"see {secret} but"))
    weights[[b for b in named if b not in bare], pii.KINDS.index("secret")] = 3.0
    weights[named[0], pii.OTHER] = 1.5
    field = pii.Field(weights, np.zeros((pii.OTHER + 1, pii.OTHER + 1)), skip=6.0)
    spans = pii.field_spans(field, [text, f"see {other} but"], [[], []])
    assert [text[a:b] for a, _, b, _ in spans[0]] == [secret, secret] and spans[1] == []
    lone = pii.field_spans(pii.Field(weights, field.neighbours, skip=0.0), [text], [[]])
    assert len(lone[0]) == 1


def test_every_repeat_of_a_named_secret_takes_its_label():
    """Fifty bare repeats with evidence for nothing: all are in reach of the one that is named."""
    secret = "feedbeef0123456789abcdef01234567"
    text = f'token = "{secret}" ' + ("word " * 20 + f"see {secret} but ") * 50
    named, bare = (pii.features(t, t.index(secret), t.index(secret) + len(secret)) for t in (f'token = "{secret}"', f"see {secret} but"))
    kind = pii.KINDS.index("secret")
    weights = np.zeros((pii.BUCKETS, pii.OTHER + 1))
    weights[named[0]] = [0.0 if k in (kind, pii.OTHER) else -9.0 for k in range(pii.OTHER + 1)]
    weights[[b for b in named if b not in bare], kind] = 3.0
    field = pii.Field(weights, np.zeros((pii.OTHER + 1, pii.OTHER + 1)))
    spans = pii.field_spans(field, [text, f"see {secret} but"], [[], []])
    assert [(text[a:b], k) for a, k, b, _ in spans[0]] == [(secret, kind)] * 51 and spans[1] == []


@pytest.mark.parametrize("kinds, skip", [(2, 3.0), (6, 3.0), (6, 0.0), (3, 7.5)])
def test_shared_node_ties_two_tokens_like_a_link(kinds, skip):
    rng = np.random.default_rng(kinds)
    field = pii.Field(rng.normal(size=(pii.BUCKETS, kinds)), np.zeros((kinds, kinds)), skip)
    found, none = rng.integers(0, pii.BUCKETS, (2, 5)), np.zeros((0, 2))
    linked = pii.marginals(field, found, none, np.array([(0, 1)]))
    assert pii.marginals(field, found, none, none, np.array([(0, 0), (0, 1)])) == pytest.approx(linked, abs=1e-3)


def test_messages_equal_enumeration_on_a_tree():
    rng = np.random.default_rng(2)
    field = pii.Field(rng.normal(size=(pii.BUCKETS, 3)), rng.normal(size=(3, 3)), skip=1.3)
    found = rng.integers(0, pii.BUCKETS, (4, 5))
    chain, skips = np.array([(0, 1), (1, 2)]), np.array([(1, 3)])
    own = field.weights[found].sum(axis=1)
    want = np.zeros((4, 3))
    for labels in np.ndindex(3, 3, 3, 3):
        score = sum(own[i, x] for i, x in enumerate(labels))
        score += sum(field.neighbours[labels[a], labels[b]] for a, b in chain)
        score += sum(field.skip * (labels[a] == labels[b]) for a, b in skips)
        for i, x in enumerate(labels):
            want[i, x] += np.exp(score)
    want /= want.sum(axis=1, keepdims=True)
    assert pii.marginals(field, found, chain, skips) == pytest.approx(want, abs=1e-2)


def base_hash(text):
    return hashlib.sha256(",".join(f"{list(PLAIN)[k]}:{a}:{b}" for a, k, b in brute(text)).encode()).hexdigest()


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    texts = dict(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect())
    rows = op7_personal_data(spark, folder).collect()
    assert len(rows) == len(texts)
    added = 0
    for r in rows:
        base = brute(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == n for _, k, _ in base) for n in range(4)]
        assert r.base_sha256 == base_hash(texts[r.doc_id])
        spans = [tuple(s.split(":")) for s in r.spans.split(",") if s]
        assert {(list(PLAIN)[k], str(a), str(b)) for a, k, b in base} <= set(spans)
        for kind, a, b in set(spans) - {(list(PLAIN)[k], str(a), str(b)) for a, k, b in base}:
            assert re.search("[0-9]", texts[r.doc_id][int(a) : int(b)])
            added += 1
    assert added > 0


def test_awkward_rows(spark, odd_docs, odd_rows, no_docs):
    field = pii.train_field(odd_docs)
    assert sorted((str(r.doc_id), r.base_sha256) for r in pii.pii_digest(odd_docs, field).collect()) == sorted((str(r[0]), base_hash(r[1])) for r in odd_rows)
    clean = pii.redact(odd_docs, field)
    assert clean.columns == odd_docs.columns and clean.count() == len(odd_rows)
    masked = clean.filter("doc_id = 10").first()
    assert "Mail [email] or [phone], host [ip]." in masked.text and masked.n_chars == len(masked.text)
    assert pii.redact(no_docs, pii.train_field(no_docs)).count() == 0


def test_a_secret_is_judged_as_a_whole():
    secret = "key=" + "a1" * 128
    for tail, want in (("", "secret"), ("~~~%%%", None)):
        text = secret + tail + " end"
        tokens = pii.tokens_of(text)
        labels = pii.rule_labels(text, [(4, e) for _, e in tokens], [])
        assert labels == [pii.KINDS.index("secret") if want else pii.OTHER]
    assert pii.shape("a" * 70 + "-9") == "a-0"


def test_a_token_may_touch_many_base_spans():
    text = "1.1.1.1" + "/2.2.2.2" * 20
    base = pii.base_spans(text)
    late = [(base[15][0], len(text))]
    assert len(base) > 16 and pii.rule_labels(text, late, base) == [pii.KINDS.index("ip")]


def test_probabilities_do_not_depend_on_other_texts():
    rng = np.random.default_rng(6)
    field = pii.Field(rng.normal(size=(pii.BUCKETS, 6)), rng.normal(size=(6, 6)))
    found = rng.integers(0, pii.BUCKETS, (12, 9))
    chain = np.array([(0, 1), (1, 2), (4, 5), (5, 6), (6, 7), (9, 10)])
    skips = np.array([(0, 2), (4, 7), (9, 11)])
    owner = np.repeat([0, 1, 2], [4, 5, 3])
    together = pii.marginals(field, found, chain, skips, None, owner)
    for text, low, high in ((0, 0, 4), (1, 4, 9), (2, 9, 12)):
        own = [x[(x[:, 0] >= low) & (x[:, 0] < high)] - low for x in (chain, skips)]
        assert np.array_equal(pii.marginals(field, found[low:high], *own), together[low:high])
