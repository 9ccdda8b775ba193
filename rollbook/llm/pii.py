"""Personal data by rules and a skip-chain conditional random field.

Exact rules find e-mail addresses, IP addresses, card numbers and phone numbers. A random
field over the tokens with a digit or an at sign labels what the rules alone miss: each
token has a potential from its shape and its neighbours, neighbouring tokens share one, and
so do repeated tokens of a document, however far apart and however many: all repeats of a
token meet in one shared node (the skip edges). Labels come from loopy message passing over
the whole document. The field is trained here, on the rules'
labels and on secrets that are assigned to a telling name.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice, takewhile

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import keep

KINDS = ("email", "ip", "card", "phone", "secret")  # in the order of spans that start together
OTHER = len(KINDS)  # label of a token that is no personal data

# The rules. Possessive runs and the look-behind change no match; they keep
# the search linear on long runs of digits.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

HINT = re.compile(r"[0-9@]")
BREAKS = frozenset(" \t\n\r\x0b\x0c\"'<>()[]{},;|")
BREAK_AHEAD = re.compile("[ \\t\\n\\r\\x0b\\x0c\"'<>()\\[\\]{},;|]")
NAMED_SECRET = re.compile(r"(?i)\b(?:token|secret|password|passwd|api_?key|key)\s*[=:]\s*[\"']?$")
SECRET_FORM = re.compile(r"(?i)(?=[^0-9]*+[0-9])(?=[^a-z]*+[a-z])[a-z0-9_+/=-]{16,}")

BUCKETS = 1 << 12
TRAIN_TOKENS = 20_000  # bound of the labelled sample that the field is fitted on
EPOCHS = 60
NEIGHBOUR_GAP = 24  # code points between tokens that count as neighbours
SKIP_STRENGTH = 3.0  # log-odds by which repeated tokens prefer one label
ROUNDS = 1_000  # of messages that do not settle; others stop by themselves
SETTLED = 1e-4  # largest change of a message that counts as settled
SURE = 0.9  # least marginal probability of a span that the field adds
CONTEXT = 40


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def email_spans(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the rules' matches, sorted; kinds may overlap each other."""
    found = []
    if "@" in text:
        found += [(a, 0, b) for a, b in email_spans(text)]
    if HINT.search(text):
        for m in IP.finditer(text):
            parts = [p.lstrip("0") for p in m.groups()]
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                found.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m.group().replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


def tokens_of(text: str) -> list[tuple[int, int]]:
    """Spans of the tokens that hold a digit or an at sign."""
    found, end = [], 0
    hint = HINT.search(text)
    while hint:
        start = hint.start()
        while start > end and text[start - 1] not in BREAKS:
            start -= 1
        ahead = BREAK_AHEAD.search(text, hint.end())
        end = ahead.start() if ahead else len(text)
        stop = end
        while stop > start and text[stop - 1] in ".:!?":
            stop -= 1
        found.append((start, max(stop, hint.end())))
        hint = HINT.search(text, end)
    return found


def shape(token: str) -> str:
    """Character classes with runs folded: ``555-7713`` gives ``0-0``."""
    token = re.sub(r"[0-9]+", "0", token)
    token = re.sub(r"[A-Z]+", "A", token)
    return re.sub(r"[^\W\d_A]+", "a", token)


def features(text: str, start: int, end: int) -> list[int]:
    """Hashed features of a token: its form, its length and the words around it."""
    token = text[start:end]
    before = text[max(0, start - CONTEXT) : start].lower().split()
    after = text[end : end + CONTEXT].lower().split()
    named = bool(NAMED_SECRET.search(text, max(0, start - CONTEXT), start))
    names = [
        "bias",
        f"shape {shape(token)}",
        f"length {min(len(token), 40) // 4}",
        f"digits {min(len(re.sub(r"[^0-9]+", "", token)), 20)}",
        f"before {before[-1][-12:] if before else ''}",
        f"before2 {before[-2][-12:] if len(before) > 1 else ''}",
        f"after {after[0][:12] if after else ''}",
        f"secret {named} {bool(SECRET_FORM.fullmatch(token))}",
        f"plus {text[max(0, start - 1) : start]!r}",
    ]
    return [zlib.crc32(n.encode("utf-8", "surrogatepass")) % BUCKETS for n in names]


def rule_labels(text: str, tokens: list[tuple[int, int]], base: list[tuple[int, int, int]]) -> list[int]:
    """Label of each token by the rules: the kind of a base span it touches, or a named secret."""
    labels, k = [], 0
    for start, end in tokens:
        while k < len(base) and base[k][2] <= start and base[k][0] < start:
            k += 1
        near = takewhile(lambda span: span[0] < end, islice(base, k, None))
        label = next((kind for _, kind, b in near if b > start), OTHER)
        if label == OTHER and SECRET_FORM.fullmatch(text, start, end):
            if NAMED_SECRET.search(text, max(0, start - CONTEXT), start):
                label = KINDS.index("secret")
        labels.append(label)
    return labels


@dataclass
class Field:
    """Potentials: of features x labels, of neighbouring labels, and of repeated tokens."""

    weights: np.ndarray
    neighbours: np.ndarray
    skip: float = SKIP_STRENGTH


def train_field(docs: DataFrame, most: int = TRAIN_TOKENS) -> Field:
    """Field fitted on at most ``most`` distinct tokens in their surroundings, from all documents.

    Those of the smallest hash are taken. The driver receives about that many rows of a
    few numbers; no text leaves the executors.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                if not text or not HINT.search(text):
                    continue
                tokens = tokens_of(text)
                labels = rule_labels(text, tokens, base_spans(text))
                last, before = -10**9, OTHER
                for (start, end), label in zip(tokens, labels, strict=True):
                    near = before if start - last <= NEIGHBOUR_GAP else -1
                    found = features(text, start, end)
                    spot = zlib.crc32(text[max(0, start - 20) : end].encode("utf-8", "surrogatepass"))
                    rows.append((spot, label, near, found))
                    last, before = end, label
            yield pd.DataFrame(rows, columns=["spot", "label", "near", "features"])

    columns = ["spot", "label", "near", "features"]
    tokens = keep(
        docs.select("text")
        .filter(F.col("text").isNotNull())
        .mapInPandas(run, "spot long, label int, near int, features array<int>")
        .groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("n")),
        "field-tokens",
    )
    # the hash is even, so about ``most`` tokens lie below this share of its range
    share = min(1.0, most / max(1, tokens.count()))
    sample = (
        tokens.filter(F.col("spot") < int(share * 2**32))
        .orderBy(*columns)
        .limit(most)
        .toPandas()
    )
    return fit_field(
        np.array(sample["features"].tolist(), dtype=np.int64),
        sample["label"].to_numpy(dtype=np.int64),
        sample["near"].to_numpy(dtype=np.int64),
    )


def fit_field(found: np.ndarray, labels: np.ndarray, near: np.ndarray) -> Field:
    """Token potentials by logistic regression, neighbour potentials from smoothed counts."""
    kinds = OTHER + 1
    weights = np.zeros((BUCKETS, kinds))
    if len(labels):
        target = np.eye(kinds)[labels]
        squares = np.full((BUCKETS, kinds), 1e-6)
        for _ in range(EPOCHS):
            logits = weights[found].sum(axis=1)
            logits -= logits.max(axis=1, keepdims=True)
            chance = np.exp(logits)
            chance /= chance.sum(axis=1, keepdims=True)
            slope = 1e-4 * weights
            np.add.at(slope, found.ravel(), np.repeat((chance - target) / len(labels), found.shape[1], axis=0))
            squares += slope**2
            weights -= 0.5 * slope / np.sqrt(squares)
    else:
        weights[:, OTHER] = 1.0
    counts = np.ones((kinds, kinds))
    pairs = near >= 0
    np.add.at(counts, (near[pairs], labels[pairs]), 1.0)
    joint = counts / counts.sum()
    gain = np.log(joint / (joint.sum(axis=1, keepdims=True) * joint.sum(axis=0, keepdims=True)))
    return Field(weights, np.clip(gain, -1.0, 1.0))


def half_link(skip: float, kinds: int) -> float:
    """Strength of a link of which two in a row tie their ends as one of strength ``skip``."""
    tie = np.sqrt(np.expm1(skip) / (np.expm1(skip) + kinds))
    return float(np.log1p(tie * (kinds - 1)) - np.log1p(-tie))


def marginals(
    field: Field,
    found: np.ndarray,
    chain: np.ndarray,
    skips: np.ndarray,
    shared: np.ndarray | None = None,
    owner: np.ndarray | None = None,
) -> np.ndarray:
    """Label probabilities of all tokens by loopy message passing.

    ``chain`` and ``skips`` are pairs of token numbers (first, second), ``shared`` pairs of a
    shared node and a token: any two tokens of a node are tied as by a skip link. All messages
    of a round are sent at once and averaged with the last, until they settle. ``owner`` is the
    number of each token's text (default: one text): a text's messages stop when they have
    settled, so its probabilities do not depend on the texts beside it.
    """
    tokens = len(found)
    shared = np.zeros((0, 2), np.int64) if shared is None else shared.reshape(-1, 2).astype(np.int64)
    own = field.weights[found].sum(axis=1)
    own -= own.max(axis=1, keepdims=True)
    kinds = own.shape[1]
    if len(shared):
        own = np.concatenate([own, np.zeros((int(shared[:, 0].max()) + 1, kinds))])
    ties = [
        field.neighbours,
        np.eye(kinds) * field.skip,
        np.eye(kinds) * half_link(field.skip, kinds),
    ]
    pair = np.repeat(np.stack(ties), [len(chain), len(skips), len(shared)], axis=0)
    edges = np.concatenate(
        [chain.reshape(-1, 2), skips.reshape(-1, 2), shared + np.array([tokens, 0])]
    ).astype(np.int64)
    if not len(edges):
        beliefs = own
    else:
        sender = np.concatenate([edges[:, 0], edges[:, 1]])
        taker = np.concatenate([edges[:, 1], edges[:, 0]])
        pair = np.concatenate([pair, pair.transpose(0, 2, 1)])  # [message, from label, to label]
        back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
        sent = np.zeros((len(sender), kinds))
        owner = np.zeros(tokens, dtype=np.int64) if owner is None else owner
        text_of = np.concatenate([owner[edges[:, 1]], owner[edges[:, 1]]])  # of each message
        going = np.arange(len(sender))
        for _ in range(ROUNDS):
            beliefs = own.copy()
            np.add.at(beliefs, taker, sent)
            free = beliefs[sender[going]] - sent[back[going]]
            new = np.logaddexp.reduce(free[:, :, None] + pair[going], axis=1)
            new -= new.max(axis=1, keepdims=True)
            moved = np.zeros(len(text_of) and int(text_of.max()) + 1)
            np.maximum.at(moved, text_of[going], np.abs(new - sent[going]).max(axis=1))
            sent[going] = 0.5 * (sent[going] + new)
            going = going[moved[text_of[going]] >= SETTLED]
            if not len(going):
                break
        beliefs = own.copy()
        np.add.at(beliefs, taker, sent)
    beliefs = beliefs[:tokens] - beliefs[:tokens].max(axis=1, keepdims=True)
    chance = np.exp(beliefs)
    return chance / chance.sum(axis=1, keepdims=True)


def field_spans(
    field: Field, texts: list[str], bases: list[list[tuple[int, int, int]]]
) -> list[list[tuple[int, int, int, float]]]:
    """(start, kind, end, probability) of the spans that the field adds to each text's base.

    Adjoining tokens of one kind make one span; a token that touches a base span adds none.
    """
    starts, ends, owner, found, chain, skips, shared = [], [], [], [], [], [], []
    hubs = 0
    for number, text in enumerate(texts):
        seen: dict[str, list[int]] = {}
        last = -10**9
        for start, end in tokens_of(text):
            node = len(starts)
            starts.append(start)
            ends.append(end)
            owner.append(number)
            found.append(features(text, start, end))
            if start - last <= NEIGHBOUR_GAP:
                chain.append((node - 1, node))
            last = end
            # similar tokens: equal but for case and signs, and long enough to be no chance
            key = re.sub(r"[\W_]+", "", text[start:end]).lower()
            if len(key) >= 6:
                seen.setdefault(key, []).append(node)
        for nodes in seen.values():
            if len(nodes) == 2:
                skips.append(tuple(nodes))
            elif len(nodes) > 2:
                shared += [(hubs, node) for node in nodes]
                hubs += 1
    added: list[list[tuple[int, int, int, float]]] = [[] for _ in texts]
    if not starts:
        return added
    chance = marginals(field, np.array(found), np.array(chain), np.array(skips), np.array(shared), np.array(owner))
    label = chance.argmax(axis=1)
    for node in np.flatnonzero((label != OTHER) & (chance.max(axis=1) >= SURE)):
        number, start, end = owner[node], starts[node], ends[node]
        kind, sure = int(label[node]), float(chance[node].max())
        if any(a < end and b > start for a, _, b in bases[number]):
            continue
        spans = added[number]
        if spans and spans[-1][1] == kind and start - spans[-1][2] <= 2:
            spans[-1] = (spans[-1][0], kind, end, min(spans[-1][3], sure))
        else:
            spans.append((start, kind, end, sure))
    return added


SPANS = "array<struct<kind: string, start: int, end: int, base: boolean, score: double>>"


def find_pii(docs: DataFrame, field: Field, *carry: Column) -> DataFrame:
    """The ``carry`` columns (default doc_id) and ``spans_`` of every whole text, in order.

    Offsets count code points, ends are exclusive. Null and empty texts have no spans.
    Repeated rows are searched one by one; all repeats of a token in a text
    share one node, so skip edges grow with the text only.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)
    rows = docs.select(*(carry or (F.col("doc_id"),)), F.col("text").alias("text_"))
    kept = [f for f in rows.schema.fields if f.name != "text_"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text_"].fillna("").tolist()
            hot = [i for i, t in enumerate(texts) if HINT.search(t)]
            bases = [base_spans(texts[i]) for i in hot]
            added = field_spans(shared.value, [texts[i] for i in hot], bases)
            out: list[list] = [[] for _ in texts]
            for i, base, more in zip(hot, bases, added, strict=True):
                every = [(a, k, b, True, 1.0) for a, k, b in base]
                every += [(a, k, b, False, s) for a, k, b, s in more]
                out[i] = [
                    {"kind": KINDS[k], "start": a, "end": b, "base": x, "score": s}
                    for a, k, b, x, s in sorted(every)
                ]
            done = batch[[f.name for f in kept]].copy()
            done["spans_"] = out
            yield done

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return rows.mapInPandas(run, f"{schema}, spans_ {SPANS}" if schema else f"spans_ {SPANS}")


def pii_digest(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id, counts per base kind, hash of the base spans and the list of all spans."""

    def listed(spans: Column) -> Column:
        one = F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        )
        return F.array_join(one, ",")

    base = F.filter("spans_", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return find_pii(docs, field).select(
        "doc_id",
        *[count(k) for k in KINDS[:4]],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans_")).alias("spans"),
    )


def redact(docs: DataFrame, field: Field) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; all columns are kept.

    Overlapping spans become one, named by the first. ``n_chars``, if there, follows.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row_")
    found = find_pii(docs, field, row)
    text = F.col("row_.text")
    spans = F.filter("spans_", lambda s: s["end"] > s["start"])
    step = F.aggregate(
        spans,
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda a, s: F.when(s["start"] < a["at"], F.struct(a["out"].alias("out"), F.greatest(a["at"], s["end"]).alias("at"))).otherwise(
            F.struct(
                F.concat(
                    a["out"],
                    F.substring(text, a["at"] + 1, s["start"] - a["at"]),
                    F.lit("["), s["kind"], F.lit("]"),
                ).alias("out"),
                s["end"].alias("at"),
            )
        ),
        lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))),
    )
    clean = F.when(F.size(spans) == 0, text).otherwise(step)
    columns = []
    for c in docs.columns:
        value = F.col(f"row_.`{c}`")
        if c == "text":
            value = F.col("clean_")
        elif c == "n_chars":
            value = F.coalesce(F.length("clean_").cast("long"), value)
        columns.append(value.alias(c))
    return found.select("row_", clean.alias("clean_")).select(*columns)
