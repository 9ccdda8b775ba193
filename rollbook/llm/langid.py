"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counting and scoring run inside the scan, batch by batch in numpy. Only counts by language
and bucket are shuffled, and only the log-probability matrix (buckets x languages) is
broadcast; its size depends on the number of languages, not on the number of documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS_LOG2 = 15
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
STEP = 1 << 18  # code points per numpy pass: bounds the memory for any text
UNKNOWN = "und"
LANGUAGES = 256  # of a model at most: bounds what is collected and broadcast
LETTER = re.compile(r"[^\W\d_]")
# odd multipliers of the n-gram hash, one per place
MIX = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)


def gram_buckets(codes: np.ndarray, order: int) -> np.ndarray:
    """Bucket of each n-gram of a code point array."""
    n = len(codes) - order + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint32)
    h = np.full(n, order * 0x27D4EB2F & 0xFFFFFFFF, dtype=np.uint32)
    for place in range(order):
        h += codes[place : place + n]
        h *= np.uint32(MIX[place])
        h ^= h >> np.uint32(15)
    return h >> np.uint32(32 - BUCKETS_LOG2)


def bucket_counts(text: str) -> np.ndarray:
    """Counts per bucket of all n-grams of a whole text, lower-cased, in bounded steps."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    counts = np.zeros(1 << BUCKETS_LOG2, dtype=np.int64)
    for start in range(0, len(codes), STEP):
        for order in ORDERS:
            part = codes[start : start + STEP + order - 1]
            counts += np.bincount(gram_buckets(part, order), minlength=len(counts))
    return counts


@dataclass
class Model:
    languages: list[str]
    log_prior: np.ndarray
    log_prob: np.ndarray  # buckets x languages

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and posterior probability of each text, scored many at a time."""
        known = [i for i, t in enumerate(texts) if self.languages and t and LETTER.search(t)]
        out = [(UNKNOWN, 0.0)] * len(texts)
        codes = [
            np.frombuffer(texts[i].lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
            for i in known
        ]
        at = 0
        while at < len(known):
            stop, size = at + 1, len(codes[at])
            while stop < len(known) and size + len(codes[stop]) <= STEP:
                size += len(codes[stop])
                stop += 1
            for i, logs in zip(known[at:stop], self._score(codes[at:stop]), strict=True):
                best = int(np.argmax(logs))
                out[i] = (self.languages[best], float(1.0 / np.exp(logs - logs[best]).sum()))
            at = stop
        return out

    def _score(self, texts: list[np.ndarray]) -> np.ndarray:
        """Log posteriors (texts x languages), up to a constant per text.

        The n-grams of all texts are the entries of one sparse count matrix, row by row; its
        product with the log probabilities is summed per row in doubles. A text longer than a
        step comes alone and is summed in steps.
        """
        logs = np.repeat(self.log_prior[None, :], len(texts), axis=0)
        joined = np.concatenate(texts)
        ends = np.cumsum([len(t) for t in texts])
        step = max(1, STEP * 4 // max(4, len(self.languages)))
        for order in ORDERS:
            for start in range(0, len(joined), step):
                buckets = gram_buckets(joined[start : start + step + order - 1], order)
                row = np.searchsorted(ends, np.arange(start, start + len(buckets)), side="right")
                whole = np.arange(start, start + len(buckets)) + order <= ends[row]
                buckets, row = buckets[whole], row[whole]
                if len(row):
                    heads = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
                    logs[row[heads]] += np.add.reduceat(self.log_prob[buckets], heads, axis=0)
        return logs


def count_grams(docs: DataFrame) -> DataFrame:
    """(lang, bucket, n): n-gram counts, and documents per language at bucket -1."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[str, np.ndarray] = {}
        seen: dict[str, int] = {}
        for batch in batches:
            for text, lang in zip(batch["text"], batch["lang"], strict=True):
                seen[lang] = seen.get(lang, 0) + 1
                if text:
                    counts = bucket_counts(text)
                    totals[lang] = totals[lang] + counts if lang in totals else counts
            if len(totals) > 64:  # many languages: hand on early, the memory stays bounded
                yield _rows(totals, seen)
                totals, seen = {}, {}
        yield _rows(totals, seen)

    def _rows(totals: dict[str, np.ndarray], seen: dict[str, int]) -> pd.DataFrame:
        langs, buckets, counts = list(seen), [np.full(len(seen), -1)], [np.array(list(seen.values()))]
        for lang, total in totals.items():
            found = np.flatnonzero(total)
            langs += [lang] * len(found)
            buckets.append(found)
            counts.append(total[found])
        return pd.DataFrame(
            {
                "lang": np.array(langs, dtype=object),
                "bucket": np.concatenate(buckets).astype(np.int32),
                "n": np.concatenate(counts).astype(np.int64),
            }
        )

    return (
        docs.select("text", "lang")
        .mapInPandas(run, "lang string, bucket int, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
    )


def fit(labelled: DataFrame) -> Model:
    """Model of all rows with a non-null ``lang``; null texts count for the prior only.

    The driver receives at most buckets + 1 rows per language, never documents. A table with
    more than LANGUAGES values of ``lang`` is an error, since the model would grow with them.
    """
    labelled = labelled.filter(F.col("lang").isNotNull())
    found = labelled.select("lang").distinct().limit(LANGUAGES + 1).count()
    if found > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages: clean the labels first")
    table = count_grams(labelled).toPandas()
    docs = table[table["bucket"] == -1].set_index("lang")["n"]
    languages = sorted(docs.index)
    counts = np.full((1 << BUCKETS_LOG2, len(languages)), SMOOTHING)
    place = {lang: i for i, lang in enumerate(languages)}
    grams = table[table["bucket"] >= 0]
    counts[grams["bucket"], grams["lang"].map(place).astype(int)] += grams["n"]
    log_prob = np.log(counts / counts.sum(axis=0)) if languages else counts
    prior = np.log(docs[languages].to_numpy() / docs.sum()) if languages else np.zeros(0)
    return Model(languages, prior.astype(np.float64), log_prob)


def predict_languages(docs: DataFrame, model: Model, *carry: Column) -> DataFrame:
    """The ``carry`` columns (default doc_id), ``lang_pred`` and ``score`` of every row.

    Only ``text`` is read for the prediction. A null text, one without a letter, or an
    empty model gives ``und`` with score 0; ties go to the language that sorts first.
    The score is the posterior probability. Repeated rows are scored one by one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*(carry or (F.col("doc_id"),)), F.col("text").alias("text_to_judge"))
    kept = [f for f in rows.schema.fields if f.name != "text_to_judge"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = shared.value.predict(batch["text_to_judge"].tolist())
            out = batch[[f.name for f in kept]].copy()
            out["lang_pred"] = [lang for lang, _ in found]
            out["score"] = np.array([score for _, score in found], dtype=float)
            yield out

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return rows.mapInPandas(run, f"{schema}, lang_pred string, score double")
