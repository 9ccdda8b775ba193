"""Audit of how document filters interact, in every order in which they can be applied.

Texts are read once as bytes by a table-driven transducer: its state tells whether a word is
open, its table what a byte emits in that state (a word begins, a capital, a code point, a
symbol). Word spans are inserted into a hash table with open addressing; a word that meets a
taken slot is compared byte by byte with the word that took it, so distinct words are exact.

What is left of a document is the set of filters that it fails. All orders and steps follow
from the counts of those sets, at most 2 ** filters for each part of the table.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import keep
from rollbook.llm.jaccard import mix64, row_chunks, text_bytes

FILTERS = "ABCDE"
LEAST_WORDS = 200
DISTINCT_PERCENT = 50
CAPITAL_PERCENT = 2
STEP = 1 << 20  # bytes of text per pass
SYMBOLS = b"#$%&*|"  # fixed

OPENS, CAPITAL, POINT, SYMBOL = 1, 2, 4, 8  # what a byte emits
_BASE = np.uint64(0x9E3779B97F4A7C15)


def transducer() -> tuple[np.ndarray, np.ndarray]:
    """(state after a byte, what a byte emits): the second by state and byte.

    State 1 is inside a word. White space closes it, whatever the state; any other byte opens
    or continues it.
    """
    after = np.ones(256, dtype=np.uint8)
    after[[9, 10, 11, 12, 13, 32]] = 0
    emits = np.zeros((2, 256), dtype=np.uint8)
    codes = np.arange(256)
    emits[:, (codes < 128) | (codes >= 192)] |= POINT  # not a continuation byte
    emits[:, 65:91] |= CAPITAL
    emits[:, list(SYMBOLS)] |= SYMBOL
    emits[0, after == 1] |= OPENS
    return after, emits


def read_bytes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(what every byte emits, word starts, word ends) of texts joined in ``data``.

    Every state follows from the byte before alone, so the pass needs no loop. A text starts
    outside a word; its end closes one that is open.
    """
    after, emits = transducer()
    ends_open = after[data]
    state = np.zeros(len(data), dtype=np.uint8)
    state[1:] = ends_open[:-1]
    state[bounds[:-1][bounds[:-1] < len(data)]] = 0
    out = emits.reshape(-1)[(state.astype(np.uint16) << 8) | data]
    starts = np.flatnonzero(out & OPENS)
    closes = np.ones(len(data), dtype=bool)  # the next byte does not continue a word
    closes[:-1] = (state[1:] & ends_open[1:]) == 0
    ends = np.flatnonzero(closes & (ends_open == 1)) + 1
    return out, starts, ends


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of all bytes of some spans, one span after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def _equal_spans(data: np.ndarray, a: np.ndarray, b: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Which pairs of spans of the same size hold the same bytes."""
    if not len(a):
        return np.zeros(0, dtype=bool)
    differ = data[_spans(a, sizes)] != data[_spans(b, sizes)]
    return np.add.reduceat(differ, np.cumsum(sizes) - sizes, dtype=np.int64) == 0


def first_words(data: np.ndarray, row: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which words are the ones that took a slot of the hash table: one of each row's equal words.

    Words of all rows share a table; its keys are row and word. All words try their slot at
    once; those that find another key there go on to the next slot.
    """
    n = len(starts)
    taken = np.zeros(n, dtype=bool)
    if not n:
        return taken
    size = ends - starts
    inside = np.arange(len(data)) - np.repeat(np.append(0, starts), np.diff(np.concatenate([[0], starts, [len(data)]])))
    power = np.full(int(size.max()) + 1, _BASE, dtype=np.uint64)
    power[0] = 1
    power = np.cumprod(power)
    terms = (data.astype(np.uint64) + np.uint64(1)) * power[np.minimum(inside, len(power) - 1)]
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(terms, out=sums[1:])
    key = mix64(sums[ends] - sums[starts] + mix64(row.astype(np.uint64) * _BASE + size.astype(np.uint64)))
    mask = (1 << int(2 * n - 1).bit_length()) - 1
    owner = np.full(mask + 1, -1, dtype=np.int64)
    left = np.arange(n)
    slot = (key & np.uint64(mask)).astype(np.int64)
    while len(left):
        empty = owner[slot] < 0
        owner[slot[empty]] = left[empty]
        met = owner[slot]
        own = met == left
        taken[left[own]] = True
        same = own | ((key[met] == key[left]) & (row[met] == row[left]) & (size[met] == size[left]))
        check = np.flatnonzero(same & ~own)
        w, m = left[check], met[check]
        same[check] = _equal_spans(data, starts[w], starts[m], size[w])
        left, slot = left[~same], (slot[~same] + 1) & mask
    return taken


def measures(column: pa.Array) -> dict[str, np.ndarray]:
    """n_words, n_distinct, n_capitals, n_points, n_symbols of every text."""
    data, offsets = text_bytes(column)
    found: dict[str, list[np.ndarray]] = {}
    for start, stop in row_chunks(offsets, STEP):
        bounds = offsets[start : stop + 1] - offsets[start]
        part = data[offsets[start] : offsets[stop]]
        out, starts, ends = read_bytes(part, bounds)
        row = np.searchsorted(bounds, starts, side="right") - 1
        first = first_words(part, row, starts, ends)
        rows = stop - start
        counts = {"n_words": np.bincount(row, minlength=rows), "n_distinct": np.bincount(row[first], minlength=rows)}
        for name, bit in (("n_capitals", CAPITAL), ("n_points", POINT), ("n_symbols", SYMBOL)):
            places = np.flatnonzero(out & bit)
            counts[name] = np.diff(np.searchsorted(places, bounds))
        for name, values in counts.items():
            found.setdefault(name, []).append(values)
    return {name: np.concatenate(parts).astype(np.int64) for name, parts in found.items()}


def failures(docs: DataFrame, *carry: Column) -> DataFrame:
    """Carried columns, the five measures, and ``fails``: bit 0 for filter A to bit 3 for D."""
    rows = docs.select(*carry, F.col("text").alias("text_to_measure"))
    carried = rows.schema.fields[:-1]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in carried)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            m = measures(batch.column("text_to_measure"))
            failed = (
                m["n_words"] < LEAST_WORDS,
                100 * m["n_distinct"] < DISTINCT_PERCENT * m["n_words"],
                100 * m["n_capitals"] > CAPITAL_PERCENT * m["n_points"],
                m["n_symbols"] > 0,
            )
            fails = sum(f.astype(np.int32) << k for k, f in enumerate(failed))
            kept = batch.drop_columns("text_to_measure")
            columns = [*kept.columns, *[pa.array(v) for v in m.values()], pa.array(fails, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, [*kept.schema.names, *m, "fails"])

    more = "n_words long, n_distinct long, n_capitals long, n_points long, n_symbols long, fails int"
    return rows.mapInArrow(run, f"{schema}, {more}")


def failing_sets(docs: DataFrame) -> DataFrame:
    """(doc_id, part, fails) of every row: all filters, E too, as bits.

    Needs doc_id, source, text; other columns are ignored. A null text is empty, a null source
    is the part ''. E compares whole texts by their SHA-256 and looks for a smaller id: rows
    of one id do not fail by each other, rows without an id neither fail nor make others fail.
    """
    copy = F.sha2(F.coalesce("text", F.lit("")), 256)
    texts = keep(
        failures(
            docs,
            F.col("doc_id"),
            F.coalesce("source", F.lit("")).alias("part"),
            F.unhex(copy).alias("copy"),
        ).select("doc_id", "part", "copy", "fails"),
        "audit-texts",
    )
    first = texts.filter(F.col("doc_id").isNotNull()).groupBy("copy").agg(F.min("doc_id").alias("first"))
    repeated = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    fails = F.col("fails") + F.when(repeated, 1 << FILTERS.index("E")).otherwise(0)
    return texts.join(first, "copy", "left").select("doc_id", "part", fails.alias("fails"))


def set_counts(sets: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, fails, n, good, toxic): documents by what they fail. Of several labels of one
    document any that says good, or toxic, counts."""
    marks = labels.groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"),
        F.max((F.col("toxic") == 1).cast("long")).alias("toxic"),
    )
    return (
        sets.join(marks, "doc_id", "left")
        .groupBy("part", "fails")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.coalesce(F.sum("good"), F.lit(0)).cast("long").alias("good"),
            F.coalesce(F.sum("toxic"), F.lit(0)).cast("long").alias("toxic"),
        )
    )


def order_steps(filters: str) -> list[dict]:
    """Every step of every order: the bit of its filter, and the bits of those before it."""
    steps = []
    for order in permutations(filters):
        before = 0
        for k, letter in enumerate(order):
            bit = 1 << filters.index(letter)
            steps.append({"filter_order": "".join(order), "step": k + 1, "bit": bit, "before": before})
            before |= bit
    return steps


def interactions(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order and step, from ``set_counts``.

    kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley. A filter removes a
    document in the orders in which it stands before all others that the document fails: of
    all orders, one in as many as it fails. So shapley needs no orders to be walked through.
    """
    schema = "array<struct<filter_order:string,step:int,bit:int,before:int>>"
    steps = F.from_json(F.lit(json.dumps(order_steps(filters))), schema)
    per_part = counts.groupBy("part").agg(
        F.collect_list(F.struct("fails", "n", "good", "toxic")).alias("sets")
    )
    each = per_part.select("part", "sets", F.explode(steps).alias("s")).select("part", "sets", "s.*")
    bit, before = F.col("bit"), F.col("before")
    orders = math.factorial(len(filters))

    def total(value, condition) -> Column:
        return F.aggregate(
            "sets",
            F.lit(0).cast("long"),
            lambda sum_, m: sum_ + F.when(condition(m["fails"]), value(m)).otherwise(0),
        )

    def fails(m: Column) -> Column:
        return m.bitwiseAND(bit) != 0

    def still(m: Column) -> Column:
        return m.bitwiseAND(before) == 0

    def removed(m: Column) -> Column:
        return fails(m) & still(m)

    def orders_first(m: Column) -> Column:
        """In how many orders a certain one of the failed filters stands before the others."""
        return F.element_at(F.lit([orders // k for k in range(1, len(filters) + 1)]), F.bit_count(m))

    return each.select(
        "part",
        "filter_order",
        "step",
        total(lambda m: m["n"], lambda m: ~fails(m) & still(m)).alias("kept"),
        total(lambda m: m["n"], removed).alias("removed"),
        total(lambda m: m["n"], lambda m: fails(m) & ~still(m)).alias("redundant"),
        total(lambda m: m["n"], lambda m: m == bit).alias("unique_fails"),
        total(lambda m: m["good"], removed).alias("good_lost"),
        total(lambda m: m["toxic"], removed).alias("toxic_lost"),
        total(lambda m: m["n"] * orders_first(m["fails"]), fails).alias("shapley"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of a table: ``interactions`` of its failing sets. An empty table gives no rows."""
    return interactions(set_counts(failing_sets(docs), labels))
