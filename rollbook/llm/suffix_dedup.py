"""Removal of repeated byte strings by a hash-compared suffix sort.

A byte goes if a string of ``WINDOW`` bytes around it also starts in a document with a
smaller id. Every such string holds an anchor: of its ``GRAM``-byte grams the one with the
smallest hash, so equal strings have equal anchors at equal places. Around an anchor lies
its context, all strings that hold it.

1. Anchors are dealt by hash, with a hash of their context. If the whole context also
   stands in a smaller document, it goes at once. Where one anchor has several contexts
   (near the edges of repeats), the first document of each context asks for a close look.
2. The close look sorts suffixes of these contexts: a merge sort whose comparisons find the
   common extension of two suffixes by binary search on prefix polynomial hashes. First the
   contexts of an anchor are sorted by what follows and by what precedes it: neighbours tell
   how far any other context agrees on either side. Strings that lie within both reaches are
   then sorted themselves; neighbours with a common extension of a whole string are checked
   byte by byte, and take the smallest id of their run.

Hot strings are safe: a task passes on only the smallest document of each context, and an
anchor that has many contexts within a task is asked for at once, so that few rows of it
meet. An anchor with many contexts overall is cut by the bytes next to it: a string holds
half a side before the anchor, or half a side behind it. Cuts that still have very many
contexts are not sorted in one task: their strings are grouped by themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import keep
from rollbook.llm.jaccard import mix64, row_chunks, text_bytes

WINDOW = 50
GRAM = 20
SIDE = WINDOW - GRAM  # bytes of a context on either side of its anchor
STEP = 1 << 20  # bytes per numpy pass
OVERLAP = 4 * WINDOW  # of the parts of a text that is longer than that
BUCKET_ANCHORS = 300_000
MANY_CONTEXTS = 64  # of one anchor within a task, from which they are asked for at once
CUT_CONTEXTS = 2_000  # of one anchor overall, from which it is cut by the bytes next to it
HOT_CONTEXTS = 50_000  # of one cut, from which its strings are grouped by themselves
MARK = 0xFFFFFFFF  # place of a row that only tells that an anchor has other contexts
DEAL_ROWS = 2_500  # documents whose anchors are in memory at once
CELL_CONTEXTS = 8_000
CHECKED = 1 << 16  # strings compared byte by byte at once
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
NONE = np.uint64(2**64 - 1)


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out)


class PrefixHashes:
    """Hash of any stretch of a byte array, from one running polynomial sum (mod 2^64)."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, n + 1)[:n], out=self.sums[1:])
        self.inverse = powers(INVERSE, n + 1)

    def __call__(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return (self.sums[stop] - self.sums[start]) * self.inverse[start]


def _spread(values: np.ndarray, width: int, pick: np.ufunc, ahead: bool) -> np.ndarray:
    """Minimum or maximum of each position and the ``width`` - 1 after (or before) it."""
    out, done = values.copy(), 1
    while done < width:
        step = min(done, width - done)
        if ahead:
            out[:-step] = pick(out[:-step], out[step:])
        else:
            out[step:] = pick(out[step:], out[:-step].copy())
        done += step
    return out


def anchors(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, anchor hash, context hash) of all anchors in the texts joined in ``data``."""
    n = len(data)
    if n < WINDOW:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    hashes = PrefixHashes(data)
    sizes = np.diff(bounds)
    stop = np.repeat(bounds[1:], sizes)
    left = stop - np.arange(n)  # bytes to the end of the text
    grams = np.full(n, NONE, dtype=np.uint64)
    last = n - GRAM + 1
    grams[:last] = mix64((hashes.sums[GRAM:] - hashes.sums[:last]) * hashes.inverse[:last])
    grams = np.minimum(grams, NONE - np.uint64(1))
    grams[left < GRAM] = NONE
    width = WINDOW - GRAM + 1
    least = _spread(grams, width, np.minimum, True)
    least[left < WINDOW] = 0
    # an anchor is the least gram of some string that holds it
    at = np.flatnonzero((_spread(least, width, np.maximum, False) == grams) & (left >= GRAM))
    begin = np.repeat(bounds[:-1], sizes)[at]
    low, high = np.maximum(at - SIDE, begin), np.minimum(at + WINDOW, stop[at])
    form = ((at - low) * 128 + (high - at)).astype(np.uint64)
    return at, grams[at], mix64(hashes(low, high) + form * np.uint64(0xD6E8FEB86659FD93))


def text_anchors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(row, position in the row, anchor hash, context hash), texts of any length in parts."""
    data, offsets = text_bytes(column)
    for start, stop in row_chunks(offsets, STEP):
        begin, end = int(offsets[start]), int(offsets[stop])
        if end - begin <= 2 * STEP:
            bounds = offsets[start : stop + 1] - begin
            at, gram, context = anchors(data[begin:end], bounds)
            row = np.searchsorted(bounds, at, side="right") - 1
            yield start + row, at - bounds[row], gram, context
            continue
        for a in range(begin, end, STEP):  # one long text: strings at the seams lie in a part
            low, high = max(begin, a - OVERLAP), min(end, a + STEP + OVERLAP)
            at, gram, context = anchors(data[low:high], np.array([0, high - low]))
            own = (at + low >= a) & (at + low < min(end, a + STEP))
            at = at[own] + low - begin
            yield np.full(len(at), start), at, gram[own], context[own]


ANCHOR = np.dtype([("gram", "<u4"), ("context", "<u8"), ("doc", "<i8"), ("at", "<u4")])
GONE = np.dtype([("doc", "<i8"), ("at", "<u4")])
ASKED = np.dtype([("doc", "<i8"), ("at", "<u4"), ("look", "<i8")])
KINDS = {"anchor": ANCHOR, "gone": GONE, "asked": ASKED}


def _firsts(gram: np.ndarray, context: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by gram, context and doc; in that order, the run of each context and of each gram."""
    order = np.lexsort((doc, context, gram))
    g, c = gram[order], context[order]
    new_gram = np.append(True, g[1:] != g[:-1])
    new_context = new_gram | np.append(True, c[1:] != c[:-1])
    return order, np.cumsum(new_context) - 1, np.cumsum(new_gram) - 1


def _deal(docs: DataFrame, buckets: int) -> DataFrame:
    """(bucket, kind, data): packed anchors by bucket of their hash.

    Of the documents of a task that share a context only the smallest is passed on as an
    anchor; the others lose the context whatever is found elsewhere (``gone``). Where an
    anchor has many contexts they are ``asked`` for a close look, and one mark goes on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, DEAL_ROWS) for b in batches for i in range(0, b.num_rows, DEAL_ROWS)):
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            parts = list(text_anchors(batch.column("text")))
            if not sum(len(p[0]) for p in parts):
                continue
            row, at, gram, context = (np.concatenate(p) for p in zip(*parts, strict=True))
            doc = ids[row]
            order, run_of, gram_of = _firsts(gram, context, doc)
            doc, at, gram, context = doc[order], at[order], gram[order], context[order]
            heads = np.flatnonzero(np.append(True, run_of[1:] != run_of[:-1]))
            kept = doc == doc[heads][run_of]
            many = (np.bincount(gram_of[heads]) > MANY_CONTEXTS)[gram_of]
            half, bucket = gram & np.uint64(0xFFFFFFFF), (gram >> np.uint64(32)) % np.uint64(buckets)

            marks = np.flatnonzero(many & np.append(True, gram_of[1:] != gram_of[:-1]))
            pass_on = np.concatenate([np.flatnonzero(kept & ~many), marks])
            out = np.empty(len(pass_on), dtype=ANCHOR)
            out["gram"], out["context"] = half[pass_on], context[pass_on]
            out["doc"], out["at"] = doc[pass_on], at[pass_on]
            if len(marks):
                out["context"][-len(marks) :] = 0
                out["at"][-len(marks) :] = MARK
                least = np.minimum.reduceat(doc, np.flatnonzero(np.append(True, gram_of[1:] != gram_of[:-1])))
                out["doc"][-len(marks) :] = least[gram_of[marks]]
            yield _pack(out, bucket[pass_on].astype(np.int32), "anchor")
            gone = np.empty(int((~kept).sum()), dtype=GONE)
            gone["doc"], gone["at"] = doc[~kept], at[~kept]
            yield _pack(gone, (gone["doc"] % buckets).astype(np.int32), "gone")
            ask = kept & many
            asked = np.empty(int(ask.sum()), dtype=ASKED)
            asked["doc"], asked["at"] = doc[ask], at[ask]
            asked["look"] = half[ask].astype(np.int64) + (bucket[ask].astype(np.int64) << 32)
            yield _pack(asked, (asked["doc"] % buckets).astype(np.int32), "asked")

    def _pack(rows: np.ndarray, bucket: np.ndarray, kind: str) -> pa.RecordBatch:
        order = np.argsort(bucket, kind="stable")
        found, start = np.unique(bucket[order], return_index=True)
        # column by column, so that the shuffle's compression finds like bytes together
        blobs = [
            b"".join(part[f].tobytes() for f in rows.dtype.names)
            for part in np.split(rows[order], start[1:])
        ] if len(found) else []
        return pa.RecordBatch.from_arrays(
            [pa.array(found, pa.int32()), pa.array([kind] * len(found), pa.string()), pa.array(blobs, pa.binary())],
            ["bucket", "kind", "data"],
        )

    return docs.mapInArrow(run, "bucket int, kind string, data binary")


def _unpack(blobs: list[bytes], dtype: np.dtype) -> dict[str, np.ndarray]:
    columns: dict[str, list[np.ndarray]] = {f: [] for f in dtype.names}
    for blob in blobs:
        n, at = len(blob) // dtype.itemsize, 0
        for f in dtype.names:
            columns[f].append(np.frombuffer(blob, dtype[f], n, at))
            at += n * dtype[f].itemsize
    return {f: np.concatenate(c) if c else np.zeros(0, dtype[f]) for f, c in columns.items()}


def _settle(group: pa.Table) -> pa.Table:
    """One bucket: (doc_id, at, look): contexts that go, and with ``look`` the anchor's hash
    where the first document of a context needs the close look."""
    bucket = group.column("bucket")[0].as_py()
    blobs: dict[str, list[bytes]] = {kind: [] for kind in KINDS}
    for kind, data in zip(group.column("kind").to_pylist(), group.column("data").to_pylist(), strict=True):
        blobs[kind].append(data)
    x, gone, asked = (_unpack(blobs[kind], dtype) for kind, dtype in KINDS.items())
    docs, ats = [gone["doc"], asked["doc"]], [gone["at"], asked["at"]]
    looks = [np.full(len(gone["doc"]), -1), asked["look"]]
    if len(x["doc"]):
        order, run_of, gram_of = _firsts(x["gram"], x["context"], x["doc"])
        doc, at = x["doc"][order], x["at"][order]
        heads = np.flatnonzero(np.append(True, run_of[1:] != run_of[:-1]))
        first = doc[heads][run_of]
        goes = (doc > first) & (at != MARK)
        gram_heads = np.flatnonzero(np.append(True, gram_of[heads][1:] != gram_of[heads][:-1]))
        low = np.minimum.reduceat(doc[heads], gram_heads)
        high = np.maximum.reduceat(doc[heads], gram_heads)
        ask = ~goes & (low != high)[gram_of] & (at != MARK)
        # the bucket and the gram's other half name the anchor's hash
        name = x["gram"][order].astype(np.int64) + (bucket << 32)
        docs += [doc[goes], doc[ask]]
        ats += [at[goes], at[ask]]
        looks += [np.full(int(goes.sum()), -1), name[ask]]
    look = np.concatenate(looks).astype(np.int64)
    return pa.table(
        {
            "doc_id": pa.array(np.concatenate(docs)),
            "at": pa.array(np.concatenate(ats).astype(np.int64)),
            "look": pa.array(look, mask=look < 0),
        }
    )


def common_extension(hashes: PrefixHashes, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Length of the common extension of suffix pairs, up to ``most``: binary search on hashes."""
    found = np.where(hashes(a, a + most) == hashes(b, b + most), most, 0)
    rest = np.flatnonzero(found < most)
    a, b = a[rest], b[rest]
    low, high = np.zeros(len(rest), np.int64), np.full(len(rest), most - 1)
    while (low < high).any():
        middle = (low + high + 1) // 2
        same = hashes(a, a + middle) == hashes(b, b + middle)
        low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
    found[rest] = low
    return found


def suffix_order(data: np.ndarray, hashes: PrefixHashes, at: np.ndarray, group: np.ndarray, most: int) -> np.ndarray:
    """Order of the suffixes at ``at`` by ``group``, then by their first ``most`` bytes.

    Suffixes are first set in order of group and first sixteen bytes; those still tied are
    merge sorted, all runs of a width at once. A comparison costs the logarithm of ``most``.
    """
    keys = []
    for begin in (0, 8):
        key = np.zeros(len(at), dtype=np.uint64)
        for j in range(begin, begin + 8):
            key = (key << np.uint64(8)) | data[at + j].astype(np.uint64)
        keys.append(key)
    order = np.lexsort((keys[1], keys[0], group))
    new = np.zeros(len(order), dtype=bool)
    new[:1] = True
    for column in (*keys, group):
        new[1:] |= column[order[1:]] != column[order[:-1]]
    run = np.cumsum(new) - 1
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, len(order)))
    width = 1
    while True:
        big = size > width
        if not big.any():
            return order
        slots = np.flatnonzero(big[run])
        start_of, size_of = start[run[slots]], size[run[slots]]
        place = slots - start_of  # place in the tied run
        pair = place // (2 * width) * (2 * width)
        in_left = place - pair < width
        other = np.where(in_left, pair + width, pair)
        other_end = np.minimum(other + width, size_of)
        low, high = np.minimum(other, size_of), np.maximum(other_end, np.minimum(other, size_of))
        floor = low.copy()
        mine = at[order[slots]]
        while True:
            todo = np.flatnonzero(low < high)
            if not len(todo):
                break
            middle = (low[todo] + high[todo]) // 2
            theirs = at[order[start_of[todo] + middle]]
            a = mine[todo]
            shared = common_extension(hashes, theirs, a, most)
            tied = shared >= most
            last = np.minimum(shared, most - 1)
            less = np.where(tied, ~in_left[todo], data[theirs + last] < data[a + last])
            low[todo] = np.where(less, middle + 1, low[todo])
            high[todo] = np.where(less, high[todo], middle)
        rank = (place - np.where(in_left, pair, pair + width)) + (low - floor)
        moved = order.copy()
        moved[start_of + pair + rank] = order[slots]
        order = moved
        width *= 2


def _reach(data: np.ndarray, at: np.ndarray, group: np.ndarray) -> np.ndarray:
    """How far each suffix agrees, up to SIDE bytes, with any other of its group."""
    hashes = PrefixHashes(data)
    order = suffix_order(data, hashes, at, group, SIDE)
    at, group = at[order], group[order]
    shared = np.zeros(len(at) + 1, dtype=np.int64)
    shared[1:-1] = np.where(group[1:] == group[:-1], common_extension(hashes, at[1:], at[:-1], SIDE), 0)
    out = np.empty(len(at), dtype=np.int64)
    out[order] = np.maximum(shared[1:], shared[:-1])
    return out


def _close_look(group: pa.Table) -> pa.Table:
    """(doc_id, low, high): stretches that go, from the contexts of one cell."""
    nothing = pa.table({c: pa.array([], pa.int64()) for c in ("doc_id", "low", "high")})
    look, doc, low, side, least, most = (
        group.column(c).to_numpy() for c in ("look", "doc_id", "low", "side", "least", "most")
    )
    data, bounds = context_bytes(group.column("context"))
    begin, size = bounds[:-1], np.diff(bounds)
    _, gram = np.unique(look, return_inverse=True)
    margin = np.zeros(WINDOW, dtype=np.uint8)
    ahead = np.concatenate([data, margin])
    behind = np.concatenate([data[::-1], margin])
    right = np.minimum(_reach(ahead, begin + side + GRAM, gram), size - side - GRAM)
    left = np.minimum(_reach(behind, len(data) - begin - side, gram), side)

    # a string has as many bytes before its anchor as are shared on the left, at most
    before = np.minimum(left, most)
    count = np.maximum(0, before - np.maximum(SIDE - right, least) + 1)
    owner = np.repeat(np.arange(len(doc)), count)
    if not len(owner):
        return nothing
    within = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    shift = (side - before)[owner] + within
    at = begin[owner] + shift
    # equal strings have their anchor at the same place
    place = gram[owner] * (SIDE + 1) + before[owner] - within
    hashes = PrefixHashes(ahead)
    order = suffix_order(ahead, hashes, at, place, WINDOW)
    at, owner, shift, place = at[order], owner[order], shift[order], place[order]
    equal = (place[1:] == place[:-1]) & (common_extension(hashes, at[1:], at[:-1], WINDOW) >= WINDOW)
    # collision check: neighbours taken for equal are compared byte by byte
    strings = np.lib.stride_tricks.sliding_window_view(data, WINDOW)
    taken = np.flatnonzero(equal)
    for some in np.split(taken, range(CHECKED, len(taken), CHECKED)):
        equal[some] = (strings[at[some + 1]] == strings[at[some]]).all(axis=1)
    run = np.cumsum(np.append(True, ~equal)) - 1
    heads = np.flatnonzero(np.append(True, ~equal))
    first = np.minimum.reduceat(doc[owner], heads)
    goes = np.flatnonzero(doc[owner] > first[run])
    if not len(goes):
        return nothing
    goes = goes[np.lexsort((shift[goes], owner[goes]))]
    start = low[owner[goes]] + shift[goes]
    # strings that follow each other make one stretch
    new = np.append(True, (owner[goes][1:] != owner[goes][:-1]) | (start[1:] != start[:-1] + 1))
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(goes)) - 1
    return pa.table({"doc_id": pa.array(doc[owner[goes[head]]]), "low": pa.array(start[head]), "high": pa.array(start[tail] + WINDOW)})


def context_bytes(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    parts = column.to_pylist()
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    return np.frombuffer(b"".join(parts), np.uint8), np.concatenate([[0], np.cumsum(sizes)])


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes around the anchors that need the close look."""
    for batch in batches:
        rows = {"look": [], "doc_id": [], "low": [], "side": [], "context": []}
        data, offsets = text_bytes(batch.column("text"))
        asked = zip(batch.column("doc_id").to_pylist(), batch.column("asks").to_pylist(), strict=True)
        for i, (doc, asks) in enumerate(asked):
            text = data[offsets[i] : offsets[i + 1]].tobytes()
            for ask in asks:
                at = ask["at"]
                low = max(0, at - SIDE)
                for name, value in zip(rows, (ask["look"], doc, low, at - low, text[low : at + WINDOW]), strict=True):
                    rows[name].append(value)
        yield pa.RecordBatch.from_pydict(
            {k: pa.array(v, pa.binary() if k == "context" else pa.int64()) for k, v in rows.items()}
        )


def _cut(contexts: DataFrame) -> DataFrame:
    """Contexts of anchors with many of them, under new names: anchor and half a side before it,
    for strings that hold those bytes, and anchor and half a side behind it for the others."""
    half = SIDE // 2
    before = F.struct(
        F.lit(half).alias("least"), F.lit(SIDE).alias("most"), (F.col("side") - half).alias("from"), (F.col("side") >= half).alias("holds")
    )
    behind = F.struct(
        F.lit(0).alias("least"), F.lit(half - 1).alias("most"), F.col("side").alias("from"),
        (F.length("context") - F.col("side") >= GRAM + half).alias("holds"),
    )
    bytes_ = F.substring("context", (F.col("cut.from") + 1).cast("int"), F.lit(GRAM + half))
    return (
        contexts.drop("least", "most")
        .withColumn("cut", F.explode(F.array(before, behind)))
        .filter("cut.holds")
        .select(F.xxhash64("look", "cut.least", bytes_).alias("look"), "doc_id", "low", "side", "context", "cut.least", "cut.most")
    )


def _strings_of(contexts: DataFrame) -> DataFrame:
    """(doc_id, low, high) from contexts of hot cuts: every string is a row, the smallest
    document of equal ones is found with partial minima, so no cut meets in one task."""
    begin = F.greatest(F.lit(0), F.col("side") - F.col("most"))
    last = F.least(F.length("context") - WINDOW, F.col("side") - F.col("least"))
    strings = contexts.filter(last >= begin).select(
        "doc_id", "low", "context", F.explode(F.sequence(begin.cast("int"), last.cast("int"))).alias("shift")
    ).select(
        "doc_id",
        (F.col("low") + F.col("shift")).alias("low"),
        F.substring("context", F.col("shift") + 1, F.lit(WINDOW)).alias("string"),
    )
    first = strings.groupBy("string").agg(F.min("doc_id").alias("first"))
    return (
        strings.join(first, "string")
        .filter(F.col("doc_id") > F.col("first"))
        .select("doc_id", "low", (F.col("low") + WINDOW).alias("high"))
    )


def covered(size: int, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, int]:
    """Which bytes of a text lie in some stretch, and in how many runs they lie."""
    edge = np.zeros(size + 1, dtype=np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, stops, -1)
    gone = np.cumsum(edge[:-1]) > 0
    runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
    return gone, runs


def repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, low, high): byte stretches that an earlier document has too; they may overlap.

    Needs doc_id (long; rows that repeat an id must be copies) and text; other columns are
    ignored. Null and empty texts and texts shorter than a string have none. Documents
    without an id lose nothing and take nothing from others.
    """
    texts = docs.select("doc_id", "text").filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(8, int(total * 2 / (WINDOW - GRAM + 2) / BUCKET_ANCHORS) + 1)
    settled = keep(
        _deal(texts, buckets)
        .groupBy("bucket")
        .applyInArrow(_settle, "doc_id long, at long, look long"),
        "repeat-anchors",
    )
    asks = settled.filter(F.col("look").isNotNull())
    cells = max(8, asks.count() // CELL_CONTEXTS + 1)
    by_doc = asks.groupBy("doc_id").agg(F.collect_list(F.struct("look", "at")).alias("asks"))
    contexts = texts.join(by_doc, "doc_id").mapInArrow(
        _contexts, "look long, doc_id long, low long, side long, context binary"
    )
    contexts = contexts.withColumns({"least": F.lit(0), "most": F.lit(SIDE)})
    large = _many(asks, CUT_CONTEXTS)
    strings = None
    if not large.isEmpty():
        cut = keep(_cut(contexts.join(large, "look", "left_semi")), "repeat-cuts")
        hot = _many(cut, HOT_CONTEXTS)
        if not hot.isEmpty():
            strings = _strings_of(cut.join(hot, "look", "left_semi"))
            cut = cut.join(hot, "look", "left_anti")
        contexts = contexts.join(large, "look", "left_anti").unionByName(cut)
    looked = (
        contexts.groupBy(F.pmod(F.xxhash64("look"), F.lit(cells)))
        .applyInArrow(_close_look, "doc_id long, low long, high long")
    )
    if strings is not None:
        looked = looked.unionByName(strings)
    whole = settled.filter(F.col("look").isNull()).select(
        "doc_id",
        F.greatest(F.lit(0), F.col("at") - SIDE).cast("long").alias("low"),
        (F.col("at") + WINDOW).alias("high"),
    )
    return whole.unionByName(looked)


def _many(contexts: DataFrame, most: int) -> DataFrame:
    """The anchors or cuts with more than ``most`` contexts."""
    counts = contexts.groupBy("look").agg(F.count(F.lit(1)).alias("n"))
    return keep(counts.filter(F.col("n") > most).select("look"), "repeat-many")


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and ``kept``, the bytes that are left, of every row."""
    found = (
        repeats(docs)
        .groupBy("doc_id")
        .agg(F.collect_list("low").alias("lows"), F.collect_list("high").alias("highs"))
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            removed, spans, kept = [], [], []
            pairs = zip(batch.column("lows"), batch.column("highs"), strict=True)
            for i, (lows, highs) in enumerate(pairs):
                text = data[offsets[i] : offsets[i + 1]]
                if lows.is_valid and len(lows):
                    stops = np.minimum(highs.values.to_numpy(), len(text))
                    gone, runs = covered(len(text), lows.values.to_numpy(), stops)
                    removed.append(int(gone.sum()))
                    spans.append(runs)
                    text = text[~gone]
                else:
                    removed.append(0)
                    spans.append(0)
                kept.append(text.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(offsets), pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return (
        docs.select("doc_id", "text")
        .join(found, "doc_id", "left")
        .mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
    )


def dedup_digest(docs: DataFrame) -> DataFrame:
    return without_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
