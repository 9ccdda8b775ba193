"""Exact Jaccard self-join of word n-gram sets with token-combination prefixes.

Texts with equal sets are folded into one set first. Every set then emits signatures from a
prefix of its tokens: rare tokens come first and are signatures by themselves; if they do
not suffice, the prefix is extended over frequent tokens, which are split into classes and
indexed as combinations of two of one class. The prefix is so long that two similar sets
always share a signature: with ``slack`` tokens of a set missing in the other, it holds more
than ``slack`` rare tokens plus frequent ones beyond the first of each class. Sets with rare
tokens to spare sign with some more, since similar sets then share several signatures: one in
common is no candidate. A first pass only counts signatures; tokens that many sets sign with
are frequent in the second.

Sets that share signatures and have fitting sizes are candidates. Where few sets share one,
they are paired and screened by a sketch of counts, whose distance is never above the true
one and whose cells grow with the set; where many do, they hang on the smallest of them (a
star, never all pairs). Candidates
that are connected are verified together with their whole token sets; bundles beyond a size
are cut into blocks and verified block by block. What leaves a task is a forest of verified
links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollbook.llm.common import keep
from rollbook.llm.graph import components

NGRAM = 3
PERCENT = 90
FREQUENT = 16  # sets seen to share a token, from which it counts as frequent
SIGNED = 64  # rows that sign with a token, from which it counts as frequent
FREQUENT_MOST = 1 << 20  # frequent tokens at most; the most frequent ones: bounds the broadcast
STEP_BYTES = 1 << 19  # bytes of text per numpy pass
CHUNK = 1 << 19  # tokens of the sets of a chunk
BATCH_BYTES = 4 << 20  # of the Arrow batches that texts come in
SIGN_ROWS = 1_000  # texts whose signatures are in memory at once
SEEN = 1 << 18  # sets that a task remembers to have signed
PAIRED = 128  # up to so many sets of a signature are paired one by one
SHARED = 3  # signatures that a pair has in common, where rare tokens suffice
CELLS = 256  # of the count sketch that screens pairs, at least
CELL_TOKENS = 8  # of a larger set in a cell at most: with more, chance evens the counts out
SCREEN_BYTES = 2 << 20  # of sketches compared at once
SCREEN_SETS = 4_000
BLOCK_SETS = 1_500
BLOCK_TOKENS = 1_500_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACES = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3,
                    0x589965CC75374CC3], dtype=np.uint64)


def mix64(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows; null rows are empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8), offsets


def row_chunks(offsets: np.ndarray, size: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes; a longer row is a range of its own."""
    start, rows = 0, len(offsets) - 1
    while start < rows:
        stop = int(np.searchsorted(offsets, offsets[start] + size, side="right")) - 1
        stop = min(rows, max(stop, start + 1))
        yield start, stop
        start = stop


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, A-Z in lower case, and how many words each text has.

    ``bounds`` are the offsets of the texts in ``data``, from 0 to its length.
    """
    rows = len(bounds) - 1
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = bounds[:-1][bounds[:-1] < bounds[1:]]
    first[heads] = inside[heads]
    start_at = np.flatnonzero(first)
    if not len(start_at):
        return np.zeros(0, np.uint64), np.zeros(rows, np.int64)
    per_row = np.diff(np.searchsorted(start_at, bounds))
    letters = data[inside]
    letters = np.where((letters >= 65) & (letters <= 90), letters + 32, letters)
    at = np.flatnonzero(first[inside])
    sizes = np.diff(np.append(at, len(letters)))
    within = np.arange(len(letters)) - np.repeat(at, sizes)
    powers = np.full(int(sizes.max()), _BASE, dtype=np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers)
    terms = (letters.astype(np.uint64) + np.uint64(1)) * powers[within]
    return mix64(np.add.reduceat(terms, at) + sizes.astype(np.uint64)), per_row


def shingle_sets(column: pa.Array, ngram: int) -> Iterator[np.ndarray]:
    """For every row the sorted distinct hashes of its word n-grams."""
    data, offsets = text_bytes(column)
    for start, stop in row_chunks(offsets):
        bounds = offsets[start : stop + 1] - offsets[start]
        words, per_row = word_hashes(data[offsets[start] : offsets[stop]], bounds)
        n = len(words)
        grams = np.full(max(0, n - ngram + 1), np.uint64(ngram), dtype=np.uint64)
        for j in range(ngram):
            grams += words[j : j + len(grams)] * _PLACES[j]
        grams = mix64(grams)
        ends = np.cumsum(per_row)
        for end, count in zip(ends, per_row, strict=True):
            if count >= ngram:
                yield np.unique(grams[end - count : end - ngram + 1])
            elif count:
                some = words[end - count : end] * _PLACES[:count]
                yield mix64(np.array([some.sum() + np.uint64(count)], dtype=np.uint64))
            else:
                yield np.zeros(0, np.uint64)


def needed(size: int, percent: int) -> int:
    """Tokens that a set of this size shares at least with any set similar to it."""
    return -(-percent * size // 100)


def signatures(tokens: np.ndarray, frequent: np.ndarray, percent: int) -> np.ndarray:
    """Signature hashes of a set; two sets that meet ``percent`` share at least one.

    ``tokens`` and ``frequent`` are sorted. Sets so small that only equal sets are similar
    have none.
    """
    return shared_signatures(tokens, frequent, percent)[0]


def shared_signatures(
    tokens: np.ndarray, frequent: np.ndarray, percent: int
) -> tuple[np.ndarray, int]:
    """Signatures of a set, and how many of them a similar set has too.

    The number is 0 for a set that signs with frequent tokens: it shares one with another of
    its kind. Two sets share the smaller number that is not 0: all tokens in common come in
    the same order, and at most ``slack`` others of either set stand before the last of them.
    """
    size = len(tokens)
    slack = size - needed(size, percent)
    # linked only with equal sets: even one token more in the union is too many
    if 100 * size < percent * (size + 1):
        return np.zeros(0, np.uint64), 0
    if len(frequent):
        known = frequent[np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)] == tokens
    else:
        known = np.zeros(size, dtype=bool)
    rare = tokens[~known]
    shared = min(SHARED, needed(size, percent))
    if len(rare) >= slack + shared:
        return rare[: slack + shared], shared
    common = tokens[known]
    found = [rare]
    largest = 100 * size // percent
    for level in range((needed(size, percent)).bit_length(), largest.bit_length() + 1):
        # as many classes for all sets of a level of sizes
        top = (1 << level) - 1
        classes = max(1, (top - needed(top, percent)) // 8)
        kind = (common >> np.uint64(7)) % np.uint64(classes)
        # tokens in order; the first of a class only opens it
        order = np.argsort(kind, kind="stable")
        opens = np.zeros(len(common), dtype=bool)
        ranked = kind[order]
        opens[order[np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))]] = True
        counts = np.cumsum(~opens)
        wanted = slack + 1 - len(rare)
        stop = int(np.searchsorted(counts, wanted)) + 1
        part, kind = common[:stop], kind[:stop]
        for k in np.unique(kind):
            of = mix64(part[kind == k] + np.uint64(level))
            i, j = np.triu_indices(len(of), 1)
            found.append(mix64(of[i] * _PLACES[0] + of[j] * _PLACES[1]))
    return np.unique(np.concatenate(found)), 0


def sketch(tokens: np.ndarray) -> np.ndarray:
    """How many tokens of a set fall in each cell, up to 255; cells are a power of two."""
    cells = max(CELLS, (1 << (len(tokens) - 1).bit_length()) // CELL_TOKENS)
    held = np.bincount((tokens >> np.uint64(11)).astype(np.int64) % cells, minlength=cells)
    return np.minimum(held, 255).astype(np.uint8)


def sketches_apart(one: list[bytes], two: list[bytes]) -> np.ndarray:
    """Distances of sketches, row by row; the finer of two is folded to the cells of the other."""
    sizes = np.array([[len(x) for x in one], [len(x) for x in two]])
    apart = np.zeros(len(one), dtype=np.int64)
    for la, lb in np.unique(sizes, axis=1).T.tolist():
        rows = np.flatnonzero((sizes[0] == la) & (sizes[1] == lb))
        least, step = min(la, lb), max(1, SCREEN_BYTES // (la + lb))
        for at in (rows[i : i + step] for i in range(0, len(rows), step)):
            a, b = (
                np.minimum(
                    np.frombuffer(b"".join(side[k] for k in at.tolist()), np.uint8)
                    .reshape(len(at), -1, least)
                    .sum(axis=1, dtype=np.int32),
                    255,
                )
                for side in (one, two)
            )
            apart[at] = np.abs(a - b).sum(axis=1, dtype=np.int64)
    return apart


def link_forest(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links between sets that join all that are connected by similarity.

    One set after the other is compared with all others through an inverted index, until
    all sets not yet compared are connected: the pairs left out cannot change the result.
    """
    count = len(sets)
    sizes = np.array([len(s) for s in sets])
    # tokens numbered in order, in 32 bits: a block is small, its arrays should be too
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    flat = flat[order]
    number = np.cumsum(np.append(False, flat[1:] != flat[:-1]), dtype=np.int32)
    del flat
    token = np.empty(len(order), dtype=np.int32)
    token[order] = number
    posting = np.repeat(np.arange(count, dtype=np.int32), sizes)[order]
    del order
    begin = np.searchsorted(number, np.arange(number[-1] + 2, dtype=np.int32))
    del number
    starts = np.cumsum(sizes) - sizes
    group = np.arange(count)
    open_ = np.ones(count, dtype=bool)
    links = []
    while True:
        left = np.flatnonzero(open_)
        if not len(left):
            break
        kinds, members = np.unique(group[left], return_counts=True)
        if len(kinds) == 1:
            break
        lead = left[group[left] == kinds[np.argmin(members)]][0]
        open_[lead] = False
        mine = token[starts[lead] : starts[lead] + sizes[lead]]
        span = begin[mine + 1] - begin[mine]
        at = np.repeat(begin[mine] - (np.cumsum(span) - span), span) + np.arange(span.sum())
        shared = np.bincount(posting[at], minlength=count)
        linked = (shared > 0) & (100 * shared >= percent * (sizes[lead] + sizes - shared))
        linked &= group != group[lead]
        while linked.any():
            other = int(np.flatnonzero(linked)[0])
            links.append((int(lead), other))
            group[group == group[other]] = group[lead]
            linked &= group != group[lead]
    return links


def _profile(docs: DataFrame, ngram: int) -> DataFrame:
    """Rows of two kinds: one per document (key, size and two hashes of its set), and one
    per token that several sets of one chunk share (token in h1, sets in n)."""
    schema = "doc_id long, n long, h1 long, h2 long, sketch binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, n, h1, h2, sketches = [], [], [], [], []
            tokens: list[np.ndarray] = []
            held = 0
            keys = batch.column("doc_id").to_pylist()
            for key, s in zip(keys, shingle_sets(batch.column("text"), ngram), strict=True):
                ids.append(key)
                n.append(len(s))
                h1.append(int(mix64(s + _PLACES[3]).sum(dtype=np.uint64).astype(np.int64)))
                h2.append(int(mix64(s ^ _PLACES[4]).sum(dtype=np.uint64).astype(np.int64)))
                sketches.append(sketch(s).tobytes())
                tokens.append(s)
                held += len(s)
                if held > CHUNK:
                    yield _frequent(tokens)
                    tokens, held = [], 0
            if tokens:
                yield _frequent(tokens)
            yield pa.RecordBatch.from_pydict(
                {"doc_id": pa.array(ids, pa.int64()), "n": pa.array(n, pa.int64()),
                 "h1": pa.array(h1, pa.int64()), "h2": pa.array(h2, pa.int64()),
                 "sketch": pa.array(sketches, pa.binary())}
            )

    def _frequent(tokens: list[np.ndarray]) -> pa.RecordBatch:
        token, times = np.unique(np.concatenate(tokens), return_counts=True)
        often = times > 1
        nothing = pa.nulls(int(often.sum()), pa.int64())
        return pa.RecordBatch.from_pydict(
            {"doc_id": nothing, "n": pa.array(times[often]),
             "h1": pa.array(token[often].astype(np.int64)), "h2": nothing,
             "sketch": pa.nulls(len(nothing), pa.binary())}
        )

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _paired(posted: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs under signatures of few sets whose sizes and sketches allow a link.

    A signature of many sets counts as one that no pair has here: it is a star's.
    """
    few = posted.filter(F.col("rows") <= PAIRED)
    one = few.select("sig", F.col("h1").alias("a"), F.col("n").alias("na"), F.col("least").alias("la"))
    two = few.select("sig", F.col("h1").alias("b"), F.col("n").alias("nb"), F.col("least").alias("lb"))
    fits = (F.col("a") < F.col("b")) & (
        F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent
    )
    # 0 for sets that sign with frequent tokens
    wanted = F.when(F.least("la", "lb") > 0, F.least("la", "lb")).otherwise(F.greatest("la", "lb"))
    pairs = (
        one.join(two, "sig")
        .filter(fits)
        .groupBy("a", "b")
        .agg(F.count(F.lit(1)).alias("shared"), F.max(wanted).alias("wanted"))
        .filter(F.col("shared") >= F.col("wanted"))
        .select("a", "b")
    )
    looks = sets.groupBy("h1").agg(F.min("n").alias("n"), F.min("sketch").alias("sketch"))
    both = pairs.join(
        looks.select(F.col("h1").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa")), "a"
    ).join(
        looks.select(F.col("h1").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb")), "b"
    )

    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            apart = sketches_apart(*(batch.column(c).to_pylist() for c in ("sa", "sb")))
            total = batch.column("na").to_numpy() + batch.column("nb").to_numpy()
            close = pa.array(apart * (100 + percent) <= total * (100 - percent))
            yield batch.select(["a", "b"]).filter(close)

    return both.mapInArrow(screen, "a long, b long")


def _starred(posted: DataFrame, percent: int) -> DataFrame:
    """(a, b): sets under signatures of many rows, each hung on the smallest of like size.

    Sizes are cut into steps of the ratio that links allow; a set is listed under its step
    and the next, so sets of fitting sizes share one.
    """
    step = F.floor(F.log(F.col("n").cast("double")) / float(np.log(100 / percent) + 1e-9))
    many = posted.filter(F.col("rows") > PAIRED).select(
        "sig", "h1", F.explode(F.array(step, step + 1)).alias("step")
    )
    low = many.groupBy("sig", "step").agg(F.min("h1").alias("b"))
    return many.join(low, ["sig", "step"]).select(F.col("h1").alias("a"), "b")


def _blocks(sets: int, more: Column) -> Column:
    return F.greatest(F.ceil(F.count(F.lit(1)) / sets), F.ceil(more)).cast("int").alias("blocks")


def _placed(members: DataFrame, sized: DataFrame, key: str) -> DataFrame:
    """Members of bundles, each with all cells that its block stands in: any two meet in one."""
    mine = F.pmod(F.xxhash64(key), F.col("blocks")).cast("int")
    other = F.col("other")
    return (
        members.join(sized, "bundle")
        .withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("cell", F.xxhash64("bundle", F.least("mine", other), F.greatest("mine", other)))
    )


def _close_forest(n: np.ndarray, sketches: list[bytes], percent: int) -> list[tuple[int, int]]:
    """Links that join all sets which sizes and sketches connect; ``n`` ascends."""
    group, links = np.arange(len(n)), []
    cells = np.array([len(x) for x in sketches])
    for level in np.unique(cells).tolist():
        leads = np.flatnonzero(cells == level)
        stop = int(np.searchsorted(n, n[leads[-1]] * 100 // percent, side="right"))
        # larger sets have as many cells or more: folded to those of the leads
        near = np.array(
            [
                np.frombuffer(x, np.uint8).reshape(-1, level).sum(axis=0, dtype=np.int32)
                for x in sketches[leads[0] : stop]
            ]
        )
        near = np.minimum(near, 255).astype(np.int16)
        for i in leads.tolist():
            last = int(np.searchsorted(n, n[i] * 100 // percent, side="right"))
            rows = np.arange(i + 1, last)
            rows = rows[group[rows] != group[i]]
            apart = np.abs(near[rows - leads[0]] - near[i - leads[0]]).sum(axis=1, dtype=np.int64)
            rows = rows[apart * (100 + percent) <= (n[i] + n[rows]) * (100 - percent)]
            _, first = np.unique(group[rows], return_index=True)
            for j in rows[first].tolist():
                links.append((i, j))
                group[group == group[j]] = group[i]
    return links


def _parted(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(class_id, bundle, n): bundles cut to what sizes and sketches connect, all pairs compared.

    A star ties sets that share no more than a signature. Sets that nothing is close to go.
    """
    looks = sets.groupBy("h1").agg(F.min("sketch").alias("sketch"))
    seen = keep(members.select("h1", "bundle", "n").distinct().join(looks, "h1"), "wide-bundles")
    sized = seen.groupBy("bundle").agg(
        _blocks(SCREEN_SETS, F.sum(F.length("sketch")) / SCREEN_BYTES)
    )

    def close(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates("h1").sort_values("n")
        links = _close_forest(group["n"].to_numpy(), group["sketch"].tolist(), percent)
        keys = group["h1"].tolist()
        return pd.DataFrame(
            [(keys[i], keys[j]) for i, j in links], columns=["a", "b"], dtype="int64"
        )

    cells = _placed(seen, sized, "h1").select("cell", "h1", "n", "sketch")
    near = keep(cells.groupBy("cell").applyInPandas(close, "a long, b long"), "close-sets", BATCH_BYTES)
    roots = components(near)
    return members.join(roots, members["h1"] == roots["node"]).select(
        "class_id", F.col("root").alias("bundle"), "n"
    )


def _step(n: str) -> Column:
    return F.floor(F.log2(F.col(n).cast("double")) * 16).cast("int").alias("step")


def _most_frequent(often: DataFrame) -> np.ndarray:
    """Sorted tokens from the highest steps of frequency that hold FREQUENT_MOST at most.

    The driver receives a row per step, then those tokens, packed: as rows, a million of them
    take hundreds of MB there.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = batch.column("h1").to_numpy().tobytes()
            yield pa.RecordBatch.from_pydict({"tokens": pa.array([tokens], pa.binary())})

    steps = often.groupBy("step").agg(F.count(F.lit(1)).alias("tokens")).toPandas()
    steps = steps.sort_values("step", ascending=False)
    fits = steps[steps["tokens"].cumsum() <= FREQUENT_MOST]
    if fits.empty:
        return np.zeros(0, np.uint64)
    tokens = often.filter(F.col("step") >= int(fits["step"].min())).select("h1")
    packed = tokens.mapInArrow(pack, "tokens binary").collect()
    return np.sort(np.frombuffer(b"".join(r.tokens for r in packed), np.uint64))


def similar_sets(
    docs: DataFrame, ngram: int = NGRAM, percent: int = PERCENT
) -> tuple[DataFrame, DataFrame]:
    """(members, links) of the documents' word n-gram sets.

    ``members``: doc_id, n_shingles, class_id, one row per document; documents with equal
    sets share the class, named by its smallest doc_id. ``links``: a, b, classes whose
    similarity reaches ``percent``; a forest that connects whatever is connected.

    Needs doc_id (a key, long) and text; other columns are ignored. Texts without words are
    linked with nothing. Rows with a null doc_id have no class and take no part. Repeated
    rows are members of one class. Empty tables give no rows.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text").filter(F.col("doc_id").isNotNull())
    profile = keep(_profile(docs, ngram), "shingle-sets", BATCH_BYTES)
    of_docs = profile.filter(F.col("doc_id").isNotNull())
    often = (
        profile.filter(F.col("doc_id").isNull())
        .groupBy("h1")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= FREQUENT)
        .withColumn("step", _step("n"))
    )
    often = keep(often, "frequent-tokens")

    same = of_docs.filter(F.col("n") > 0).groupBy("h1", "h2", "n")
    classes = keep(same.agg(F.min("doc_id").alias("class_id")), "set-classes")

    def signed(tokens: DataFrame) -> DataFrame:
        """(sig, h1, n, least) of all sets, with these frequent tokens."""
        frequent = spark.sparkContext.broadcast(_most_frequent(tokens))

        def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: set[int] = set()  # copies of a set within a task need no second signature
            for batch in (b.slice(i, SIGN_ROWS) for b in batches for i in range(0, b.num_rows, SIGN_ROWS)):
                sigs, owners, sizes, shares = [], [], [], []
                if len(seen) > SEEN:
                    seen.clear()
                for s in shingle_sets(batch.column("text"), ngram):
                    owner = mix64(s + _PLACES[3]).sum(dtype=np.uint64)
                    if int(owner) in seen:
                        continue
                    seen.add(int(owner))
                    found, least = shared_signatures(s, frequent.value, percent)
                    if len(found):
                        sigs.append(found)
                        owners.append(np.full(len(found), owner, dtype=np.uint64))
                        sizes.append(np.full(len(found), len(s), dtype=np.int64))
                        shares.append(np.full(len(found), least, dtype=np.int32))
                if sigs:
                    yield pa.RecordBatch.from_pydict(
                        {"sig": pa.array(np.concatenate(sigs).view(np.int64)),
                         "h1": pa.array(np.concatenate(owners).view(np.int64)),
                         "n": pa.array(np.concatenate(sizes)),
                         "least": pa.array(np.concatenate(shares))}
                    )

        return docs.mapInArrow(sign, "sig long, h1 long, n long, least int")

    counted = signed(often).groupBy("sig").agg(
        F.min("h1").alias("low"), F.max("h1").alias("high"), F.count(F.lit(1)).alias("n")
    )
    crowded = keep(
        counted.filter((F.col("low") != F.col("high")) & (F.col("n") >= SIGNED)).select(
            F.col("sig").alias("h1"), "n", _step("n")
        ),
        "crowded-signatures",
        BATCH_BYTES,
    )
    common = often.union(crowded).groupBy("h1").agg(F.max("n").alias("n"), F.max("step").alias("step"))
    # copies that other tasks have signed go; the counts are those of different sets
    once = signed(keep(common, "common-tokens")).repartition("sig").distinct()
    sets = F.count(F.lit(1)).over(Window.partitionBy("sig"))
    posted = keep(once.withColumn("rows", sets).filter("rows > 1"), "postings", BATCH_BYTES)
    near = keep(
        _paired(posted, of_docs, percent).union(_starred(posted, percent)), "near-sets", BATCH_BYTES
    )
    grouped = keep(
        components(near).withColumnsRenamed({"node": "h1", "root": "bundle"}), "set-bundles"
    )
    candidates = keep(
        classes.join(grouped, "h1").select("h1", "class_id", "bundle", "n"), "candidates"
    )

    # bundles beyond a block's size are parted by sketches and verified as a grid of blocks
    blocks = _blocks(BLOCK_SETS, F.sum("n") / BLOCK_TOKENS)
    sized = keep(candidates.groupBy("bundle").agg(blocks), "bundle-sizes")
    wide = sized.filter("blocks > 1").select("bundle")
    if not wide.isEmpty():
        parted = _parted(candidates.join(wide, "bundle"), of_docs, percent)
        candidates = keep(
            candidates.join(wide, "bundle", "left_anti").select("class_id", "bundle", "n").union(parted),
            "parted-candidates",
        )
        sized = candidates.groupBy("bundle").agg(blocks)
    placed = _placed(candidates, sized, "class_id").select("class_id", "cell")

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s.tobytes() for s in shingle_sets(batch.column("text"), ngram)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("class_id"), batch.column("cells"), pa.array(sets, pa.binary())],
                ["class_id", "cells", "tokens"],
            )

    def verify(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates("class_id")
        ids = group["class_id"].tolist()
        sets = [np.frombuffer(t, dtype=np.uint64) for t in group["tokens"]]
        links = link_forest(sets, percent) if len(ids) > 1 else []
        return pd.DataFrame(
            [(ids[i], ids[j]) for i, j in links], columns=["a", "b"], dtype="int64"
        )

    cells = placed.groupBy("class_id").agg(F.collect_list("cell").alias("cells"))
    texts = docs.join(cells, docs["doc_id"] == cells["class_id"]).select("class_id", "cells", "text")
    loaded = texts.mapInArrow(load, "class_id long, cells array<long>, tokens binary")
    links = keep(
        loaded.select("class_id", F.explode("cells").alias("cell"), "tokens")
        .groupBy("cell")
        .applyInPandas(verify, "a long, b long"),
        "set-links",
        BATCH_BYTES,
    )
    members = of_docs.join(classes, ["h1", "h2", "n"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("class_id", "doc_id").alias("class_id"),
    )
    return members, links


def jaccard_components(docs: DataFrame, ngram: int = NGRAM, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id): the smallest doc_id that links lead to."""
    members, links = similar_sets(docs, ngram, percent)
    roots = components(links)
    return members.join(roots, members["class_id"] == roots["node"], "left").select(
        "doc_id", "n_shingles", F.coalesce("root", "class_id").alias("component_id")
    )
