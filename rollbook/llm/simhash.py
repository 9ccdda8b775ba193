"""SimHash near-duplicates by anchors of a covering code.

A text's fingerprint has a bit set where over half of its shingles' hashes have it set.
Fingerprints link when they differ in few bits. To find links, 64 bits are cut into two
pieces: of three differing bits one piece has one at most. On each piece the anchors are the
words of a Hamming code, whose covering radius is 1: every fingerprint has an anchor within 1,
its home, and whatever differs from it by one bit more lies within 2 of that home. So every
fingerprint is replicated to all anchors within 2 (16 at most), and fingerprints of an anchor
are compared.

Equal fingerprints are folded first. What leaves a comparison is a forest of links, never all
pairs. Anchors with very many fingerprints are not compared in one task: there two
fingerprints link if changing one bit of the one and two bits of the other gives the same
word; such words are joined, at a fixed number for each fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import keep
from rollbook.llm.graph import components

NGRAM = 3
SEED = 42
DISTANCE = 3  # bits in which linked fingerprints differ at most; the anchors hold for 3 or fewer
PIECES = 2
CHECKS = 5  # parity checks of the Hamming code; its words have 2 ** CHECKS - 1 bits
CELL_ROWS = 200_000  # replicas compared in one task
HOT = 50_000  # fingerprints of an anchor, from which they are joined by changed words
DIRECT = 16  # runs up to this size are compared pair by pair, longer ones grow a forest
AT_ONCE = 1 << 16  # hashes counted at once
MATRIX = 1 << 22  # comparisons made at once


def bit_majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), AT_ONCE):
        some = hashes[at : at + AT_ONCE]
        bits = np.zeros((-(-len(some) // 255) * 255, 8), dtype=np.uint64)  # eight counters a word
        bits.view(np.uint8)[: len(some)] = np.unpackbits(
            some.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
        )
        counts += bits.reshape(-1, 255, 8).sum(axis=1).view(np.uint8).sum(axis=0, dtype=np.int64)
    wide = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(wide.view("<u8")[0])


def fingerprint(text: bytes, ngram: int = NGRAM) -> int:
    """SimHash of a text's word shingles, A-Z in lower case; 0 without words."""
    import xxhash

    words = text.lower().split()  # of bytes: ASCII letters and white space only
    if not words:
        return 0
    if len(words) < ngram:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*[words[k:] for k in range(ngram)], strict=False))
    digest = xxhash.xxh64_intdigest
    return bit_majority(np.array([digest(s, SEED) for s in shingles], dtype=np.uint64))


def fingerprints(docs: DataFrame, *carry: Column, ngram: int = NGRAM) -> DataFrame:
    """Carried columns (default doc_id) and ``print`` (64 bits as long) of every row."""
    rows = docs.select(
        *(carry or (F.col("doc_id").cast("long").alias("doc_id"),)), F.encode("text", "utf-8").alias("bytes_of_text")
    )
    carried = rows.schema.fields[:-1]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in carried)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("bytes_of_text")
            found = np.array(
                [fingerprint(t.as_py() if t.is_valid else b"", ngram) for t in texts], dtype=np.uint64
            )
            kept = batch.drop_columns("bytes_of_text")
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(found.view(np.int64))], [*kept.schema.names, "print"]
            )

    return rows.mapInArrow(run, f"{schema}, print long")


def flips() -> np.ndarray:
    """By syndrome, what to change in a word to get the code words within 2 of it.

    Column k (from 1) of the code's check matrix is k itself, so a word's syndrome is the
    place of the one bit that leads to its home (0: it is a code word). Two bits lead to
    another code word if their places together give the syndrome.
    """
    places = 1 << CHECKS
    out = np.zeros((places, places // 2), dtype=np.uint64)
    for syndrome in range(1, places):
        out[syndrome, 0] = 1 << (syndrome - 1)
        pairs = [(i, i ^ syndrome) for i in range(1, places) if i < i ^ syndrome and i != syndrome]
        out[syndrome, 1:] = [(1 << (i - 1)) | (1 << (k - 1)) for i, k in pairs]
    return out


def syndromes(words: np.ndarray) -> np.ndarray:
    """Exclusive or of the places of all set bits."""
    out = np.zeros(len(words), dtype=np.int64)
    for check in range(CHECKS):
        mask = sum(1 << (k - 1) for k in range(1, 1 << CHECKS) if k >> check & 1)
        out |= (np.bitwise_count(words & np.uint64(mask)) & 1).astype(np.int64) << check
    return out


def anchors(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of a fingerprint, anchor) for all anchors within covering radius plus one."""
    length = (1 << CHECKS) - 1
    change = flips()
    index, found = [], []
    for piece in range(PIECES):
        words = (prints >> np.uint64(piece * 64 // PIECES)) & np.uint64((1 << length) - 1)
        syndrome = syndromes(words)
        near = words[:, None] ^ change[syndrome]
        use = np.ones(near.shape, dtype=bool)
        use[syndrome == 0, 1:] = False  # a code word has no other within 2
        index.append(np.nonzero(use)[0])
        found.append(near[use] | np.uint64(piece << length))
    return np.concatenate(index), np.concatenate(found)


def forest(prints: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that connect what is connected by all links between these fingerprints."""
    links = []
    rest = np.arange(len(prints))
    while len(rest):
        grown, rest = rest[:1], rest[1:]
        while len(grown) and len(rest):
            few = max(1, MATRIX // len(rest))
            now, grown = grown[:few], grown[few:]
            near = np.bitwise_count(prints[now][:, None] ^ prints[rest]) <= distance
            hit = near.any(axis=0)
            links += zip(now[near[:, hit].argmax(axis=0)].tolist(), rest[hit].tolist(), strict=True)
            grown, rest = np.concatenate([grown, rest[hit]]), rest[~hit]
    return links


def _compare(distance: int):
    def run(group: pa.Table) -> pa.Table:
        """Links (a, b) between the fingerprints of each anchor of a cell."""
        anchor = group.column("anchor").to_numpy()
        order = np.argsort(anchor, kind="stable")
        anchor = anchor[order]
        prints = group.column("print").to_numpy()[order].view(np.uint64)
        heads = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
        sizes = np.diff(np.append(heads, len(anchor)))
        left, right = [], []
        small = np.repeat(sizes <= DIRECT, sizes)
        for shift in range(1, DIRECT):
            at = np.flatnonzero((anchor[shift:] == anchor[:-shift]) & small[shift:])
            if not len(at):
                break
            at = at[np.bitwise_count(prints[at] ^ prints[at + shift]) <= distance]
            left.append(prints[at])
            right.append(prints[at + shift])
        for head, size in zip(heads[sizes > DIRECT].tolist(), sizes[sizes > DIRECT].tolist(), strict=True):
            own = prints[head : head + size]
            links = np.array(forest(own, distance), dtype=np.int64).reshape(-1, 2)
            left.append(own[links[:, 0]])
            right.append(own[links[:, 1]])
        ends = [np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (left, right)]
        return pa.table({c: pa.array(x.view(np.int64)) for c, x in zip("ab", ends, strict=True)})

    return run


def _changed(bits: int) -> list[int]:
    """All words of 64 bits with at most ``bits`` bits set, as signed numbers."""
    words = {0}
    for _ in range(bits):
        words |= {w | 1 << k for w in words for k in range(64)}
    return sorted(w - (1 << 64) if w >> 63 else w for w in words)


def _links_by_changed_words(prints: DataFrame, distance: int) -> DataFrame:
    """(a, b): links that connect fingerprints, without any that are compared in one task.

    Words one bit away (half of the distance) keep the smallest fingerprint that leads to
    them; whatever reaches such a word with the rest of the distance links to it.
    """
    near = F.lit(_changed(distance // 2))
    far = F.lit(_changed(distance - distance // 2))
    low = (
        prints.select("print", F.explode(near).alias("change"))
        .groupBy(F.col("print").bitwiseXOR(F.col("change")).alias("word"))
        .agg(F.min("print").alias("b"))
    )
    reach = prints.select("print", F.explode(far).alias("change")).select(
        F.col("print").alias("a"), F.col("print").bitwiseXOR(F.col("change")).alias("word")
    )
    return reach.join(low, "word").filter(F.col("a") != F.col("b")).select("a", "b").distinct()


def links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b): links between the distinct fingerprints in ``print`` that connect whatever is
    connected by fingerprints with ``distance`` or fewer differing bits."""
    if not 0 <= distance <= DISTANCE:
        raise ValueError(f"the anchors hold for distances up to {DISTANCE}")

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("print").to_numpy(zero_copy_only=False)
            index, found = anchors(own.view(np.uint64))
            columns = [pa.array(found.view(np.int64)), pa.array(own[index])]
            yield pa.RecordBatch.from_arrays(columns, ["anchor", "print"])

    replicas = keep(prints.mapInArrow(replicate, "anchor long, print long"), "simhash-anchors")
    per_anchor = replicas.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
    hot = keep(per_anchor.filter(F.col("n") > HOT).select("anchor"), "simhash-hot")
    many = not hot.isEmpty()
    cells = max(8, -(-replicas.count() // CELL_ROWS))
    compared = (
        (replicas.join(hot, "anchor", "left_anti") if many else replicas)
        .groupBy(F.pmod(F.xxhash64("anchor"), F.lit(cells)))
        .applyInArrow(_compare(distance), "a long, b long")
    )
    if many:
        crowd = replicas.join(hot, "anchor", "left_semi").select("print").distinct()
        compared = compared.unionByName(_links_by_changed_words(crowd, distance))
    return compared


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, ngram: int = NGRAM) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row.

    Needs doc_id and text; other columns are ignored. Null, empty and blank texts have
    fingerprint zero and link like any other; texts of any length are hashed whole. The
    component is the smallest doc_id among the rows that links lead to. Rows that repeat a
    doc_id are rows of their own; rows without one have no component and link with nothing.
    An empty table gives no rows.
    """
    rows = keep(fingerprints(docs, ngram=ngram), "simhash-prints")
    first = keep(
        rows.filter(F.col("doc_id").isNotNull()).groupBy("print").agg(F.min("doc_id").alias("first")),
        "simhash-firsts",
    )
    roots = components(links(first.select("print"), distance))
    rooted = first.join(roots.withColumnRenamed("node", "print"), "print", "left").select(
        "print", "first", F.coalesce("root", "print").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of_print = rooted.join(least, "root").select("print", "component_id")
    component = F.when(F.col("doc_id").isNotNull(), F.col("component_id"))
    return rows.join(of_print, "print", "left").select(
        "doc_id",
        F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"),
        component.alias("component_id"),
    )
