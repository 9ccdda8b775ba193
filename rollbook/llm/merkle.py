"""Merkle manifest of a table: aligned builders, postorder logs, proofs by position.

Rows are leaves of one tree per language; the trees' tops, in order of the language, are the
entries of a last tree, whose top is the root. In a tree every FAN consecutive nodes are
joined and hashed, the last run with what is left, until one node remains.

1. Leaves are put in order by range and numbered within their language, from counts per
   range. Only digests travel, never texts.
2. Builders take aligned stretches of FAN ** LEVELS entries and append nodes to their log as
   they are completed: a leaf, and after the last leaf of a node the node itself. So logs are
   in postorder, and every node's position follows from the sizes of the full subtrees before
   it. The tops of the builders are the entries of the next round.
3. Proofs are read from the logs, top down: the siblings on a leaf's way are addressed by
   position. A builder's entries get the way of its top behind their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollbook.llm.common import keep

FAN = 8
LEVELS = 3  # of a builder: FAN ** LEVELS entries
TIES = 64  # ranges over which equal leaves may be spread
PATH = "array<struct<place: int, others: string>>"
ENTRY = "tree string, place long, size long, digest binary, name string, doc_id long, altered binary"
NODE = "tree string, block long, position long, level int, digest binary, size long, name string, doc_id long, altered binary"
UPPER = "abcdefghijklmnopqrstuvwxyz".upper()


def field(value: Column) -> Column:
    """A value with its length in bytes before it, or a dash."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest_of(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def tampered(doc_id: Column) -> Column:
    """Rows that the audit changes: the checksum of the decimal id is divisible by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 0, F.lit(False))


def leaves_of(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, digest, altered): the leaf of each row, and the leaf that it would have
    if the letters A-Z of its text were lower-cased, for rows that are tampered with."""
    rest = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    changed = F.translate("text", UPPER, UPPER.lower())
    return docs.select(
        F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.unhex(digest_of(*rest, F.col("text"))).alias("digest"),
        F.when(tampered(F.col("doc_id")), F.unhex(digest_of(*rest, changed))).alias("altered"),
    )


def numbered(rows: DataFrame, tree: str, *order: str) -> DataFrame:
    """Rows with ``place``, from 0 in the given order within ``tree``, and the tree's ``size``.

    Rows are sorted by range. Equal ones may lie in several ranges: among them any order
    will do, so that a row with very many copies does not end in one task.
    """
    tie = (F.monotonically_increasing_id() % TIES).alias("tie_")
    by = [F.col(c).asc_nulls_first() for c in (tree, *order, "tie_")]
    ranged = keep(
        rows.select("*", tie)
        .repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .drop("tie_")
        .select("*", F.spark_partition_id().alias("range_"), F.monotonically_increasing_id().alias("row_")),
        "merkle-ranges",
    )
    spans = ranged.groupBy(tree, "range_").agg(F.count(F.lit(1)).alias("n_"), F.min("row_").alias("first_"))
    whole = Window.partitionBy(tree)
    before = F.sum("n_").over(whole.orderBy("range_")) - F.col("n_") - F.col("first_")
    spans = spans.select(tree, "range_", before.alias("shift_"), F.sum("n_").over(whole).alias("size"))
    return (
        ranged.join(spans, [tree, "range_"])
        .withColumn("place", F.col("row_") + F.col("shift_"))
        .drop("range_", "row_", "shift_")
    )


def height(entries: int) -> int:
    """Levels of a tree of so many entries."""
    levels = 0
    while entries > 1:
        entries = -(-entries // FAN)
        levels += 1
    return levels


def leaf_position(entry: np.ndarray) -> np.ndarray:
    """Place of entries in a builder's log: before an entry stand the entries before it and,
    for every level, the nodes that they completed."""
    position, full = entry.copy(), entry // FAN
    while full.any():
        position += full
        full //= FAN
    return position


def node_positions(entries: int, levels: int) -> list[np.ndarray]:
    """Places in the log of the nodes of each level: a node follows its last entry and the
    nodes below it that are completed with that entry."""
    out = []
    for level in range(levels + 1):
        width = FAN**level
        last = np.minimum(np.arange(width, entries + width, width), entries) - 1
        out.append(leaf_position(last) + level)
    return out


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _levels(entries: int, size: int) -> int:
    """A builder of a tree that it holds whole stops at its top, others at their last level."""
    return height(entries) if size <= FAN**LEVELS else LEVELS


def _build(group: pa.Table) -> pa.Table:
    """The log of one builder: its nodes in the order in which they are completed."""
    group = group.sort_by("place")
    entries, size = group.num_rows, group.column("size")[0].as_py()
    levels = _levels(entries, size)
    digests = [d.hex() for d in group.column("digest").to_pylist()]
    log: list[str] = []
    level_of: list[int] = []
    opened: list[list[str]] = [[] for _ in range(levels + 1)]  # children that wait for their node
    for k, digest in enumerate(digests):
        last = k == entries - 1
        for level in range(levels + 1):
            log.append(digest)
            level_of.append(level)
            if level == levels:
                break
            opened[level].append(digest)
            if len(opened[level]) < FAN and not last:
                break
            digest = sha256("".join(opened[level]))
            opened[level].clear()
    at = np.full(len(log), -1)
    at[leaf_position(np.arange(entries))] = np.arange(entries)
    take = pa.array(at, mask=at < 0)
    top = np.arange(len(log)) == len(log) - 1
    whole = {c: pa.array([group.column(c)[0].as_py()] * len(log), t) for c, t in (("tree", pa.string()), ("block", pa.int64()))}
    return pa.table(
        whole
        | {
            "position": pa.array(np.arange(len(log))),
            "level": pa.array(level_of, pa.int32()),
            "digest": pa.array([bytes.fromhex(d) for d in log], pa.binary()),
            "size": pa.array(np.full(len(log), size), mask=~top),
        }
        | {c: group.column(c).combine_chunks().take(take) for c in ("name", "doc_id", "altered")}
    )


def logs_of(entries: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The logs of all rounds, lowest first, and (tree, digest): the tops of the trees."""
    logs = []
    while True:
        block = F.floor(F.col("place") / FAN**LEVELS).cast("long").alias("block")
        log = keep(entries.select("*", block).groupBy("tree", "block").applyInArrow(_build, NODE), "merkle-log")
        logs.append(log)
        tops = log.filter(F.col("size").isNotNull())
        most = tops.agg(F.max("size")).first()[0] or 0
        none = F.lit(None)
        entries = tops.select(
            "tree",
            F.col("block").alias("place"),
            F.ceil(F.col("size") / FAN**LEVELS).cast("long").alias("size"),
            "digest",
            none.cast("string").alias("name"),
            none.cast("long").alias("doc_id"),
            none.cast("binary").alias("altered"),
        )
        if most <= FAN**LEVELS:
            return logs, entries.select("tree", "digest")


class Way:
    """Siblings of all entries of one builder, read from its log by position."""

    def __init__(self, log: pa.Table, above: pa.Table):
        log = log.sort_by("position")
        self.digests = [d.hex() for d in log.column("digest").to_pylist()]
        self.entries = int((log.column("level").to_numpy() == 0).sum())
        size = log.column("size")[log.num_rows - 1].as_py()
        self.levels = _levels(self.entries, size)
        self.at = node_positions(self.entries, self.levels)
        self.rows = log.take(pa.array(self.at[0]))
        self.runs = []
        for level in range(self.levels):
            nodes = [self.digests[p] for p in self.at[level].tolist()]
            self.runs.append(["".join(nodes[i : i + FAN]) for i in range(0, len(nodes), FAN)])
        self.above = above.to_pylist()[0]

    def of(self, entry: int) -> Iterator[tuple[int, str]]:
        """(place in the run, the others of the run joined), level by level up to the root."""
        for runs in self.runs:
            entry, place = divmod(entry, FAN)
            run = runs[entry]
            yield place, run[: 64 * place] + run[64 * place + 64 :]
        for step in self.above["path"]:
            yield step["place"], step["others"]


def _paths(log: pa.Table, above: pa.Table) -> pa.Table:
    """The way of every entry of a builder above the lowest round."""
    way = Way(log, above)
    n = way.entries
    steps = [[{"place": p, "others": o} for p, o in way.of(k)] for k in range(n)]
    kind = pa.list_(pa.struct([("place", pa.int32()), ("others", pa.string())]))
    return pa.table(
        {
            "tree": pa.array([above.column("tree")[0].as_py()] * n, pa.string()),
            "place": pa.array(np.arange(n) + above.column("block")[0].as_py() * FAN**LEVELS),
            "name": way.rows.column("name"),
            "digest": pa.array([way.digests[p].encode() for p in way.at[0].tolist()], pa.binary()),
            "path": pa.array(steps, kind),
            "subroot": pa.array([way.above["subroot"]] * n, pa.string()),
            "root": pa.array([way.above["root"]] * n, pa.string()),
        }
    )


PATHS = f"tree string, place long, name string, digest binary, path {PATH}, subroot string, root string"
PROOF = (
    "doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
    "folded_root string, verified boolean"
)


def _proofs(log: pa.Table, above: pa.Table) -> pa.Table:
    """The proof of every leaf of a builder of the lowest round, and what it folds to."""
    way = Way(log, above)
    root, subroot = way.above["root"], way.above["subroot"]
    out: dict[str, list] = {c.split()[0]: [] for c in PROOF.split(", ")}
    rows = zip(way.rows.column("doc_id").to_pylist(), way.rows.column("altered").to_pylist(), way.at[0].tolist(), strict=True)
    for k, (doc_id, altered, at) in enumerate(rows):
        leaf = way.digests[at]
        folded = altered.hex() if altered is not None else leaf
        siblings = []
        for place, others in way.of(k):
            siblings.append(others)
            folded = sha256(others[: 64 * place] + folded + others[64 * place :])
        values = (doc_id, leaf, subroot, root, sha256("".join(siblings)), folded, folded == root)
        for column, value in zip(out.values(), values, strict=True):
            column.append(value)
    kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
    return pa.table({c: pa.array(v, t) for (c, v), t in zip(out.items(), kinds, strict=True)})


def _read_down(logs: list[DataFrame], above: DataFrame, lowest, schema: str) -> DataFrame:
    """Ways of the entries of the lowest round, from the ways of the trees' tops."""
    for k in reversed(range(len(logs))):
        read, columns = (lowest, schema) if k == 0 else (_paths, PATHS)
        met = logs[k].groupBy("tree", "block").cogroup(above.groupBy("tree", "block"))
        above = met.applyInArrow(read, columns)
        if k:
            above = above.select("tree", F.col("place").alias("block"), "path", "subroot", "root")
    return above


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for every row.

    Needs doc_id, source, lang, n_chars and text; other columns are ignored. A null value has
    a mark of its own, an empty text is a text of length 0; texts of any length are hashed
    where they are read. Rows without a doc_id come first in their language and are not
    tampered with. Rows that repeat a doc_id are leaves of their own, in order of their
    digests; each of several equal rows has its own proof. An empty table gives no rows.
    """
    leaves = keep(leaves_of(docs), "merkle-leaves")  # so that texts are hashed once
    logs, tops = logs_of(_entries(numbered(leaves, "tree", "doc_id", "digest")))
    named = tops.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    last_logs, root = logs_of(_entries(numbered(named, "tree", "name")))
    top = root.select(
        "tree",
        F.lit(0).cast("long").alias("block"),
        F.array().cast(PATH).alias("path"),
        F.lit("").alias("subroot"),
        F.lower(F.hex("digest")).alias("root"),
    )
    ways = _read_down(last_logs, top, _paths, PATHS)
    ways = ways.select(
        F.col("name").alias("tree"),
        F.lit(0).cast("long").alias("block"),
        "path",
        F.col("digest").cast("string").alias("subroot"),
        "root",
    )
    return _read_down(logs, ways, _proofs, PROOF)


def _entries(rows: DataFrame) -> DataFrame:
    """Rows with all columns of an entry."""
    kinds = dict(c.split(" ") for c in ENTRY.split(", "))
    have = set(rows.columns)
    return rows.select(
        *[F.col(c) if c in have else F.lit(None).cast(t).alias(c) for c, t in kinds.items()]
    )
