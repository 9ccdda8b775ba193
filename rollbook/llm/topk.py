"""Exact top-k search by inner product with sequential access only (no random access).

Each dimension is a list sorted by its component. Lists are read in step from their better
end; every entry read is added to the sum of its vector. After a depth of d entries an unread
component is known to lie between the last entry read and the end of its list. That gives
every vector a lower and an upper bound of its score. The k-th best lower bound is the
threshold: once no outsider's upper bound can pass it, only entries of the vectors left are
still added, until their sums are their final scores. No component is read but in the order
of its list, and none twice.

Vectors and queries meet in blocks of a bounded size; each block pair keeps its k best per
query, and these are merged.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 20
SCALE = 64
VECTORS_PER_BLOCK = 8_192
QUERIES_PER_BLOCK = 1_024
QUERIES_AT_ONCE = 128
FIRST_DEPTH = 256  # entries of each list read before the first look at the bounds
DEEPER = 8  # times as deep the next look is
EXACT = 1 << 52  # sums below this are exact in a double; beyond, whole numbers are summed


def whole_vectors(table: DataFrame, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, v): rows with a usable vector, components floor(scale * x) as whole numbers.

    Vectors that are null or hold a null or non-finite component are left out. Components
    are long: what lies beyond that range is held at its end.
    """

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    doubles = F.transform(F.col(vector), lambda x: x.cast("double"))
    whole = F.transform(doubles, lambda x: F.floor(x * scale).cast("long"))
    usable = F.col(vector).isNotNull() & F.forall(doubles, finite)
    return table.select("vec_id", F.when(usable, whole).alias("v")).filter(
        F.col("v").isNotNull() & F.col("vec_id").isNotNull()
    )


class Lists:
    """The sorted lists of a block of vectors, and each vector's place in them."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x = ids, x
        self.order = np.argsort(x, axis=0, kind="stable")
        self.sorted = np.take_along_axis(x, self.order, axis=0)
        self.place = np.empty(x.shape, dtype=np.int32)
        np.put_along_axis(self.place, self.order, np.arange(len(x), dtype=np.int32)[:, None], axis=0)


def bounded_search(
    lists: Lists, query_ids: np.ndarray, q: np.ndarray, k: int, first: int = FIRST_DEPTH
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query index, vec_id, score) of the k best rows of one block for each query, and how many
    entries were added to a sum.

    ``q`` holds the queries, of the type of the block's components. The query's own row takes
    no part. Ties go to the smaller id.
    """
    ids, x = lists.ids, lists.x
    n, size = x.shape
    kind = x.dtype.type if x.dtype != object else object
    up, down = np.maximum(q, 0).T, np.minimum(q, 0).T  # dimension x query
    sums = np.zeros((n, len(q)), dtype=kind)
    live = ids[:, None] != query_ids[None, :]
    reads = 0
    depth = 0
    while depth < n and size:
        to = min(n, DEEPER * depth or first)
        rows = np.flatnonzero(live.any(axis=1))
        place = lists.place[rows]
        for weights, read in (
            (up, (place >= n - to) & (place < n - depth)),
            (down, (place >= depth) & (place < to)),
        ):
            # the entries of this step, all else zero: one product adds them for all queries
            sums[rows] += np.where(read, x[rows], 0) @ weights
            reads += int(read.sum(axis=0) @ np.count_nonzero(weights, axis=1))
        depth = to
        if depth < n:
            live = _still_in(lists, sums, live, up, down, depth, k)
    out_q, out_id, out_score = [], [], []
    for i in range(len(q)):
        left = np.flatnonzero(live[:, i])
        if len(left) > k:
            left = left[sums[left, i] >= _kth_largest(sums[left, i], k)]
        scores = sums[left, i]
        best = sorted(range(len(left)), key=lambda j: (-scores[j], ids[left[j]]))[:k]
        out_q.append(np.full(len(best), i))
        out_id.append(ids[left][best])
        out_score.append(scores[best])
    return np.concatenate(out_q), np.concatenate(out_id), np.concatenate(out_score), reads


def _still_in(
    lists: Lists, sums: np.ndarray, live: np.ndarray, up: np.ndarray, down: np.ndarray, depth: int, k: int
) -> np.ndarray:
    """The pairs of vector and query that can still be among the k best, by their bounds."""
    rows = np.flatnonzero(live.any(axis=1))
    place, n = lists.place[rows], len(lists.x)
    kind = sums.dtype
    unread = np.concatenate([place < n - depth, place >= depth], axis=1).astype(kind)
    some = sums[rows]

    def rest(high: np.ndarray, low: np.ndarray) -> np.ndarray:
        return some + unread @ np.concatenate([up * high[:, None], down * low[:, None]])

    # an unread component lies between the last entry read and the end of its list
    upper = rest(lists.sorted[n - depth], lists.sorted[depth - 1])
    lower = rest(lists.sorted[0], lists.sorted[-1])
    out = live.copy()
    for i in range(sums.shape[1]):
        mine = live[rows, i]
        bounds = lower[mine, i]
        if len(bounds) > k:
            out[rows, i] &= upper[:, i] >= _kth_largest(bounds, k)
    return out


def _kth_largest(values: np.ndarray, k: int):
    return np.sort(values)[-k] if values.dtype == object else np.partition(values, -k)[-k]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query its k best other rows of ``vectors``.

    Both tables have vec_id (a key) and v (array of long, see ``whole_vectors``); other
    columns are ignored. Vectors whose length differs from the query's have no score with
    it. Repeated rows of an id count as often as they occur, but never for their own id.
    Empty tables give no rows.
    """
    vector_blocks = max(1, -(-vectors.count() // VECTORS_PER_BLOCK))
    query_blocks = max(1, -(-queries.count() // QUERIES_PER_BLOCK))

    def spread(n: int, other: int, mine: str, theirs: str, df: DataFrame) -> DataFrame:
        return df.select(
            "vec_id",
            "v",
            F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int").alias(mine),
            F.explode(F.sequence(F.lit(0), F.lit(other - 1))).alias(theirs),
        ).groupBy("qb", "vb")

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        sizes = {len(v) for v in right["v"]} if len(left) else set()
        for size in sizes:
            cand = left[left["v"].map(len) == size]
            asks = right[right["v"].map(len) == size]
            if not len(cand):
                continue
            ids = cand["vec_id"].to_numpy(dtype=np.int64)
            x = np.stack(cand["v"].to_numpy()).reshape(len(cand), size)
            qid = asks["vec_id"].to_numpy(dtype=np.int64)
            q = np.stack(asks["v"].to_numpy()).reshape(len(asks), size)
            most = [max(map(abs, (int(v.max()), int(v.min())))) if v.size else 0 for v in (x, q)]
            kind = np.float64 if max(size, 1) * most[0] * most[1] < EXACT else object
            lists, q = Lists(ids, x.astype(kind)), q.astype(kind)
            for at in range(0, len(q), QUERIES_AT_ONCE):
                part = slice(at, at + QUERIES_AT_ONCE)
                i, vec, score, _ = bounded_search(lists, qid[part], q[part], min(k, len(x)))
                found.append(
                    pd.DataFrame({"query_id": qid[part][i], "vec_id": vec, "score": score})
                )
        if not found:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        return pd.concat(found).astype("int64")

    schema = "query_id long, vec_id long, score long"
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        spread(vector_blocks, query_blocks, "vb", "qb", vectors)
        .cogroup(spread(query_blocks, vector_blocks, "qb", "vb", queries))
        .applyInPandas(run, schema)
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
