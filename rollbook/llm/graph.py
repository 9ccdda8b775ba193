"""Connected components of an edge list, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import keep


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node with an edge, and the smallest node it is connected with.

    ``edges`` has a and b, long. Each round hangs neighbours on the smallest node in reach
    (large star, then small star) and writes the result; it ends when a round changes
    nothing. Minima are combined before the shuffle, so a node with very many edges is safe.
    """
    now = keep(
        edges.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    before = _mark(now)
    while before[0]:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            now.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.filter(F.col("v") > F.col("u"))
            .join(low.select("u", F.least("u", "m").alias("m")), "u")
            .select("v", "m")
            .distinct()
        )
        down = large.select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            down.join(least, "u")
            .select(
                F.explode(
                    F.array(
                        F.struct(F.col("v").alias("a"), F.col("m").alias("b")),
                        F.struct(F.col("u").alias("a"), F.col("m").alias("b")),
                    )
                ).alias("e")
            )
            .select("e.a", "e.b")
            .filter(F.col("a") != F.col("b"))
            .distinct()
        )
        now = keep(small, "edges")
        after = _mark(now)
        if after == before:
            break
        before = after
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        roots.select("node", F.col("node").alias("root"))
    )


def _mark(edges: DataFrame) -> tuple:
    """Count and checksum of an edge set: equal for equal sets."""
    row = edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).first()
    return tuple(row)
