"""Exact quantiles without bringing a column's values to one task.

The built-in exact ``percentile`` merges a map of all distinct values in one reducer. Here
values are counted once; a sketch of the distinct values then cuts them into ``CELLS`` cells
of about equal size. Cell totals are a bounded table and tell which cells hold the wanted
ranks; only the values of those cells are put in order, each cell on its own. The sketch
decides the sizes of cells, never the answer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollbook.operators.reshape import let, settled

SKETCH_ACCURACY = 10_000
STEPS = 32  # cuts are searched in two steps of this many
CELLS = STEPS * STEPS


def value_counts(df: DataFrame, value: str, *group: str) -> DataFrame:
    """(group, v, n): how often each value occurs, as a double."""
    return (
        df.select(*group, F.col(value).cast("double").alias("v"))
        .groupBy(*group, "v")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def exact_quantiles(
    df: DataFrame, value: str, probs: Sequence[float], by: str | None = None
) -> DataFrame:
    """(by, idx, prob, quantile): quantiles interpolated linearly between order statistics.

    ``probs`` ascend. Nulls and NaN are left out; a group without values has no rows.
    """
    counts = settled(value_counts(df, value, *([by] if by else [])))
    return quantiles_of_counts(counts, probs, by)


def quantiles_of_counts(
    counts: DataFrame, probs: Sequence[float], by: str | None = None
) -> DataFrame:
    """``exact_quantiles`` of a table (by, v, n) in which each value stands once.

    The table is read three times: settle it first.
    """
    group = [by] if by else []
    counts = counts.filter(F.col("v").isNotNull() & ~F.isnan("v")).select(*group, "v", "n")
    even = [i / CELLS for i in range(1, CELLS)]
    cuts = counts.groupBy(*group).agg(
        F.percentile_approx("v", even, SKETCH_ACCURACY).alias("cuts")
    )
    cut = counts.join(cuts, by) if by else counts.withColumn("cuts", cuts.select("cuts").scalar())
    cell = let(F.col("cuts"), lambda c: _cell(F.col("v"), c))
    celled = cut.select(*group, "v", "n", cell.alias("cell"))

    # at most CELLS rows per group from here to the targets
    along = Window.partitionBy(*group).orderBy("cell")
    totals = (
        celled.groupBy(*group, "cell")
        .agg(F.sum("n").alias("in_cell"))
        .withColumn("before", F.sum("in_cell").over(along) - F.col("in_cell"))
        .withColumn("rows_", F.sum("in_cell").over(Window.partitionBy(*group)))
    )
    last_rank = F.col("rows_") - 1
    wanted = F.array(
        *[
            F.struct(
                F.lit(i).alias("idx"),
                F.lit(float(p)).alias("prob"),
                F.floor(F.lit(float(p)) * last_rank).alias("lower"),
                F.ceil(F.lit(float(p)) * last_rank).alias("upper"),
                (F.lit(float(p)) * last_rank % 1).alias("part"),
            )
            for i, p in enumerate(probs)
        ]
    )

    def within(rank: Column, first: Column, n: Column) -> Column:
        return (rank >= first) & (rank < first + n)

    def holds(first: Column, n: Column):
        return lambda t: within(t["lower"], first, n) | within(t["upper"], first, n)

    targets = totals.select(
        *group,
        "cell",
        "before",
        F.filter(wanted, holds(F.col("before"), F.col("in_cell"))).alias("targets"),
    ).filter(F.size("targets") > 0)

    in_cell = Window.partitionBy(*group, "cell").orderBy("v")
    ranked = celled.join(targets, [*group, "cell"]).withColumn(
        "first", F.col("before") + F.sum("n").over(in_cell) - F.col("n")
    )
    hit = ranked.select(
        *group,
        "v",
        "n",
        "first",
        F.explode(F.filter("targets", holds(F.col("first"), F.col("n")))).alias("t"),
    )

    def value_at(rank: str) -> Column:
        return F.max(F.when(within(F.col(rank), F.col("first"), F.col("n")), F.col("v")))

    result = hit.groupBy(*group, "t.idx", "t.prob").agg(
        value_at("t.lower").alias("at_lower"),
        value_at("t.upper").alias("at_upper"),
        F.max("t.part").alias("part"),
    )
    # interpolated from the nearer side, as numpy does: bin edges must agree to the last bit
    step = F.col("at_upper") - F.col("at_lower")
    quantile = F.when(
        F.col("part") >= 0.5, F.col("at_upper") - step * (1 - F.col("part"))
    ).otherwise(F.col("at_lower") + step * F.col("part"))
    return result.select(*group, "idx", "prob", quantile.alias("quantile"))


def _cell(value: Column, cuts: Column) -> Column:
    """How many of the sorted cuts a value reaches: first among every ``STEPS``-th, then between."""
    coarse = F.array(*[F.get(cuts, F.lit(k * STEPS - 1)) for k in range(1, STEPS)])
    step = F.size(F.filter(coarse, lambda c: c <= value))

    def fine(k: Column) -> Column:
        between = F.slice(cuts, k * STEPS + 1, F.lit(STEPS - 1))
        return k * STEPS + F.size(F.filter(between, lambda c: c <= value))

    return let(step, fine)
