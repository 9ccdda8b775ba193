"""Profiles that merge: counts and sketches per batch, put together without the rows.

Distinct counts come from HyperLogLog sketches, quantiles from KLL sketches. Both merge in any
order; a merged sketch answers with the same error bounds as one over all rows: distinct counts
within ``DISTINCT_ERROR`` and ranks within ``RANK_ERROR`` in 99 of 100 cases.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollbook.functions.columns import is_blank
from rollbook.operators.contracts import SEVERITY_WEIGHT

LOG_BUCKETS = 14  # of a distinct sketch: 2 ** 14 registers
DISTINCT_ERROR = 0.025
KLL_SIZE = 400
RANK_ERROR = 0.01


def column_sketches(df: DataFrame, columns: Sequence[str], measures: Sequence[str] = ()) -> DataFrame:
    """(column, rows, nulls, blanks, low, high, distinct, ranks): one row per column.

    Columns are counted as text; ``measures`` also have a sketch of their ranks. One scan, and
    one row per column and task goes on.
    """

    def parts(c: str) -> dict[str, Column]:
        numeric = c in measures
        text = F.col(c).cast("string")
        number = F.col(c).cast("double")
        return {
            "rows": F.count(F.lit(1)),
            "nulls": F.count_if(F.col(c).isNull()),
            "blanks": F.count_if(F.coalesce(is_blank(c), F.lit(False))),
            "low": F.min(number) if numeric else F.lit(None).cast("double"),
            "high": F.max(number) if numeric else F.lit(None).cast("double"),
            "distinct": F.hll_sketch_agg(text, F.lit(LOG_BUCKETS)),
            "ranks": F.kll_sketch_agg_double(number, F.lit(KLL_SIZE)) if numeric else F.lit(None).cast("binary"),
        }

    wide = df.agg(*[v.alias(f"{c}/{name}") for c in columns for name, v in parts(c).items()])
    names = ("rows", "nulls", "blanks", "low", "high", "distinct", "ranks")
    rows = [F.struct(F.lit(c).alias("column"), *[F.col(f"`{c}/{n}`").alias(n) for n in names]) for c in columns]
    return wide.select(F.inline(F.array(*rows)))


def merge_sketches(stored: DataFrame) -> DataFrame:
    """Sketches of any batches made one per column; the rows of the batches are not read."""
    counts = [F.sum(c).alias(c) for c in ("rows", "nulls", "blanks")]
    return stored.groupBy("column").agg(
        *counts,
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.kll_merge_agg_double("ranks").alias("ranks"),
    )


def sketch_profile(merged: DataFrame, probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """(column, rows, null_count, blank_count, unique_estimate, min, max, quantiles)."""
    known = F.col("ranks").isNotNull() & (F.kll_sketch_get_n_double("ranks") > 0)
    quantiles = F.when(known, F.kll_sketch_get_quantile_double("ranks", F.array(*[F.lit(float(p)) for p in probs])))
    return merged.select(
        "column",
        "rows",
        F.col("nulls").alias("null_count"),
        F.col("blanks").alias("blank_count"),
        F.hll_sketch_estimate("distinct").alias("unique_estimate"),
        F.col("low").alias("min"),
        F.col("high").alias("max"),
        quantiles.alias("quantiles"),
    )


def score_history(scores: DataFrame, severities: Mapping[str, str]) -> DataFrame:
    """(batch_id, rows, score, rows_so_far, score_so_far) from failed rows per batch and rule.

    ``scores`` has batch_id, rows and a count of failed rows per rule. The running score is the
    one over all rows of the batches up to then.
    """
    weights = {rule: SEVERITY_WEIGHT[severity] for rule, severity in severities.items()}
    # a row per batch: one ordered window is small
    upto = Window.orderBy("batch_id").rowsBetween(Window.unboundedPreceding, 0)

    def score(rows: Column, failed) -> Column:
        lost = sum(failed(rule) / F.greatest(rows, F.lit(1)) * weight for rule, weight in weights.items())
        return F.round((1 - lost / sum(weights.values())) * 100, 6)

    return scores.select(
        "batch_id",
        "rows",
        score(F.col("rows"), lambda rule: F.col(rule)).alias("score"),
        F.sum("rows").over(upto).alias("rows_so_far"),
        score(F.sum("rows").over(upto), lambda rule: F.sum(rule).over(upto)).alias("score_so_far"),
    )
