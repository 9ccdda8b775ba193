"""Duplicates: counting, inspecting and removing them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollbook.operators.reshape import metric_rows, settled
from rollbook.operators.skew import semi_join_spread


def dedup_keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key in arrival order; null key parts are equal to each other.

    A rank filter of this form is also applied before the shuffle
    (``WindowGroupLimit``), so a hot key leaves each map task as one row.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rn_", F.row_number().over(w)).filter("rn_ = 1").drop("rn_")


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys..., n)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def count_duplicates(df: DataFrame, keys: Sequence[str], metric: str = "duplicates") -> DataFrame:
    """One row: rows minus distinct keys. Over all columns it counts full duplicates."""
    return key_counts(df, keys).agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias(metric)
    )


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows whose key occurs more than once; rows of hot keys are not shuffled."""
    repeated = settled(key_counts(df, keys).filter("n > 1"))
    return semi_join_spread(df, repeated, keys)


def duplicate_counts(df: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """One row: rows, full-row duplicates, distinct keys and key duplicates, in one scan."""
    per_row = key_counts(df, columns)
    per_key = per_row.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("distinct_rows")
    )
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col("n") - F.col("distinct_rows")), F.lit(0)).alias("full_duplicates"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("key_duplicates"),
    )


def duplicate_impact(
    raw: DataFrame, columns: Sequence[str], keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """(metric, value): duplicates before and, measured on the result, after de-duplication."""
    before = duplicate_counts(raw, columns, keys).select(
        F.col("full_duplicates").alias("full_row_duplicates_before"),
        F.col("key_duplicates").alias("grain_duplicates_before"),
        F.col("rows").alias("rows_before"),
    )
    kept = dedup_keep_first(raw.select(*keys, *order), keys, order)
    after = key_counts(kept, keys).agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("grain_duplicates_after"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_after"),
    )
    return metric_rows(before, before.columns).unionByName(metric_rows(after, after.columns))
