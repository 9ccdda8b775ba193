"""Profiles: counts, nulls, blanks, cardinality, distributions and functional dependencies.

Each profile is one scan with map-side combining; none collects a group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.functions.columns import DAY_FIRST, is_blank, month_of, parse_date
from rollbook.operators.quantiles import exact_quantiles
from rollbook.operators.reshape import aggregate_per_column, metric_rows


def table_shape(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: row count and column count."""
    columns = columns or df.columns
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.lit(len(columns)).cast("bigint").alias("columns")
    )


def _nulls(c: str) -> Column:
    return F.count_if(F.col(c).isNull())


def _blanks(c: str) -> Column:
    return F.count_if(is_blank(c))


def _null_pct(c: str) -> Column:
    share = _nulls(c) / F.greatest(F.count(F.lit(1)), F.lit(1))
    return F.round(share * 100, 6)


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, null_count, null_pct)."""
    return aggregate_per_column(df, columns, {"null_count": _nulls, "null_pct": _null_pct})


def blank_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, blank_count): texts that are empty once trimmed."""
    return aggregate_per_column(df, columns, {"blank_count": _blanks})


def missing_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, null_pct, blank_count, missing_count), most missing first."""
    profile = aggregate_per_column(
        df,
        columns,
        {
            "null_pct": _null_pct,
            "blank_count": _blanks,
            "missing_count": lambda c: _nulls(c) + _blanks(c),
        },
    )
    return profile.orderBy(F.desc("missing_count"), F.desc("null_pct"), "column")


def fully_empty_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: number of rows with every column null."""
    empty = reduce(and_, [F.col(c).isNull() for c in columns])
    return df.agg(F.count_if(empty).alias("fully_empty_rows"))


def null_cells(columns: Sequence[str]) -> Column:
    """Number of null cells in a row."""
    return reduce(add, [F.col(c).isNull().cast("bigint") for c in columns])


def value_counts_long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) for all columns in one shuffle of combined counts."""
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return (
        texts.unpivot([], list(columns), "column", "value")
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def column_profile(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """(column, dtype, non_null_count, null_count, null_pct, unique_count).

    ``exact=False`` counts distinct values by sketch, without any large shuffle.
    """
    dtype_of = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    if exact:
        base = (
            value_counts_long(df, columns)
            .groupBy("column")
            .agg(
                F.sum("n").alias("rows"),
                F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias(
                    "null_count"
                ),
                F.count("value").alias("unique_count"),
            )
        )
    else:
        base = aggregate_per_column(
            df,
            columns,
            {
                "rows": lambda c: F.count(F.lit(1)),
                "null_count": _nulls,
                "unique_count": lambda c: F.approx_count_distinct(c),
            },
        )
    dtypes = F.create_map(*[F.lit(x) for c in columns for x in (c, dtype_of[c])])
    return base.select(
        "column",
        dtypes[F.col("column")].alias("dtype"),
        (F.col("rows") - F.col("null_count")).alias("non_null_count"),
        "null_count",
        F.round(F.col("null_count") / F.greatest("rows", F.lit(1)) * 100, 6).alias("null_pct"),
        "unique_count",
    )


def describe_numeric(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """(column, count, mean, std, min, q25, q50, q75, max) with exact quartiles."""
    values = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "column", "value"
    )
    moments = values.groupBy("column").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = (
        exact_quantiles(values, "value", [0.25, 0.5, 0.75], by="column")
        .groupBy("column")
        .agg(
            *[
                F.max(F.when(F.col("idx") == i, F.col("quantile"))).alias(name)
                for i, name in enumerate(["q25", "q50", "q75"])
            ]
        )
    )
    numbers = ["mean", "std", "min", "q25", "q50", "q75", "max"]
    return moments.join(quartiles, "column", "left").select(
        "column", "count", *[F.round(c, digits).alias(c) for c in numbers]
    )


def describe_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, count, unique, top, freq); a tie for the top goes to the smaller text."""
    counts = value_counts_long(df, columns).filter(F.col("value").isNotNull())
    best = F.min(F.struct((-F.col("n")).alias("neg_n"), F.col("value")))
    return (
        counts.groupBy("column")
        .agg(
            F.sum("n").alias("count"),
            F.count(F.lit(1)).alias("unique"),
            best.alias("best"),
        )
        .select(
            "column",
            "count",
            "unique",
            F.col("best.value").alias("top"),
            (-F.col("best.neg_n")).alias("freq"),
        )
    )


def distinct_count(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, unique_count), nulls not counted."""
    return (
        value_counts_long(df, columns)
        .groupBy("column")
        .agg(F.count("value").alias("unique_count"))
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct labels, nulls left out."""
    return df.filter(F.col(column).isNotNull()).select(column).distinct().orderBy(column)


def cardinality_by(df: DataFrame, parent: str, child: str, name: str = "n_distinct") -> DataFrame:
    """Distinct children per parent, largest first; null parents are left out."""
    return (
        df.filter(F.col(parent).isNotNull())
        .groupBy(parent)
        .agg(F.count_distinct(child).alias(name))
        .orderBy(F.desc(name), parent)
    )


def fd_violations(
    df: DataFrame, determinant: str, dependent: str, name: str = "n_distinct"
) -> DataFrame:
    """Determinant values that map to more than one dependent value."""
    return (
        df.filter(F.col(determinant).isNotNull())
        .groupBy(determinant)
        .agg(F.count_distinct(dependent).alias(name))
        .filter(F.col(name) > 1)
    )


def fd_violation_count(df: DataFrame, determinant: str, dependent: str, metric: str) -> DataFrame:
    """(metric, value): how many determinant values break the dependency."""
    return metric_rows(
        fd_violations(df, determinant, dependent).agg(F.count(F.lit(1)).alias(metric)), [metric]
    )


def date_range(
    df: DataFrame, date: str = "date", formats: tuple[str, ...] = DAY_FIRST
) -> DataFrame:
    """One row: first date, last date and number of values that are no date."""
    return df.select(parse_date(date, formats).alias("d")).agg(
        F.min("d").alias("min_date"),
        F.max("d").alias("max_date"),
        F.count_if(F.col("d").isNull()).alias("null_dates"),
    )


def text_length_distribution(df: DataFrame, text: Column) -> DataFrame:
    """(length, n) sorted by length; null texts form a row of their own."""
    return (
        df.groupBy(F.length(text).cast("bigint").alias("length"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.asc_nulls_last("length"))
    )


MONTH_START = "month_start_"


def _with_month_start(
    df: DataFrame, date: str, keep_invalid_month: bool, formats: tuple[str, ...]
) -> DataFrame:
    """Adds the month as a date: grouping on it is cheaper than on formatted text."""
    rows = df.withColumn(MONTH_START, F.trunc(parse_date(date, formats), "month"))
    return rows if keep_invalid_month else rows.filter(F.col(MONTH_START).isNotNull())


def _month_text(keep_invalid_month: bool = False) -> Column:
    return month_of(MONTH_START, keep_invalid=keep_invalid_month).alias("month")


def monthly_total(
    df: DataFrame,
    total: Column,
    date: str = "date",
    keep_invalid_month: bool = False,
    formats: tuple[str, ...] = DAY_FIRST,
) -> DataFrame:
    """(month, total); ``keep_invalid_month`` adds a NaT month for unreadable dates."""
    sums = (
        _with_month_start(df, date, keep_invalid_month, formats)
        .groupBy(MONTH_START)
        .agg(F.sum(total).alias("total"))
    )
    return sums.select(_month_text(keep_invalid_month), "total")


def monthly_rows(
    df: DataFrame,
    date: str = "date",
    keep_invalid_month: bool = False,
    formats: tuple[str, ...] = DAY_FIRST,
) -> DataFrame:
    """(month, row_count)."""
    counts = (
        _with_month_start(df, date, keep_invalid_month, formats)
        .groupBy(MONTH_START)
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    return counts.select(_month_text(keep_invalid_month), "row_count")


def group_month_total(
    df: DataFrame,
    total: Column,
    group: str = "state",
    date: str = "date",
    formats: tuple[str, ...] = DAY_FIRST,
) -> DataFrame:
    """(group, month, total); rows with a null group or unreadable date are left out."""
    sums = (
        _with_month_start(df.filter(F.col(group).isNotNull()), date, False, formats)
        .groupBy(group, MONTH_START)
        .agg(F.sum(total).alias("total"))
    )
    return sums.select(group, _month_text(), "total")
