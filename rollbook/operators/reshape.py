"""Small helpers that turn one aggregated row into a long report table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` written once into the plan, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def settled(df: DataFrame) -> DataFrame:
    """The same rows, computed once into the session's checkpoint folder.

    Steps that read a table several times then do not repeat what led to it, in the plan or in
    the work. A session without ``spark.checkpoint.dir`` gets the rows as they are.
    """
    return df.checkpoint() if df.sparkSession.conf.get("spark.checkpoint.dir", None) else df


def metric_rows(
    row: DataFrame, metrics: Sequence[str], name: str = "metric", value: str = "value"
) -> DataFrame:
    """(metric, value) rows from the columns of a one-row frame."""
    return row.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(m).alias(name), F.col(m).cast("bigint").alias(value))
                    for m in metrics
                ]
            )
        )
    )


def aggregate_per_column(
    df: DataFrame, columns: Sequence[str], metrics: Mapping[str, Column | callable]
) -> DataFrame:
    """One scan, one row per column: ``metrics`` maps a name to fn(column name) -> aggregate."""
    columns = list(columns)
    wide = df.agg(
        *[
            fn(c).alias(f"m{i}_{name}")
            for i, c in enumerate(columns)
            for name, fn in metrics.items()
        ]
    )
    return wide.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column"),
                        *[F.col(f"m{i}_{name}").alias(name) for name in metrics],
                    )
                    for i, c in enumerate(columns)
                ]
            )
        )
    )
