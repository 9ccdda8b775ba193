"""Steps whose tasks stay alike: by one heavy key, and as the rows grow."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key with more than this share of all counted rows is hot, so there can be
# at most 1 / HOT_SHARE hot keys: that bounds the broadcast.
HOT_SHARE = 1 / 256

# A task sorts or groups about so many rows. A key's rows from all scans go to so many tasks.
TASK_ROWS = 400_000
DEALS = 16


def null_safe(keys: Sequence[str], prefix: str) -> Column:
    """Equality on keys against ``prefix + key``, null matching null."""
    return reduce(and_, [F.col(k).eqNullSafe(F.col(prefix + k)) for k in keys])


def hot_keys(key_counts: DataFrame, count: str = "n", share: float = HOT_SHARE) -> DataFrame:
    """Keys holding more than ``share`` of the counted rows: at most 1/share of them."""
    total = key_counts.agg(F.sum(count)).scalar()
    return key_counts.filter(F.col(count) > total * F.lit(share))


def semi_join_spread(
    df: DataFrame,
    members: DataFrame,
    keys: Sequence[str],
    count: str = "n",
    share: float = HOT_SHARE,
) -> DataFrame:
    """Rows of ``df`` whose key is in ``members``; rows of hot keys are never shuffled.

    ``members`` has each key once with its row count. A hot key is a member by
    definition and its few names are broadcast, so its rows are passed on where they
    are read; only the rest joins on the key. Null key parts match null.
    """
    keys = list(keys)
    hot = F.broadcast(
        hot_keys(members, count, share).select(*[F.col(k).alias("hot_" + k) for k in keys])
    )
    others = members.select(*[F.col(k).alias("m_" + k) for k in keys])
    at_once = df.join(hot, null_safe(keys, "hot_"), "left_semi")
    rest = df.join(hot, null_safe(keys, "hot_"), "left_anti")
    return at_once.unionByName(rest.join(others, null_safe(keys, "m_"), "left_semi"))


def spread(df: DataFrame, keys: Sequence[str], rows: int | None) -> DataFrame:
    """``df`` dealt out by ``keys`` to as many partitions as its ``rows`` need.

    The session's number of partitions, and what adaptive execution joins of them, hold for
    every size of input, so a task would sort or group more rows as the input grows. Few or
    unknown rows are left to the session. For keys of few rows each: no map-side sums.
    """
    pieces = -(-(rows or 0) // TASK_ROWS)
    few = pieces <= df.sparkSession.sparkContext.defaultParallelism
    return df if few else df.repartition(pieces, *keys)


def spread_distinct(df: DataFrame, rows: int | None) -> DataFrame:
    """``df`` without repeated rows in a partition, those ``spread`` by value; a few repeats may stay.

    Copies of one row meet in several tasks, by the scan that they come from: a row that makes
    up a large part of the table leaves each of them once.
    """
    dealt = df.withColumn("deal_", F.spark_partition_id() % DEALS)
    parts = spread(dealt, [*df.columns, "deal_"], rows)
    return df.distinct() if parts is dealt else parts.distinct().select(*df.columns)
