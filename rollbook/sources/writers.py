"""Sinks: bronze appends, refreshes, tables, reports and the load audit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_lineage(
    df: DataFrame,
    source: str | Column,
    batch_id: int | str,
    event_ts: Column | None = None,
    ingest_ts: Column | None = None,
    topic: Column | None = None,
    offset: Column | None = None,
) -> DataFrame:
    """Adds source, event_ts, ingest_ts, topic, offset and batch_id to each row."""
    return df.withColumns(
        {
            "source": F.lit(source),
            "event_ts": F.lit(None).cast("timestamp") if event_ts is None else event_ts,
            "ingest_ts": F.current_timestamp() if ingest_ts is None else ingest_ts,
            "topic": F.lit(None).cast("string") if topic is None else topic,
            "offset": F.lit(None).cast("bigint") if offset is None else offset,
            "batch_id": F.lit(batch_id).cast("bigint"),
        }
    )


def write_batch(df: DataFrame, path: str, batch_id: int, fmt: str = "parquet") -> None:
    """Store a batch as ``path/batch_id=N``; writing the batch again replaces it.

    Other batches are never touched, so the table as a whole only grows.
    """
    df.drop("batch_id").write.format(fmt).mode("overwrite").save(f"{path}/batch_id={batch_id}")


def by_partition(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Brings the rows of an output partition together before a partitioned write.

    Otherwise each task writes a small file into each partition. The rebalance
    hint lets adaptive execution size the files and split a large partition.
    """
    return df.hint("rebalance", *[F.col(c) for c in partition_by])


def write_parts(df: DataFrame, path: str, parts: Sequence[str] = ()) -> None:
    """Replace all that ``path`` holds, by the partition columns if there are any."""
    writer = (by_partition(df, parts) if parts else df).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "static").partitionBy(*parts).parquet(path)


def refresh_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    incremental: bool = False,
) -> None:
    """Full refresh: afterwards the table holds the rows of ``df`` and no others.

    ``incremental`` replaces only the partitions that ``df`` has and keeps the rest.
    """
    if not partition_by:
        df.write.format(fmt).mode("overwrite").save(path)
        return
    writer = by_partition(df, partition_by).write.format(fmt).mode("overwrite")
    writer.partitionBy(*partition_by).option(
        "partitionOverwriteMode", "dynamic" if incremental else "static"
    ).save(path)


def create_table_as(df: DataFrame, name: str, fmt: str = "parquet") -> None:
    """Drop the table if it exists and create it from ``df``."""
    df.write.format(fmt).mode("overwrite").saveAsTable(name)


def append_table(df: DataFrame, name: str) -> None:
    """Append to an existing table, columns matched by name."""
    columns = df.sparkSession.table(name).columns
    df.select(*columns).write.insertInto(name)


def verify_row_count(df: DataFrame) -> DataFrame:
    """One row: ``total_merged_rows``."""
    return df.agg(F.count(F.lit(1)).alias("total_merged_rows"))


def load_audit(df: DataFrame, source: str, bad_row: Column) -> DataFrame:
    """(source, rows, bad_rows) of a load."""
    return df.groupBy(F.col(source).alias("source")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.coalesce(bad_row, F.lit(False))).alias("bad_rows"),
    )


def append_audit(
    audit: DataFrame,
    path: str,
    batch_id: int,
    started: float,
    ended: float,
    errors: Mapping[str, str] | None = None,
) -> None:
    """Record a batch's audit rows: status, error, start, end, seconds of the batch.

    ``audit`` has a row per loaded source (see ``load_audit``); ``errors`` adds a row with
    status ``failed`` and a message per source that could not be read. A re-run of the
    batch replaces its rows.
    """
    rows = audit.withColumns(
        {"status": F.lit("loaded"), "error": F.lit(None).cast("string")}
    )
    for source, message in (errors or {}).items():
        failed = audit.sparkSession.range(1).select(
            F.lit(source).alias("source"),
            F.lit(0).cast("bigint").alias("rows"),
            F.lit(0).cast("bigint").alias("bad_rows"),
            F.lit("failed").alias("status"),
            F.lit(message).alias("error"),
        )
        rows = rows.unionByName(failed)
    timed = rows.withColumns(
        {
            "started_at": F.timestamp_millis(F.lit(int(started * 1000))),
            "ended_at": F.timestamp_millis(F.lit(int(ended * 1000))),
            "batch_seconds": F.lit(float(ended - started)),
        }
    )
    write_batch(timed, path, batch_id)


def write_report_csv(df: DataFrame, folder: str) -> None:
    """A report as CSV with a header, written by the executors."""
    df.write.mode("overwrite").option("header", True).csv(folder)
