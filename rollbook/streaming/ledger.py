"""The ledger of a stream's tables: which arrivals they hold, and which batches are whole.

A file is known by its full path, modification time and length, a message by its topic,
partition and offset. A run is known by the id that Spark keeps in its checkpoint: a
checkpoint that was wiped and is used again at its path starts another run. Every micro-batch
reads the ledger first, leaves out what another batch has recorded, and records its own
arrivals last, when all its tables are written. So what the ledger does not list was never
finished.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollbook.sources import readers, writers

ENTRY = ("arrival", "part", "low", "high")
MESSAGE = ("topic", "partition", "offset")


def run_id(spark: SparkSession, checkpoint: str) -> str:
    """Id of the stream that a checkpoint belongs to: the same after every restart."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table under ``path`` with its run and batch columns; None before the first batch."""
    try:
        table = spark.read.parquet(path)
    except AnalysisException:  # no such folder, or no batch in it with a schema yet
        return None
    return table if "run" in table.columns else None


def batch_path(path: str, run: str, batch_id: int) -> str:
    return f"{path}/run={run}/batch_id={batch_id}"


def entries(batch: DataFrame) -> DataFrame | None:
    """(arrival, part, low, high) of a micro-batch; None for rows without an identity.

    Of a file ``low`` is its modification time and ``high`` its length, of the messages of a
    partition they are the first and last offset: a batch takes all offsets between.
    """
    if set(readers.ARRIVAL) <= set(batch.columns):
        return batch.select(
            F.col("path").alias("arrival"),
            F.lit(None).cast("int").alias("part"),
            F.unix_micros("modificationTime").alias("low"),
            F.col("length").alias("high"),
        ).distinct()
    if set(MESSAGE) <= set(batch.columns):
        return batch.groupBy(F.col("topic").alias("arrival"), F.col("partition").cast("int").alias("part")).agg(
            F.min("offset").alias("low"), F.max("offset").alias("high")
        )
    return None


def of_other_batches(ledger: DataFrame | None, run: str, batch_id: int) -> DataFrame | None:
    """The ledger without what the batch itself, or a later one of its run, has recorded."""
    if ledger is None:
        return None
    own = (F.col("run") == run) & (F.col("batch_id") >= batch_id)
    return ledger.filter(~own)


def offset_ranges(ledger: DataFrame) -> DataFrame:
    """(arrival, part, low, high): recorded offsets, with ranges that meet or overlap made one."""
    by = Window.partitionBy("arrival", "part").orderBy("low", "high")
    reach = F.max("high").over(by.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.coalesce((F.col("low") > reach + 1).cast("int"), F.lit(1))
    island = F.sum("apart").over(by.rowsBetween(Window.unboundedPreceding, 0))
    return (
        ledger.filter(F.col("part").isNotNull())
        .withColumn("apart", apart)
        .withColumn("island", island)
        .groupBy("arrival", "part", "island")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"))
        .drop("island")
    )


def unseen(batch: DataFrame, ledger: DataFrame | None) -> DataFrame:
    """What of a micro-batch no entry of ``ledger`` covers."""
    if ledger is None:
        return batch
    if set(readers.ARRIVAL) <= set(batch.columns):
        files = ledger.filter(F.col("part").isNull())
        same = (
            (F.col("path") == F.col("arrival"))
            & (F.unix_micros("modificationTime") == F.col("low"))
            & (F.col("length") == F.col("high"))
        )
        return batch.join(files, same, "left_anti")
    if set(MESSAGE) <= set(batch.columns):
        ranges = offset_ranges(ledger)
        same = (
            (F.col("topic") == F.col("arrival"))
            & (F.col("partition") == F.col("part"))
            & F.col("offset").between(F.col("low"), F.col("high"))
        )
        return batch.join(ranges, same, "left_anti")
    return batch


def record(found: DataFrame | None, path: str, run: str, batch_id: int) -> None:
    """Close a micro-batch; a repeated one replaces its entries."""
    if found is not None:
        found.write.mode("overwrite").parquet(batch_path(path, run, batch_id))


def clear_unfinished(
    spark: SparkSession,
    ledger: DataFrame | None,
    tables: dict[str, Sequence[str]],
    run: str,
    batch_id: int,
) -> None:
    """Empty the batches that the ledger does not list, and those of ``run`` before which it
    starts again. ``tables`` has the partition columns below the batch for each table's path.

    One stream writes at a time, so they are left over from a run that was killed. The driver
    receives one row per batch.
    """
    done: set[tuple[str, int]] = set()
    if ledger is not None:
        done = {(r.run, r.batch_id) for r in ledger.select("run", "batch_id").distinct().collect()}
    for path, parts in tables.items():
        table = stored(spark, path)
        if table is None:
            continue
        rest = [c for c in table.columns if c not in ("run", "batch_id")]
        for found in table.select("run", "batch_id").distinct().collect():
            key = (found["run"], found["batch_id"])
            if key not in done and key != (run, batch_id):
                empty = table.select(*rest).limit(0)
                writers.write_parts(empty, batch_path(path, *key), parts)
