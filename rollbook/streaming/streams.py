"""Structured Streaming: the same bronze and silver logic over arriving data."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rollbook.catalog import TableSpec
from rollbook.functions.columns import row_total
from rollbook.operators import changes, gold
from rollbook.operators.dedup import dedup_keep_first
from rollbook.plans.silver import silver_split
from rollbook.sources import readers, writers
from rollbook.streaming import ledger


def _start(writer, available_now: bool) -> StreamingQuery:
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def append_parquet(
    rows: DataFrame, path: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Write a stream in append mode; the file sink commits each micro-batch once."""
    writer = (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return _start(writer, available_now)


def _rows(batch: DataFrame) -> DataFrame:
    """The rows of a micro-batch: arriving files are read, other rows are there already."""
    return readers.read_arrivals(batch) if set(readers.ARRIVAL) <= set(batch.columns) else batch


def _stamped(rows: DataFrame, source: str) -> DataFrame:
    return rows.withColumns({"source": F.lit(source), "ingest_ts": F.current_timestamp()})


def _by_ledger(
    checkpoint: str,
    ledger_path: str,
    tables: dict[str, Sequence[str]],
    write: Callable[[DataFrame, str, int], None],
) -> Callable[[DataFrame, int], None]:
    """A sink that gives ``write`` what no other batch has stored, with run and batch number,
    and records it when all tables are written."""
    started = False

    def store(batch: DataFrame, batch_id: int) -> None:
        nonlocal started
        spark = batch.sparkSession
        run = ledger.run_id(spark, checkpoint)
        book = ledger.stored(spark, ledger_path)
        if not started:
            ledger.clear_unfinished(spark, book, tables, run, batch_id)
            started = True
        new = ledger.unseen(batch, ledger.of_other_batches(book, run, batch_id))
        write(_rows(new), run, batch_id)
        ledger.record(ledger.entries(new), ledger_path, run, batch_id)

    return store


def bronze_stream(
    rows: DataFrame, path: str, checkpoint: str, source: str, available_now: bool = True
) -> StreamingQuery:
    """Append-only raw rows with source and ingest time, one partition per run and micro-batch.

    A retried batch replaces its own partition. What another run has stored is left out, by
    the ledger beside the table, so a stream that starts anew adds nothing twice and
    overwrites nothing; a file that was written anew under its old name is a new arrival.
    """

    def write(new: DataFrame, run: str, batch_id: int) -> None:
        writers.write_parts(_stamped(new, source), ledger.batch_path(path, run, batch_id))

    store = _by_ledger(checkpoint, f"{path}-ledger", {path: ()}, write)
    writer = rows.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return _start(writer, available_now)


def silver_stream(
    rows: DataFrame,
    spec: TableSpec,
    folder: str,
    checkpoint: str,
    source: str,
    aliases: dict[str, DataFrame] | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Split each micro-batch into ``valid`` and ``quarantine``, and store it as ``bronze``.

    What it adds to the totals of a month and place goes into ``monthly``, from which the marts
    are kept up to date (see ``run_stream_gold``). All four tables are laid out by run and batch; a batch replaces its own partitions only.
    Keys in ``valid`` are unique over all batches of all runs, whatever the split into
    batches. What arrives again is known by the ``ledger`` and left out; a batch that is not
    in it was killed on its way and is emptied when the next stream starts. One stream writes
    at a time.
    """
    valid_path, quarantine_path = f"{folder}/valid", f"{folder}/quarantine"
    bronze_path, monthly_path = f"{folder}/bronze", f"{folder}/monthly"

    def write(new: DataFrame, run: str, batch_id: int) -> None:
        spark = new.sparkSession
        valid, quarantine = silver_split(new, spec, aliases)
        first = dedup_keep_first(valid, spec.keys, spec.order).withColumn(
            "month", F.date_format(spec.date, "yyyy-MM")
        )
        earlier = ledger.stored(spark, valid_path)
        if earlier is not None:
            # a partition column limits the read to the months that the batch touches; years
            # have four digits, so there are at most 120,000 of them
            months = F.broadcast(first.select("month").distinct())
            seen = ledger.of_other_batches(earlier, run, batch_id)
            seen = seen.join(months, "month", "left_semi").select(*spec.keys)
            first = first.join(seen, list(spec.keys), "left_anti")
        stored = ledger.batch_path(valid_path, run, batch_id)
        writers.write_parts(first, stored, ["month"])
        kept = spark.read.schema(first.schema).parquet(stored)  # what is new, not computed again
        sums = gold.month_sums(kept, spec.measures, row_total(*spec.total_measures), spec.date)
        writers.write_parts(sums, ledger.batch_path(monthly_path, run, batch_id))
        writers.write_parts(quarantine, ledger.batch_path(quarantine_path, run, batch_id))
        writers.write_parts(_stamped(new, source), ledger.batch_path(bronze_path, run, batch_id))

    tables = {valid_path: ["month"], quarantine_path: (), bronze_path: (), monthly_path: ()}
    store = _by_ledger(checkpoint, f"{folder}/ledger", tables, write)
    writer = rows.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return _start(writer, available_now)


def dedup_stream(
    rows: DataFrame, keys: Sequence[str], event_ts: str, delay: str = "1 day"
) -> DataFrame:
    """Drop repeats of a key that arrive within ``delay``; state is bounded by the watermark."""
    return rows.withWatermark(event_ts, delay).dropDuplicatesWithinWatermark(list(keys))


def window_totals(
    rows: DataFrame,
    event_ts: str,
    by: Sequence[str],
    measures: Sequence[str],
    width: str = "1 day",
    delay: str = "1 day",
) -> DataFrame:
    """Totals per tumbling window and group; a window is final once the watermark passes it.

    Calendar months have no fixed width: use day windows and sum them by month.
    """
    return (
        rows.withWatermark(event_ts, delay)
        .groupBy(F.window(event_ts, width).alias("w"), *by)
        .agg(
            F.count(F.lit(1)).alias("rows"), *[F.sum(m).alias(m) for m in measures]
        )
        .select(F.col("w.start").alias("window_start"), *by, "rows", *measures)
    )


def change_stream(
    rows: DataFrame,
    folder: str,
    checkpoint: str,
    keys: Sequence[str],
    sequence: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Store the latest change of each key of every micro-batch (see ``changes.latest``).

    Batches are not merged into one another when they come: ``changed_rows`` takes the latest
    over all of them with one aggregate, so changes may come late, out of order and again.
    """
    path = f"{folder}/changes"

    def write(new: DataFrame, run: str, batch_id: int) -> None:
        state = changes.latest(new.drop(*set(ledger.MESSAGE) & set(new.columns)), keys, sequence)
        writers.write_parts(state, ledger.batch_path(path, run, batch_id))

    store = _by_ledger(checkpoint, f"{folder}/ledger", {path: ()}, write)
    writer = rows.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return _start(writer, available_now)


def changed_rows(spark: SparkSession, folder: str, keys: Sequence[str], sequence: str) -> DataFrame:
    """The live rows of a table whose changes a ``change_stream`` has stored."""
    stored = spark.read.parquet(f"{folder}/changes").drop("run", "batch_id")
    return changes.live(changes.merge(stored, keys=keys, sequence=sequence), sequence)
