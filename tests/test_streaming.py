"""Streams against the same logic in batch, over several files with one file per batch."""

import datetime as dt
import glob
import os
import shutil
import time

import pytest
from pyspark.sql import functions as F

from rollbook.catalog import KEY, TableSpec
from rollbook.operators import dedup
from rollbook.plans.silver import silver_split, silver_table
from rollbook.sources import readers
from rollbook.streaming import ledger, streams

HEADER = "date,state,district,pincode,age_0_5,age_5_17,age_18_greater"
SPEC = TableSpec(
    "enrolment",
    ("age_0_5", "age_5_17", "age_18_greater"),
    order=readers.FILE_ORDER,
    non_negative_rule="non_negative_age",
)


def rows_of(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


@pytest.fixture
def feed(tmp_path):
    """Three files arriving in order; keys repeat within and across files."""
    folder = tmp_path / "feed"
    folder.mkdir()
    for f in range(3):
        lines = [HEADER]
        for i in range(40):
            day = f"{1 + i % 28}-{1 + i % 3}-2025"
            pin = "ABC" if i % 11 == 0 else str(560000 + i % 25)
            lines.append(f"{day},Asia,North,{pin},{f},{i},{-1 if i % 13 == 0 else 1}")
        path = folder / f"part_{f}.csv"
        path.write_text("\n".join(lines) + "\n")
        os.utime(path, (1_700_000_000 + f, 1_700_000_000 + f))
    return str(folder)


def run_bronze(spark, feed, out, checkpoint):
    rows = readers.stream_csv(spark, feed, "enrolment", max_files=1)
    streams.bronze_stream(rows, out, checkpoint, "feed").awaitTermination()


def run_silver(spark, feed, out, checkpoint, max_files=1):
    rows = readers.stream_csv(spark, feed, "enrolment", max_files=max_files)
    streams.silver_stream(rows, SPEC, out, checkpoint, "feed").awaitTermination()


def test_bronze_stream_equals_batch_and_is_not_repeated(spark, feed, tmp_path):
    out, checkpoint = str(tmp_path / "bronze"), str(tmp_path / "cp")
    for _ in range(2):
        run_bronze(spark, feed, out, checkpoint)
    stored = spark.read.parquet(out)
    plain = readers.read_bronze_csv(spark, feed, "enrolment")
    columns = [*SPEC.data_columns, "src_file"]
    assert rows_of(stored, *columns) == rows_of(plain, *columns)
    assert stored.filter("source = 'feed' and ingest_ts is not null").count() == 120


def test_silver_stream_equals_batch_and_replays(spark, feed, tmp_path):
    plain = readers.read_bronze_csv(spark, feed, "enrolment")
    want = rows_of(silver_table(plain, SPEC), *SPEC.data_columns)
    _, rejected = silver_split(plain, SPEC)
    columns = [*SPEC.data_columns]

    def tables(out):
        return (
            rows_of(spark.read.parquet(f"{out}/valid"), *columns),
            rows_of(spark.read.parquet(f"{out}/quarantine"), *columns),
        )

    out = str(tmp_path / "silver")
    run_silver(spark, feed, out, str(tmp_path / "cp1"))
    first = tables(out)
    assert first[0] == want
    assert first[1] == rows_of(rejected, *columns)
    assert dedup.count_duplicates(spark.read.parquet(f"{out}/valid"), KEY).first()[0] == 0

    run_silver(spark, feed, out, str(tmp_path / "cp1"))  # nothing new
    assert tables(out) == first
    run_silver(spark, feed, out, str(tmp_path / "cp2"))  # replay over the same tables
    assert tables(out) == first
    for files in (2, 1000):  # replay with another split into batches
        run_silver(spark, feed, out, str(tmp_path / f"cp-{files}"), files)
        assert tables(out) == first
    assert spark.read.parquet(f"{out}/bronze").count() == 120
    fresh = str(tmp_path / "silver2")
    run_silver(spark, feed, fresh, str(tmp_path / "cp3"))  # backfill elsewhere
    assert tables(fresh) == first


def test_replay_after_a_kill_and_without_the_old_files(spark, feed, tmp_path):
    out = str(tmp_path / "silver")
    run_silver(spark, feed, out, str(tmp_path / "cp1"), 2)
    want = {
        t: rows_of(spark.read.parquet(f"{out}/{t}"), *SPEC.data_columns)
        for t in ("valid", "quarantine", "bronze")
    }
    # killed before the last batch was stored as bronze: its silver rows are there
    for table in ("bronze", "ledger"):  # which is written last
        (last,) = glob.glob(f"{out}/{table}/run=*/batch_id=1")
        shutil.rmtree(last)
    run_silver(spark, feed, out, str(tmp_path / "cp2"), 1000)
    # the first files are retired; a new checkpoint sees the last one only
    for f in ("part_0.csv", "part_1.csv"):
        os.remove(os.path.join(feed, f))
    run_silver(spark, feed, out, str(tmp_path / "cp3"))
    for t, rows in want.items():
        assert rows_of(spark.read.parquet(f"{out}/{t}"), *SPEC.data_columns) == rows, t


def batch_result(spark, folders, spec=SPEC):
    """(valid keys and measures, all raw rows) of all files, in batch."""
    raw = readers.read_bronze_csv(spark, folders, "enrolment")
    return (
        rows_of(silver_table(raw, spec), *spec.data_columns),
        rows_of(raw, *spec.data_columns),
    )


def stream_result(spark, out):
    return tuple(rows_of(spark.read.parquet(f"{out}/{t}"), *SPEC.data_columns) for t in ("valid", "bronze"))


def csv_file(path, rows, when=1_700_000_000, header=HEADER):
    path.parent.mkdir(exist_ok=True)
    path.write_text("\n".join([header, *rows]) + "\n")
    os.utime(path, (when, when))


def day(n, pin, value="1"):
    return f"{n}-1-2025,Asia,North,{560000 + pin},{value},2,3"


def test_equal_names_in_two_folders(spark, tmp_path):
    for k, name in enumerate(("a", "b")):
        csv_file(tmp_path / name / "data.csv", [day(1 + i, 10 * k + i) for i in range(5)])
    out = str(tmp_path / "out")
    for name in ("a", "b"):
        run_silver(spark, str(tmp_path / name), out, str(tmp_path / f"cp-{name}"))
    want = batch_result(spark, [str(tmp_path / "a"), str(tmp_path / "b")])
    assert stream_result(spark, out) == want and len(want[0]) == 10
    bronze = str(tmp_path / "bronze")
    for name in ("a", "b", "a"):
        run_bronze(spark, str(tmp_path / name), bronze, str(tmp_path / f"cpb-{name}"))
    assert rows_of(spark.read.parquet(bronze), *SPEC.data_columns) == want[1]


def test_a_checkpoint_wiped_and_used_again(spark, feed, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    run_silver(spark, feed, out, checkpoint, 1)
    want = batch_result(spark, feed)
    assert stream_result(spark, out) == want
    for files in (2, 1000, 1):  # the same path, another split into batches
        shutil.rmtree(checkpoint)
        run_silver(spark, feed, out, checkpoint, files)
        assert stream_result(spark, out) == want
    for f in ("part_0.csv", "part_1.csv"):  # the old files are gone: their rows stay
        os.remove(os.path.join(feed, f))
    shutil.rmtree(checkpoint)
    run_silver(spark, feed, out, checkpoint)
    assert stream_result(spark, out) == want


def test_a_file_written_anew_is_a_new_arrival(spark, tmp_path):
    path, out = tmp_path / "in" / "data.csv", str(tmp_path / "out")
    csv_file(path, [day(1, 1), day(2, 2)])
    run_silver(spark, str(path.parent), out, str(tmp_path / "cp1"))
    csv_file(path, [day(1, 1, "7"), day(3, 3)], when=1_700_000_100)
    run_silver(spark, str(path.parent), out, str(tmp_path / "cp2"))
    run_silver(spark, str(path.parent), out, str(tmp_path / "cp3"))
    valid, bronze = stream_result(spark, out)
    # bronze has both versions, silver the first row of each key
    assert len(bronze) == 4 and [r[4] for r in valid] == [1, 1, 1]
    assert {r[3] for r in valid} == {"560001", "560002", "560003"}


def test_files_are_read_by_their_own_headers(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    csv_file(folder / "a.csv", [day(1, 1)])
    csv_file(folder / "b.csv", ["9,Goa,2-1-2025,South,403001,8,7"], 1_700_000_001, "age_5_17,state,date,district,pincode,age_0_5,age_18_greater")
    run_silver(spark, str(folder), out, str(tmp_path / "cp"), 1000)
    assert stream_result(spark, out) == batch_result(spark, str(folder))
    goa = spark.read.parquet(f"{out}/valid").filter("state = 'Goa'").first()
    assert (str(goa.date), goa.age_0_5, goa.age_5_17, goa.age_18_greater) == ("2025-01-02", 8, 9, 7)


def test_a_batch_that_was_killed_is_done_again(spark, feed, tmp_path):
    out, want = str(tmp_path / "out"), batch_result(spark, feed)
    run_silver(spark, feed, out, str(tmp_path / "cp1"), 1)
    # killed after valid and quarantine of the last batch, before bronze and ledger
    for table in ("bronze", "ledger"):
        (last,) = glob.glob(f"{out}/{table}/run=*/batch_id=2")
        shutil.rmtree(last)
    shutil.rmtree(str(tmp_path / "cp1"))
    run_silver(spark, feed, out, str(tmp_path / "cp1"), 1000)
    assert stream_result(spark, out) == want


def test_messages_are_known_by_their_offsets(spark):
    batch = spark.createDataFrame([("t", p, o) for p in (0, 1) for o in range(10)], "topic string, partition int, offset bigint")
    book = spark.createDataFrame(
        [("t", 0, 0, 2, "a", 0), ("t", 0, 3, 5, "a", 1), ("t", 1, 4, 4, "a", 0), ("u", 1, 0, 9, "a", 0), ("t", None, 0, 9, "a", 0), ("t", 0, 9, 9, "b", 3)],
        "arrival string, part int, low bigint, high bigint, run string, batch_id int",
    )
    ranges = {tuple(r) for r in ledger.offset_ranges(book).collect()}
    assert ranges == {("t", 0, 0, 5), ("t", 0, 9, 9), ("t", 1, 4, 4), ("u", 1, 0, 9)}
    left = ledger.unseen(batch, ledger.of_other_batches(book, "b", 2))
    assert rows_of(left, "partition", "offset") == sorted([(0, o) for o in (6, 7, 8, 9)] + [(1, o) for o in range(10) if o != 4], key=repr)
    found = {tuple(r) for r in ledger.entries(batch).collect()}
    assert found == {("t", 0, 0, 9), ("t", 1, 0, 9)}


@pytest.fixture
def events(spark, sf001, tmp_path):
    """The events table as three files in event order."""
    folder = str(tmp_path / "events")
    source = spark.read.parquet(f"{sf001}/events.parquet")
    source = source.withColumn("ts", F.col("ts").cast("timestamp"))
    for i, (low, high) in enumerate([(0, 3333), (3333, 6666), (6666, 10**9)]):
        part = source.filter((F.col("event_id") >= low) & (F.col("event_id") < high))
        part.coalesce(1).sortWithinPartitions("ts").write.mode("append").parquet(
            f"{folder}/b={i}"
        )
    return folder, source


def stream_of(spark, folder, schema):
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
    return reader.option("recursiveFileLookup", True).parquet(folder)


def test_window_totals_equal_batch(spark, events, tmp_path):
    folder, source = events
    rows = stream_of(spark, folder, source.schema)
    totals = streams.window_totals(rows, "ts", ["event_type"], ["value"])
    out, checkpoint = str(tmp_path / "totals"), str(tmp_path / "cp")
    for _ in range(2):
        streams.append_parquet(totals, out, checkpoint).awaitTermination()
    got = spark.read.parquet(out)
    last = source.agg(F.max("ts")).first()[0]
    closed = (last - dt.timedelta(days=1)).replace(hour=0, minute=0, second=0, microsecond=0)
    want = (
        source.groupBy(F.date_trunc("day", "ts").alias("window_start"), "event_type")
        .agg(F.count(F.lit(1)).alias("rows"), F.sum("value").alias("value"))
        .filter(F.col("window_start") < F.lit(closed))
    )
    columns = ["window_start", "event_type", "rows", F.round("value", 4)]
    assert rows_of(got, *columns) == rows_of(want, *columns)


def test_stream_dedup_across_batches(spark, events, tmp_path):
    folder, source = events
    again = source.filter("event_id < 50")
    again.coalesce(1).write.mode("append").parquet(f"{folder}/b=0")
    rows = stream_of(spark, folder, source.schema)
    unique = streams.dedup_stream(rows, ["event_id"], "ts", "40 days")
    out = str(tmp_path / "unique")
    streams.append_parquet(unique, out, str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == got.select("event_id").distinct().count() == source.count()


def test_late_rows_are_dropped_two_batches_on(spark, tmp_path):
    folder = str(tmp_path / "late")
    days = ["2024-01-01", "2024-03-01", "2024-03-02", "2024-01-01", "2024-06-01"]
    for i, day in enumerate(days):
        df = spark.createDataFrame([(day, i)], "day string, v int")
        df = df.select(F.col("day").cast("timestamp").alias("ts"), "v")
        df.coalesce(1).write.parquet(f"{folder}/b={i}")
        time.sleep(0.05)
    rows = stream_of(spark, folder, "ts timestamp, v int")
    totals = streams.window_totals(rows, "ts", [], ["v"])
    out = str(tmp_path / "out")
    streams.append_parquet(totals, out, str(tmp_path / "cp")).awaitTermination()
    got = {str(r["window_start"])[:10]: r["v"] for r in spark.read.parquet(out).collect()}
    assert got["2024-01-01"] == 0  # the late row of the fourth file is not added
    assert got["2024-03-01"] == 1
