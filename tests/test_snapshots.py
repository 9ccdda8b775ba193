"""Published versions: a broken refresh, one that reads its own table, and marts of streams."""

import os

import pytest
from pyspark.sql import functions as F

from rollbook.operators import changes
from rollbook.plans import batch
from rollbook.sources import snapshots
from rollbook.streaming import streams
from test_streaming import SPEC, csv_file, feed, rows_of, run_silver  # noqa: F401


def broken(df, bad):
    """``df`` whose rows from ``bad`` on fail when they are computed."""
    return df.withColumn("n", F.when(F.col("n") >= bad, F.raise_error(F.lit("broken")).cast("bigint")).otherwise(F.col("n")))


def test_readers_see_the_old_version_until_all_is_written(spark, tmp_path):
    folder = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        snapshots.read(spark, folder, "a")
    one = spark.range(5).withColumnRenamed("id", "n")
    assert snapshots.publish(spark, folder, {"a": (one, ()), "b": (one, ())}) == 1
    two = spark.range(9).withColumnRenamed("id", "n")
    with pytest.raises(Exception, match="broken"):  # the first table is written, the second fails
        snapshots.publish(spark, folder, {"a": (two, ()), "b": (broken(two, 7), ())})
    assert [snapshots.read(spark, folder, t).count() for t in "ab"] == [5, 5]
    assert snapshots.publish(spark, folder, {"a": (two, ()), "b": (two, ())}) == 2
    assert [snapshots.read(spark, folder, t).count() for t in "ab"] == [9, 9]
    assert snapshots.read(spark, folder, "a", 1).count() == 5


def test_a_refresh_may_read_its_own_table(spark, tmp_path):
    folder = str(tmp_path / "t")
    snapshots.publish(spark, folder, {"a": (spark.range(4).select("id", (F.col("id") % 2).alias("p")), ["p"])})
    for _ in range(3):
        old = snapshots.read(spark, folder, "a")
        snapshots.publish(spark, folder, {"a": (old.unionByName(old).select("id", "p"), ["p"])})
    assert snapshots.read(spark, folder, "a").count() == 32
    assert snapshots.prune(spark, folder, 2) == [1, 2] and snapshots.versions(spark, folder) == [3, 4]
    assert snapshots.read(spark, folder, "a").count() == 32
    assert not os.path.exists(f"{folder}/version-1")
    assert snapshots.prune(spark, folder, 0) == [3] and snapshots.read(spark, folder, "a").count() == 32


def mart_rows(spark, paths):
    return {name: rows_of(spark.read.parquet(path)) for name, path in paths.items()}


def test_streamed_marts_equal_the_batch(spark, feed, tmp_path):  # noqa: F811
    lake = str(tmp_path / "lake")
    batch.run_bronze(spark, [feed], "enrolment", 1, lake)
    batch.run_silver(spark, "enrolment", lake, publish=True)
    want = mart_rows(spark, batch.run_gold(spark, "enrolment", lake, publish=True))
    for files in (1, 2):
        out, gold_out = str(tmp_path / f"s{files}"), str(tmp_path / f"g{files}")
        run_silver(spark, feed, out, str(tmp_path / f"cp{files}"), files)
        for version in (1, 2):
            assert batch.run_stream_gold(spark, SPEC, out, gold_out) == version
        names = [n for n in want if n not in ("dim_date", "dim_location", "fact")]
        got = mart_rows(spark, {n: snapshots.path_of(spark, gold_out, n) for n in names})
        assert got == {n: want[n] for n in names}
    # a late file adds to months that are there
    csv_file(tmp_path / "feed" / "late.csv", [f"{d}-1-2025,Asia,North,{700000 + d},5,5,5" for d in range(1, 9)], 1_700_000_500)
    run_silver(spark, feed, out, str(tmp_path / "cp2"), 2)
    batch.run_stream_gold(spark, SPEC, out, gold_out)
    before, after = (
        snapshots.read(spark, gold_out, "kpi_rollup", v).filter("month = '2025-01' and state is null").first()
        for v in (2, 3)
    )
    assert (after.age_0_5, after.age_5_17) == (before.age_0_5 + 40, before.age_5_17 + 40)


def test_change_stream_equals_the_batch(spark, sf001, tmp_path):
    events = spark.read.parquet(f"{sf001}/events.parquet").filter("event_id < 3000")
    kind = F.when(F.col("event_id") % 10 == 0, "delete").otherwise("update")
    log = events.select("user_id", "event_type", "event_id", kind.alias("kind"), "value")
    log = log.withColumns({"topic": F.lit("t"), "partition": F.lit(0), "offset": F.col("event_id")})
    keys = ["user_id", "event_type"]
    want = rows_of(changes.live(changes.latest(log.select(*keys, "event_id", "kind", "value"), keys, "event_id"), "event_id"))
    source = str(tmp_path / "in")
    for k, (low, high) in enumerate([(2000, 3000), (0, 1000), (1000, 2000)]):  # out of order
        log.filter((F.col("event_id") >= low) & (F.col("event_id") < high)).coalesce(1).write.parquet(f"{source}/b={k}")
    out = str(tmp_path / "out")
    for run in ("cp1", "cp2"):  # the second run brings the same messages again
        rows = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(source)
        streams.change_stream(rows, out, str(tmp_path / run), keys, "event_id").awaitTermination()
        assert rows_of(streams.changed_rows(spark, out, keys, "event_id")) == want
    assert spark.read.parquet(f"{out}/changes").select("run").distinct().count() == 1  # nothing stored twice
