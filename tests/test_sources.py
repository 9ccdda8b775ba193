"""CSV feeds, tables, reports and the batch run, on small files."""

import csv
import glob
import json

import pytest
from pyspark.sql import functions as F

from rollbook.catalog import SPECS
from rollbook.operators import gold
from rollbook.plans import batch
from rollbook.plans.silver import silver_split
from rollbook.sources import readers, writers

HEADER = "date,state,district,pincode,age_0_5,age_5_17,age_18_greater"
SHARD_1 = [
    "31-12-2025,Asia,North,560001,1,2,3",
    "31-12-2025,Asia,North,560001,1,2,3",  # exact duplicate
    "31-12-2025,asia, north ,560001.0,9,9,9",  # same key once normalised
    "1-3-2025,Asia,North,0403001,1,2,3",  # seven digits
    "2025-12-31,Asia,North,560002,1,2,3",  # other date form
    "32-01-2025,Asia,North,560002,1,2,3",  # no such day
    ",Asia,North,560002,1,2,3",
]
SHARD_2 = [
    "1-3-2025,,North,560003,1,2,3",  # null state
    "1-3-2025,  ,North,560003,1,2,3",  # blank state
    "1-3-2025,Asia,South-west,560003,4.0,5,6",
    "1-3-2025,Asia,North,ABC123,1,2,3",
    "1-3-2025,Asia,North,560004,,2,3",
    "1-3-2025,Asia,North,560005,-1,2,3",
    "1-3-2025,Asia,North,560006,x,2,3",
    "1-3-2025,Asia,North",  # short row
]


@pytest.fixture
def feed(tmp_path):
    for i, lines in enumerate([SHARD_1, SHARD_2]):
        (tmp_path / f"enrolment_{i}.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    return tmp_path


def test_bronze_keeps_every_line(spark, feed):
    df = readers.read_bronze_csv(spark, str(feed / "*.csv"), "enrolment").cache()
    assert df.count() == len(SHARD_1) + len(SHARD_2)
    assert [r["date"] for r in df.filter("_corrupt is not null").collect()] == ["1-3-2025"]
    first = df.filter("src_file = 'enrolment_0.csv'").orderBy(*readers.FILE_ORDER).collect()
    assert [r["pincode"] for r in first][:4] == ["560001", "560001", "560001.0", "0403001"]
    df.unpersist()


def test_profile_reader_types_measures(spark, feed):
    df = readers.read_profile_csv(spark, str(feed / "*.csv"), SPECS["enrolment"])
    types = dict(df.dtypes)
    assert types["pincode"] == "string" and types["age_0_5"] == "bigint"
    south = df.filter("district = 'South-west'").first()
    assert south["age_0_5"] == 4


def test_first_existing_source(spark, feed):
    found = readers.find_source(spark, ["/no/such.csv", str(feed / "enrolment_0.csv")])
    assert found.endswith("enrolment_0.csv")
    with pytest.raises(FileNotFoundError, match="no/such"):
        readers.find_source(spark, ["/no/such.csv"])
    with pytest.raises(FileNotFoundError):
        readers.list_sources(spark, [str(feed / "enrolment_0.csv"), "/no/such.csv"])


def test_refresh_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(1, "a"), (2, "b")]
    writers.refresh_table(spark.createDataFrame(rows, "v int, p string"), path, ["p"])
    update = spark.createDataFrame([(9, "b")], "v int, p string")
    writers.refresh_table(update, path, ["p"], incremental=True)
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, "a"), (9, "b")]
    writers.refresh_table(update, path, ["p"])  # a full refresh leaves no older partition
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [(9, "b")]
    full = str(tmp_path / "full")
    for n in (3, 2):
        writers.refresh_table(spark.range(n), full)
    assert spark.read.parquet(full).count() == 2


def test_partitioned_write_makes_few_files(spark, tmp_path):
    path = str(tmp_path / "few")
    df = spark.range(0, 1000, 1, 8).select("id", (F.col("id") % 5).alias("p"))
    writers.refresh_table(df.repartition(8, "id"), path, ["p"])
    assert len(glob.glob(path + "/p=*/part-*.parquet")) == 5


def test_create_and_append(spark):
    writers.create_table_as(spark.createDataFrame([(1, "a")], "n int, c string"), "merged_t")
    writers.append_table(spark.createDataFrame([("b", 2)], "c string, n int"), "merged_t")
    assert sorted(map(tuple, readers.scan(spark, "merged_t").collect())) == [(1, "a"), (2, "b")]
    assert writers.verify_row_count(spark.table("merged_t")).first()[0] == 2
    writers.create_table_as(spark.createDataFrame([(5, "z")], "n int, c string"), "merged_t")
    assert spark.table("merged_t").count() == 1
    spark.sql("drop table merged_t")


def test_batches_append_and_rerun_replaces(spark, tmp_path):
    path = str(tmp_path / "bronze")
    writers.write_batch(spark.range(3), path, 1)
    writers.write_batch(spark.range(5), path, 2)
    writers.write_batch(spark.range(4), path, 2)
    counts = spark.read.parquet(path).groupBy("batch_id").count().collect()
    assert {r[0]: r[1] for r in counts} == {1: 3, 2: 4}


def test_report_csv_has_a_header(spark, tmp_path):
    folder = str(tmp_path / "report")
    report = spark.createDataFrame([("rows", 3)], "metric string, value bigint")
    writers.write_report_csv(report, folder)
    files = [list(csv.reader(open(f))) for f in glob.glob(folder + "/part-*.csv")]
    assert all(lines[0] == ["metric", "value"] for lines in files)
    assert [row for lines in files for row in lines[1:]] == [["rows", "3"]]


def test_messages_are_parsed_with_topic_and_offset(spark):
    body = {"date": "1-1-2025", "state": "s", "district": "d", "pincode": "560001", "age_0_5": "4"}
    messages = spark.createDataFrame(
        [(json.dumps(body).encode(), "enrol", 0, 17)],
        "value binary, topic string, partition int, offset bigint",
    ).withColumn("timestamp", F.lit("2025-01-02 03:04:05").cast("timestamp"))
    row = readers.parse_messages(messages, "enrolment").first()
    assert (row.age_0_5, row.age_5_17, row.topic, row.offset) == ("4", None, "enrol", 17)


def test_batch_run_end_to_end(spark, feed, tmp_path):
    out = str(tmp_path / "lake")
    shards = [str(feed / "enrolment_0.csv"), str(feed / "enrolment_1.csv")]
    for _ in range(2):  # a second run of the batch changes nothing
        batch.run_bronze(spark, shards, "enrolment", 1, out)
    bronze = spark.read.parquet(f"{out}/bronze/enrolment")
    assert bronze.count() == 15
    audit = spark.read.parquet(f"{out}/audit/enrolment")
    assert {(r["source"], r["rows"], r["bad_rows"]) for r in audit.collect()} == {
        ("enrolment_0.csv", 7, 0),
        ("enrolment_1.csv", 8, 1),
    }

    valid_path, quarantine_path = batch.run_silver(spark, "enrolment", out)
    valid = spark.read.parquet(valid_path)
    got = {(r["state"], r["district"], r["pincode"], r["age_0_5"]) for r in valid.collect()}
    assert got == {("Asia", "North", "560001", 1), ("Asia", "South-West", "560003", 4)}
    quarantine = spark.read.parquet(quarantine_path)
    assert quarantine.count() == 15 - 4  # four valid rows, of which two repeat a key
    reasons = {tuple(r["reasons"]) for r in quarantine.collect()}
    assert ("state_present",) in reasons and ("valid_6_digit_pincode",) in reasons

    tables = batch.run_gold(spark, "enrolment", out)
    fact = spark.read.parquet(tables["fact"])
    dim = spark.read.parquet(tables["dim_location"])
    assert fact.join(dim, "location_key").count() == 2
    assert spark.read.parquet(tables["dim_date"]).count() == 306

    spec = batch.bronze_spec("enrolment")
    reports = batch.run_profile(spark, bronze, spec, out)
    for name in reports:
        assert glob.glob(f"{out}/reports/enrolment/{name}/part-*.csv"), name

    batch.run_coverage(bronze, bronze, bronze.limit(0), f"{out}/coverage")
    summary = spark.read.option("header", True).csv(f"{out}/coverage/cross_table_coverage_summary")
    values = {r["metric"]: int(r["value"]) for r in summary.collect()}
    assert values["enroll_not_in_demo"] == 0 and values["enroll_not_in_bio"] > 0


def test_columns_are_matched_by_header_name(spark, tmp_path):
    header = ["state", "pincode", "date", "district", "demo_age_7", "demo_age_5_17"]
    (tmp_path / "a.csv").write_text(",".join(header) + "\nAsia,560001,1-1-2025,North,7,5\n")
    (tmp_path / "b.csv").write_text(
        "date,state,district,pincode,demo_age_5_17,demo_age_17\n2-1-2025,Asia,South,560002,1,2\n"
    )
    df = readers.read_bronze_csv(spark, str(tmp_path / "*.csv"), "demographic")
    rows = {r.date: (r.state, r.district, r.pincode, r.demo_age_5_17, r.demo_age_17) for r in df.collect()}
    assert rows["1-1-2025"] == ("Asia", "North", "560001", "5", "7")
    assert rows["2-1-2025"] == ("Asia", "South", "560002", "1", "2")
    (tmp_path / "c.csv").write_text("date,state,district,pincode,demo_age_5_17,other\n")
    with pytest.raises(ValueError, match="other"):
        readers.read_bronze_csv(spark, str(tmp_path / "*.csv"), "demographic")


def test_a_failed_shard_is_in_the_audit(spark, feed, tmp_path):
    out = str(tmp_path / "lake")
    shards = [str(feed / "enrolment_0.csv"), "/no/such.csv", str(feed / "enrolment_1.csv")]
    with pytest.raises(FileNotFoundError, match="no/such"):
        batch.run_bronze(spark, shards, "enrolment", 1, out)
    audit = {r["source"]: r for r in spark.read.parquet(f"{out}/audit/enrolment").collect()}
    assert audit["/no/such.csv"]["status"] == "failed" and "no/such" in audit["/no/such.csv"]["error"]
    assert (audit["enrolment_0.csv"]["rows"], audit["enrolment_1.csv"]["rows"]) == (7, 8)
    assert spark.read.parquet(f"{out}/bronze/enrolment").count() == 15


FEEDS = {
    "population": (
        "date,state,district,pincode,population_total,male,female,age_0_5,age_6_17,age_18_plus",
        ["2025-01-01,Asia,North,560001,10,4,6,1,2,7", "2025-02-30,Asia,North,560001,10,4,6,1,2,7"],
        10,
    ),
    "voter_registry": (
        "date,state,district,pincode,voter_total,male_voters,female_voters,other_voters,"
        "new_registrations,deletions,net_change,turnout_pct_est,data_source,ingest_ts",
        ["2025-01-01,Asia,North,560001,10,4,5,1,3,2,1,61.5,roll,2025-01-02 00:00:00", "x,Asia,North,560001,1,1,0,0,0,0,0,1,r,"],
        10,
    ),
    "identity_voter_link": (
        "date,state,district,pincode,voter_total,aadhaar_available,aadhaar_voter_linked,linkage_pending,"
        "linkage_rejected,linkage_pct,kyc_pending,duplicate_suspected,data_source,ingest_ts",
        ["2025-01-01,Asia,North,560001,10,8,6,1,1,75.00,0,0,l,2025-01-02 00:00:00", "2025-01-01,Asia,North,5600,1,1,1,0,0,1,0,0,l,"],
        10,
    ),
    "scheme_beneficiary": (
        "date,start_date,end_date,state,district,pincode,scheme_id,applications_received,beneficiaries_approved,"
        "beneficiaries_rejected,beneficiaries_disbursed,disbursed_amount,data_source,ingest_ts",
        [
            "2025-01-01,2024-01-01,2025-12-31,Asia,North,560001,SCH0001,10,8,2,6,1234.50,s,2025-01-02 00:00:00",
            "2025-01-01,2024-01-01,2025-12-31,Asia,North,560001,SCH0002,4,2,2,1,0.25,s,2025-01-02 00:00:00",
            "2025-01-01,2024-01-01,2025-12-31,Asia,North,560001,SCH0002,4.5,2,2,1,0.25,s,",
        ],
        10,
    ),
}


@pytest.mark.parametrize("name", sorted(FEEDS))
def test_each_feed_from_csv_to_gold(spark, tmp_path, name):
    header, lines, total = FEEDS[name]
    (tmp_path / "feed.csv").write_text("\n".join([header, *lines]) + "\n")
    out = str(tmp_path / "lake")
    batch.run_bronze(spark, [str(tmp_path / "feed.csv")], name, 1, out)
    valid_path, quarantine_path = batch.run_silver(spark, name, out)
    valid = spark.read.parquet(valid_path)
    assert valid.count() == len(lines) - 1 and spark.read.parquet(quarantine_path).count() == 1
    assert set(header.split(",")) <= set(valid.columns)  # no declared column is lost
    tables = batch.run_gold(spark, name, out)
    trend = spark.read.parquet(tables["trend"]).collect()
    assert [r["total"] for r in trend] == [total]
    fact = spark.read.parquet(tables["fact"])
    assert fact.count() == len(lines) - 1
    if name == "scheme_beneficiary":
        assert {r["scheme_id"]: float(r["disbursed_amount"]) for r in fact.collect()} == {"SCH0001": 1234.5, "SCH0002": 0.25}
        schemes = spark.createDataFrame([("SCH0001", "Health")], "scheme_id string, scheme_type string")
        kpi = {r["scheme_type"]: r for r in gold.scheme_funnel_kpi(fact, schemes).collect()}
        assert (kpi["Health"]["amount"], kpi["Health"]["approval_pct"]) == (1234.5, 80.0)
    if name == "voter_registry":
        row = valid.first()
        assert (row["net_change"], row["turnout_pct_est"]) == (1, 61.5)


def test_fractional_numbers_go_to_quarantine(spark):
    spec = SPECS["population"]
    row = ("2025-01-01", "Asia", "North", "560001", 4.5, 1.0, 1.0, 1.0, 1.0, 1.0)
    df = spark.createDataFrame([row], "date string, state string, district string, pincode string, population_total double, male double, female double, age_0_5 double, age_6_17 double, age_18_plus double")
    valid, quarantine = silver_split(df.withColumn("ingest_seq", F.lit(1)), spec)
    assert valid.count() == 0 and quarantine.count() == 1
