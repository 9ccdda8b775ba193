"""Column functions on hand-made edge values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rollbook.catalog import KEY, SCHEMAS, conform_schema, measure_columns
from rollbook.functions import columns as fn
from rollbook.operators import contracts, keys, profile
from rollbook.plans.silver import typed_measures


def values(spark, rows, expression, dtype="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, c {dtype}")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_dates_are_day_first_and_invalid_is_null(spark):
    rows = ["31-12-2025", "1-3-2025", "2025-12-31", "32-01-2025", "31-02-2025", "", None, "x"]
    got = values(spark, rows, fn.parse_date("c"))
    assert got == [dt.date(2025, 12, 31), dt.date(2025, 3, 1)] + [None] * 6
    both = values(spark, rows[:3], fn.parse_date("c", ("d-M-yyyy", "yyyy-MM-dd")))
    assert both[2] == dt.date(2025, 12, 31)


def test_pincode_forms(spark):
    rows = ["560001", "560001.0", " 560001 ", "0403001", "56001", "ABC123", None, "560001.00"]
    got = values(spark, rows, fn.normalize_pincode("c"))
    assert got[:6] == ["560001", "560001", "560001", "0403001", "56001", "ABC123"]
    flags = values(spark, rows, fn.is_valid_pincode("c"))
    assert flags == [True, True, False, False, False, False, False, False]


def test_titles_follow_non_letters(spark):
    rows = ["  MIDDLE EAST ", "south-west delhi", "o'neil", "nation_7", "24 parganas", "", None]
    got = values(spark, rows, fn.title_name("c"))
    assert got == [r.strip().title() if r is not None else None for r in rows]


def test_whole_numbers(spark):
    rows = ["12", "12.0", "12.5", " 7 ", "-3", "x", "", None, "9007199254740993"]
    got = values(spark, rows, fn.to_whole("c"))
    assert got == [12, 12, None, 7, -3, None, None, None, 9007199254740993]


def test_codes_are_not_cut(spark):
    assert values(spark, [1, 39, 12345], fn.make_code("SCH", "c"), "int") == [
        "SCH0001",
        "SCH0039",
        "SCH12345",
    ]


def test_null_and_negative_measures(spark):
    df = spark.createDataFrame([(1, 2), (None, 2), (-1, 2), (None, -1)], "a int, b int")
    got = df.select(
        fn.any_negative("a", "b"), fn.all_non_negative("a", "b"), fn.row_total("a", "b")
    ).collect()
    assert [tuple(r) for r in got] == [
        (False, True, 3),
        (False, False, 2),
        (True, False, 1),
        (True, False, -1),
    ]


def test_guarded_ratio(spark):
    df = spark.createDataFrame([(1, 3), (1, 0), (None, 2), (2, None)], "a int, b int")
    got = [r[0] for r in df.select(fn.pct_of("a", "b")).collect()]
    assert got == [33.33, 0.0, 0.0, 0.0]


def test_blank_is_not_null(spark):
    df = spark.createDataFrame([("  ",), ("",), (None,), ("x",)], "c string")
    row = profile.missing_profile(df, ["c"]).first()
    assert (row.blank_count, row.missing_count, row.null_pct) == (2, 3, 25.0)


def test_invalid_month_bucket(spark):
    df = spark.createDataFrame([("1-1-2025", 2), ("bad", 3)], "date string, m int")
    dropped = profile.monthly_total(df, fn.row_total("m")).collect()
    kept = profile.monthly_total(df, fn.row_total("m"), keep_invalid_month=True).collect()
    assert [tuple(r) for r in dropped] == [("2025-01", 2)]
    assert sorted(tuple(r) for r in kept) == [("2025-01", 2), ("NaT", 3)]


def test_key_text_for_null_labels(spark):
    df = spark.createDataFrame(
        [("1-1-2025", None, "d", "560001"), ("bad", "s", "d", "560001")],
        "date string, state string, district string, pincode string",
    )
    assert keys.conformed_key(df).count() == 0
    compat = keys.conformed_key(df, compat=True).collect()
    assert [tuple(r) for r in compat] == [("2025-01-01", "nan", "d", "560001")]


def test_conform_schema_renames_and_types(spark):
    df = spark.createDataFrame(
        [("1-1-2025", "s", "d", "560001", "4", "x")],
        "date string, state string, district string, pincode string, "
        "demo_age_5_17 string, demo_age_7 string",
    )
    row = conform_schema(df, SCHEMAS["demographic"]).first()
    assert (row.demo_age_5_17, row.demo_age_17) == (4, None)
    with pytest.raises(ValueError, match="bio_age_17"):
        conform_schema(df, SCHEMAS["biometric"])


def test_measures_are_found_from_the_schema(spark):
    df = spark.createDataFrame([], "date string, state string, a int, b double, pincode bigint")
    assert measure_columns(df, KEY) == ["a", "b"]


def test_text_measures_are_judged_by_the_contract(spark):
    from rollbook.catalog import SPECS

    df = spark.createDataFrame(
        [("1-1-2025", "s", "d", "560001", a, "1", "1") for a in ("5", "5.0", "-1", "x", None)],
        "date string, state string, district string, pincode string, "
        "age_0_5 string, age_5_17 string, age_18_greater string",
    )
    spec = SPECS["enrolment"]
    checks = contracts.contract_check(typed_measures(df, spec), contracts.contract_rules(spec))
    assert {r[0]: r[1] for r in checks.collect()}["non_negative_age"] == 3


def test_balance_rules(spark):
    df = spark.createDataFrame(
        [(10, 8, 5, 2, 1), (10, 8, 9, 0, 0)],
        "voter_total int, aadhaar_available int, aadhaar_voter_linked int, "
        "linkage_pending int, linkage_rejected int",
    )
    got = contracts.balance_check(df, "identity_voter_link").collect()
    assert {r[0]: r[1] for r in got} == {
        "linked_within_available": 1,
        "states_sum_to_available": 1,
    }


def test_profiles_of_an_empty_table(spark):
    df = spark.createDataFrame([], "a string, b int")
    assert [tuple(r) for r in profile.null_profile(df, ["a", "b"]).collect()] == [
        ("a", 0, 0.0),
        ("b", 0, 0.0),
    ]
    assert profile.column_profile(df, ["a"], exact=False).first().unique_count == 0


def test_describe_columns(spark):
    df = spark.range(1001).select(F.col("id").alias("a"), (F.col("id") * 2.5).alias("b"))
    rows = {r["column"]: r for r in profile.describe_numeric(df, ["a", "b"]).collect()}
    assert (rows["a"]["q25"], rows["a"]["q50"], rows["a"]["max"]) == (250.0, 500.0, 1000.0)
    assert (rows["b"]["q75"], rows["b"]["count"]) == (1875.0, 1001)


def test_hash_keys_do_not_collide(spark):
    rows = [("a|b", "c"), ("a", "b|c"), (None, "c"), ("c", None), ("", "c"), ("-", "c"), ("1:a", "c")]
    df = spark.createDataFrame(rows, "x string, y string")
    from rollbook.functions.columns import hash_key

    assert df.select(hash_key("x", "y")).distinct().count() == len(rows)
