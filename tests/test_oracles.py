"""Every registered query against its own SQL, and the published fixture numbers."""

import __spark_entry__ as entry_file
import compare
import pytest

from rollbook.plans.driver_oracles import all_oracles
from rollbook.plans.driver_queries import all_queries

SMALL = "/root/testdata/sf0.001"
QUERIES = all_queries()
ORACLES = all_oracles()


@pytest.fixture(scope="module")
def con():
    return compare.connect(SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    assert compare.differences(QUERIES[name](spark, SMALL), con, ORACLES[name]) == []


def test_entry_registers_them_all():
    assert set(QUERIES) <= set(entry_file.queries())
    assert set(entry_file.oracle_sql()) <= set(entry_file.queries())


def test_entry(spark):
    assert entry_file.entry(spark).columns == ["check", "failed_rows"]


def pairs(df):
    return {r[0]: r[1] for r in df.collect()}


def test_published_numbers(spark, sf001):
    def run(name):
        return QUERIES[name](spark, sf001)

    assert pairs(run("contract_check_raw")) == {
        "valid_date": 149,
        "valid_6_digit_pincode": 181,
        "non_negative_age": 440,
    }
    impact = pairs(run("duplicate_impact"))
    assert impact["rows_before"] == 15284
    assert impact["grain_duplicates_before"] == 314
    assert impact["full_row_duplicates_before"] == 142
    assert impact["rows_after"] == 14970
    assert impact["grain_duplicates_after"] == 0
    assert pairs(run("coverage_summary")) == {
        "enroll_not_in_demo": 14404,
        "enroll_not_in_bio": 14656,
        "demo_not_in_enroll": 59191,
        "bio_not_in_enroll": 3990,
    }
    assert run("conformed_key").count() == 14672
    assert run("silver_valid").count() == 14229
    assert run("silver_quarantine").count() == 1055
    assert run("negative_rows").count() == 194
    assert run("blank_rows").count() == 149
    assert run("fd_district_state").count() == 27
    assert run("dedup_keep_first").agg({"age_18_greater": "sum"}).first()[0] == 367530
    anomaly = run("state_month_anomaly")
    assert anomaly.count() == 461
    assert anomaly.filter("anomaly_class != 'normal'").count() == 4
    sensitive = run("state_month_anomaly_sensitive")
    assert sensitive.filter("anomaly_class != 'normal'").count() == 41
    assert pairs(run("psi_drift")) == {
        "1996": 0.004705,
        "1997": 0.004363,
        "1998": 0.005212,
        "1999": 0.002511,
        "2000": 0.007992,
        "2001": 0.020206,
    }
