"""Feeds with ISO dates get the reports that the same feeds have with day-first dates."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from rollbook.catalog import SPECS
from rollbook.functions.columns import DAY_FIRST
from rollbook.operators import keys, profile, reports, stats
from rollbook.plans import batch


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def feed(spark, spec, iso):
    """Four months of two states, with a spike, in either form of date."""
    form = "yyyy-MM-dd" if iso else "d-M-yyyy"
    day = F.make_date(F.lit(2025), 1 + (F.col("id") % 4).cast("int"), 1 + (F.col("id") % 27).cast("int"))
    other = [c for c in spec.keys if c not in ("date", "state", "district", "pincode")]
    return spark.range(240).select(
        F.date_format(day, form).alias("date"),
        F.when(F.col("id") % 2 == 0, "Asia").otherwise("Goa").alias("state"),
        F.lit("North").alias("district"),
        (560000 + F.col("id") % 50).cast("string").alias("pincode"),
        *[F.concat(F.lit("S"), F.col("id") % 3).alias(c) for c in other],
        *[((F.col("id") % (9 + k)) * F.when(F.month(day) == 4, 50).otherwise(1)).cast("int").alias(m) for k, m in enumerate(spec.measures)],
        F.col("id").alias("ingest_seq"),
    )


@pytest.mark.parametrize("name", sorted(SPECS))
def test_reports_do_not_depend_on_the_form_of_dates(spark, name):
    base = replace(SPECS[name], order=("ingest_seq",))
    total = sum(F.col(m) for m in base.total_measures)
    found = []
    for iso in (True, False):
        formats = ("yyyy-MM-dd", "d-M-yyyy") if iso else DAY_FIRST
        spec, df = replace(base, date_formats=formats), feed(spark, base, iso)
        found.append(
            {
                "months": rows_of(stats.month_completeness(df, spec.date, spec.date_formats)),
                "trend": rows_of(stats.mom_growth(df, total, spec.date, formats=spec.date_formats)),
                "anomalies": rows_of(stats.state_month_anomaly(df, total, date=spec.date, formats=spec.date_formats)),
                "range": rows_of(profile.date_range(df, spec.date, spec.date_formats)),
                "keys": rows_of(keys.conformed_key(df, formats=spec.date_formats)),
                "coverage": rows_of(keys.coverage_summary(df, df.filter("ingest_seq < 100"), df.limit(0), formats=spec.date_formats)),
                "fresh": rows_of(stats.freshness(df, "2025-06-01", date=spec.date, formats=spec.date_formats)),
                "rules": rows_of(reports.rule_status(df, spec)),
            }
        )
    assert found[0] == found[1]
    assert len(found[0]["months"]) == 4 and len(found[0]["anomalies"]) == 4 and found[0]["keys"]


@pytest.mark.parametrize("name", ["population", "scheme_beneficiary"])
def test_profile_of_an_iso_feed_has_rows(spark, tmp_path, name):
    spec = replace(SPECS[name], order=("ingest_seq",))
    out = batch.run_profile(spark, feed(spark, spec, True), spec, str(tmp_path))
    for report in ("months", "trend", "anomalies", "drift"):
        assert out[report].count() > 0, report
