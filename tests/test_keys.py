"""Duplicates, hot keys, coverage and set properties."""

from collections import Counter

from pyspark.sql import functions as F

from rollbook.catalog import KEY, SPECS
from rollbook.operators import contracts, dedup, keys, skew
from rollbook.plans.driver_inputs import DriverInputs
from rollbook.plans.silver import silver_split, silver_table


def hot_frame(spark):
    """A third of the rows share one key, another key is null."""
    return spark.range(0, 30_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 1000 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("k"), (F.col("id") / 2).cast("bigint").cast("string")))
        .alias("k"),
        F.col("id").alias("seq"),
    )


def test_duplicate_groups_with_a_hot_key(spark):
    df = hot_frame(spark)
    rows = [tuple(r) for r in df.collect()]
    counts = Counter(k for k, _ in rows)
    want = sorted((r for r in rows if counts[r[0]] > 1), key=lambda r: r[1])
    got = dedup.duplicate_groups(df, ["k"])
    assert sorted((tuple(r) for r in got.collect()), key=lambda r: r[1]) == want


def test_hot_key_is_spread(spark):
    df = hot_frame(spark)
    counts = dedup.key_counts(df, ["k"])
    assert [r["k"] for r in skew.hot_keys(counts).collect()] == ["hot"]
    assert skew.hot_keys(counts, share=0.5).count() == 0


def test_dedup_limits_rows_before_the_shuffle(spark):
    first = dedup.dedup_keep_first(hot_frame(spark), ["k"], ["seq"])
    kept = {r["k"]: r["seq"] for r in first.collect()}
    assert kept["hot"] == 0 and kept[None] == 1
    assert dedup.count_duplicates(first, ["k"]).first()[0] == 0
    again = dedup.dedup_keep_first(first, ["k"], ["seq"])
    assert again.count() == first.count() == len(kept)
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_duplicate_counts(spark):
    df = spark.createDataFrame(
        [(1, "a"), (1, "a"), (1, "b"), (None, "c"), (None, "c")], "k int, v string"
    )
    row = dedup.duplicate_counts(df, ["k", "v"], ["k"]).first()
    assert tuple(row) == (5, 2, 2, 3)


def test_anti_and_semi_make_the_left(spark, sf001):
    t = DriverInputs(spark, sf001)
    a, b = keys.conformed_key(t.enrolment), keys.conformed_key(t.biometric)
    missing, matched = keys.missing_keys(a, b), keys.matched_keys(a, b)
    assert missing.unionByName(matched).exceptAll(a).count() == 0
    assert missing.count() + matched.count() == a.count()
    assert keys.key_except(a, b).count() == missing.count()
    assert keys.key_intersect(a, b).count() == matched.count()
    status = keys.merge_indicator(a, b).groupBy("merge_status").count().collect()
    assert {r[0]: r[1] for r in status} == {
        "left_only": missing.count(),
        "both": matched.count(),
    }


def test_conformed_wide_equals_full_outer_join(spark, sf001):
    t = DriverInputs(spark, sf001)
    spec = SPECS["biometric"]
    wide = keys.conformed_wide(
        {
            "enrolment": (t.enrolment, ["age_5_17"]),
            "biometric": (t.biometric, spec.measures),
        }
    )
    parts = []
    for df, measures in ((t.enrolment, ["age_5_17"]), (t.biometric, list(spec.measures))):
        keyed = keys.conformed_wide({"one": (df, measures)})
        parts.append(keyed)
    joined = parts[0].join(parts[1], list(keys.KEY_COLUMNS), "full_outer").select(*wide.columns)
    assert wide.exceptAll(joined).count() == 0 and joined.exceptAll(wide).count() == 0


def test_union_keeps_every_row(spark):
    shards = [
        spark.createDataFrame([(1, "a")], "n int, c string"),
        spark.createDataFrame([("b", 2), ("b", 2)], "c string, n int"),
    ]
    got = keys.union_shards(shards)
    assert got.count() == 3 and {r["c"] for r in got.collect()} == {"a", "b"}


def test_silver_properties(spark, sf001):
    t = DriverInputs(spark, sf001)
    spec = SPECS["enrolment"]
    valid, quarantine = silver_split(t.enrolment, spec)
    assert valid.count() + quarantine.count() == t.enrolment.count()
    silver = silver_table(t.enrolment, spec)
    assert dedup.count_duplicates(silver, KEY).first()[0] == 0
    assert silver.filter(~contracts.present("state")).count() == 0
    assert quarantine.filter(F.size("reasons") == 0).count() == 0
