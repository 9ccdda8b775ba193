"""Profiles that merge, against exact counts and quantiles."""

import random

import numpy as np
from pyspark.sql import functions as F

from rollbook.operators import contracts, keys, sketches
from rollbook.plans import batch
from test_sources import HEADER


def test_merged_sketches_hold_their_bounds(spark):
    rng = np.random.default_rng(3)
    n = 60_000
    df = spark.range(n).select(
        "id",
        F.col("id").cast("string").alias("each"),
        (F.col("id") % 97).cast("string").alias("few"),
        F.when(F.col("id") % 5 == 0, "  ").when(F.col("id") % 7 == 0, None).otherwise("x").alias("odd"),
        F.when(F.col("id") % 11 > 0, F.pow(F.col("id") / n, 3)).alias("v"),
    )
    columns = ["each", "few", "odd", "v"]
    whole = sketches.column_sketches(df, columns, ["v"])
    cuts = sorted(rng.integers(0, n, 5).tolist())
    parts = [
        sketches.column_sketches(df.filter((F.col("id") >= a) & (F.col("id") < b)), columns, ["v"])
        for a, b in zip([0, *cuts], [*cuts, n])
    ]
    for stored in (whole, keys.union_shards(parts), keys.union_shards(parts[::-1])):
        out = {r.column: r for r in sketches.sketch_profile(sketches.merge_sketches(stored)).collect()}
        for c, unique in (("each", n), ("few", 97), ("odd", 2)):
            assert abs(out[c].unique_estimate - unique) <= max(1, sketches.DISTINCT_ERROR * unique)
        assert (out["odd"].rows, out["odd"].blank_count) == (n, n // 5)
        assert out["odd"].null_count == sum(i % 7 == 0 and i % 5 > 0 for i in range(n))
        values = np.sort([(i / n) ** 3 for i in range(n) if i % 11])
        for p, q in zip((0.25, 0.5, 0.75), out["v"].quantiles):
            assert abs(np.searchsorted(values, q) / len(values) - p) <= sketches.RANK_ERROR
        assert (out["v"].min, out["v"].max) == (values[0], values[-1]) and out["few"].quantiles is None
    none = {r.column: r for r in sketches.sketch_profile(sketches.merge_sketches(sketches.column_sketches(df.limit(0), columns, ["v"]))).collect()}
    assert none["v"].rows == 0 and none["v"].quantiles is None and none["each"].unique_estimate == 0


def test_each_batch_adds_to_the_profile(spark, tmp_path):
    rng, lake = random.Random(2), str(tmp_path / "lake")
    for k in (1, 2, 3):
        lines = [f"{1 + i % 28}-{k}-2025,Asia,North,{560000 + rng.randrange(300)},{i % 40 - (i % 9 == 0)},2,3" for i in range(100 * k)]
        (tmp_path / f"f{k}.csv").write_text("\n".join([HEADER, *lines]) + "\n")
        batch.run_bronze(spark, [str(tmp_path / f"f{k}.csv")], "enrolment", k, lake)
        out = batch.run_sketches(spark, "enrolment", lake, k)
    spec = batch.bronze_spec("enrolment")
    bronze = spark.read.parquet(f"{lake}/bronze/enrolment")
    found = {r.column: r for r in out["profile"].collect()}
    assert found["pincode"].rows == 600
    assert abs(found["pincode"].unique_estimate - bronze.select("pincode").distinct().count()) <= 8
    history = out["history"].orderBy("batch_id").collect()
    assert [(r.batch_id, r.rows, r.rows_so_far) for r in history] == [(1, 100, 100), (2, 200, 300), (3, 300, 600)]
    typed = batch.typed_measures(bronze, spec)
    want = contracts.quality_score(typed, contracts.silver_rules(spec), contracts.rule_severities(spec)).first()
    assert abs(history[-1].score_so_far - want.quality_score) < 1e-5
    # one more run of a batch changes nothing, and the plan of its sketch reads that batch only
    again = batch.run_sketches(spark, "enrolment", lake, 3)
    assert {r.column: r.rows for r in again["profile"].collect()} == {c: r.rows for c, r in found.items()}
