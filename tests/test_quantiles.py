"""Exact quantiles and drift against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollbook.operators import stats
from rollbook.operators.quantiles import exact_quantiles

PROBS = [i / 10 for i in range(11)]


def frame(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "v double")


def test_edges_equal_numpy_to_the_last_bit(spark):
    for seed in range(3):
        values = np.random.default_rng(seed).integers(0, 300, 17 + seed)
        df = spark.createDataFrame([(int(v),) for v in values], "v bigint")
        got = [r["edge"] for r in stats.decile_edges(df, "v").orderBy("idx").collect()]
        assert got == list(np.unique(np.quantile(values, np.linspace(0, 1, 11))))


def quantiles(df, probs=PROBS):
    rows = exact_quantiles(df, "v", probs).orderBy("idx").collect()
    return [r["quantile"] for r in rows]


@pytest.mark.parametrize("size", [1, 2, 3, 10, 11, 1000])
def test_small_inputs(spark, size):
    values = np.random.default_rng(size).normal(size=size)
    assert np.allclose(quantiles(frame(spark, values)), np.quantile(values, PROBS))


# uniform values, few distinct values, one value holding most rows, a heavy tail
CASES = {
    "uniform": "rand(7)",
    "few": "cast(floor(rand(7) * 9) as double)",
    "hot": "case when id % 3 > 0 then 5.0 else rand(7) * 10 end",
    "tail": "exp(randn(7) * 4)",
}


@pytest.mark.parametrize("case", sorted(CASES))
def test_cells_give_exact_answers(spark, case):
    df = spark.range(0, 300_000, 1, 8).select(F.expr(CASES[case]).alias("v"))
    values = np.array([r[0] for r in df.collect()])
    got = quantiles(df)
    assert np.allclose(got, np.quantile(values, PROBS), rtol=1e-12)


def test_a_poor_sketch_still_gives_exact_answers(spark, monkeypatch):
    monkeypatch.setattr("rollbook.operators.quantiles.SKETCH_ACCURACY", 5)
    df = spark.range(0, 50_000, 1, 8).select(F.rand(3).alias("v"))
    values = np.array([r[0] for r in df.collect()])
    assert np.allclose(quantiles(df), np.quantile(values, PROBS), rtol=1e-12)


def test_values_are_ordered_cell_by_cell(spark):
    """Windows over values are split by cell; others see cell totals only."""
    df = spark.range(0, 1000).select(F.rand(3).alias("v"))
    plan = exact_quantiles(df, "v", PROBS)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("cell" in w or "in_cell" in w for w in windows)
    assert any("[cell" in w and "[v" in w for w in windows)


def test_groups_and_missing_values(spark):
    rows = [("a", 1.0), ("a", 3.0), ("a", None), ("b", 5.0), ("b", float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double")
    got = exact_quantiles(df, "v", [0.5], by="g").collect()
    assert {r["g"]: r["quantile"] for r in got} == {"a": 2.0, "b": 5.0}


def numpy_psi(base, current):
    edges = np.unique(np.quantile(base, np.linspace(0, 1, 11)))
    if len(edges) < 3:
        return None
    shares = []
    for v in (current, base):
        counts = np.histogram(v, bins=edges)[0]
        shares.append(np.clip(counts / max(counts.sum(), 1), 1e-6, None))
    a, e = shares
    return round(float(np.sum((a - e) * np.log(a / e))), 6)


def test_psi_equals_numpy(spark):
    rng = np.random.default_rng(3)
    groups = {
        "2025-01": rng.integers(0, 60, 700),
        "2025-02": rng.integers(10, 90, 400),
        "2025-03": np.repeat([3, 7], 50),
        "2025-04": rng.integers(500, 600, 30),
    }
    rows = [(m, int(v)) for m, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "month string, total bigint")
    got = {r[0]: r[1] for r in stats.psi_drift(df, "total", "month").collect()}
    base = groups["2025-01"]
    assert got == {m: numpy_psi(base, v) for m, v in groups.items() if m != "2025-01"}
    with_base = stats.psi_drift(df, "total", "month", include_base=True).collect()
    assert {r[0]: r[1] for r in with_base}["2025-01"] == 0.0


def test_psi_is_null_with_fewer_than_three_edges(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "month string, total int")
    assert stats.psi_drift(df, "total", "month").first()["psi"] is None


def test_histogram_equals_numpy(spark):
    values = np.random.default_rng(5).integers(0, 40, 500)
    df = spark.createDataFrame([(int(v),) for v in values], "v bigint")
    rows = stats.histogram(df, "v", df).orderBy("bin").collect()
    edges = np.unique(np.quantile(values, np.linspace(0, 1, 11)))
    assert [r["n"] for r in rows] == list(np.histogram(values, bins=edges)[0])
    assert rows[-1]["upper_edge"] == edges[-1]


def test_ten_months_cannot_flag_at_three_sigma(spark):
    rows = [("s", f"1-{m}-2024", 1_000_000 if m == 10 else 1) for m in range(1, 11)]
    df = spark.createDataFrame(rows, "state string, date string, m bigint")
    flagged = stats.state_month_anomaly(df, F.col("m")).filter("anomaly_class != 'normal'")
    assert flagged.count() == 0
    rows += [("s", f"1-{m}-2023", 1) for m in range(1, 13)]
    df = spark.createDataFrame(rows, "state string, date string, m bigint")
    flagged = stats.state_month_anomaly(df, F.col("m")).filter("anomaly_class != 'normal'")
    assert [r["month"] for r in flagged.collect()] == ["2024-10"]


def test_constant_series_and_zero_base(spark):
    rows = [("s", "1-1-2024", 0), ("s", "1-2-2024", 0), ("one", "1-1-2024", 5)]
    df = spark.createDataFrame(rows, "state string, date string, m bigint")
    got = stats.state_month_anomaly(df, F.col("m")).collect()
    assert all(r["z"] is None and r["pct_change"] is None for r in got)
    assert {r["anomaly_class"] for r in got} == {"normal"}


def test_missing_months_show_as_zero(spark):
    df = spark.createDataFrame([("5-1-2024",), ("7-4-2024",), ("x",)], "date string")
    got = stats.month_completeness(df).orderBy("month").collect()
    assert [(r["month"], r["row_count"]) for r in got] == [
        ("2024-01", 1),
        ("2024-02", 0),
        ("2024-03", 0),
        ("2024-04", 1),
    ]


def test_sample_does_not_depend_on_partitioning(spark):
    df = spark.range(1000)
    one = [r[0] for r in stats.sample(df.coalesce(1), ["id"], 7).collect()]
    many = [r[0] for r in stats.sample(df.repartition(13), ["id"], 7).collect()]
    assert one == many and len(set(one)) == 7


def test_zscore_outliers_have_no_join(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") == 7, 10**6).otherwise(1).alias("m"))
    out = stats.zscore_outliers(df, ["id"], F.col("m"))
    assert [r["id"] for r in out.collect()] == [7]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Window" not in plan
