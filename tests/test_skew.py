"""Balance of the heavy steps when one key holds a third of the rows."""

from pyspark.sql import functions as F

from rollbook.operators import dedup, gold, keys, skew
from rollbook.plans.driver_inputs import DriverInputs


def rows_per_task(df):
    return sorted(r[0] for r in df.groupBy(F.spark_partition_id()).count().select("count").collect())


def hot(spark, n=200_000):
    return spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 5000).alias("k"),
        F.col("id").alias("seq"),
    )


def test_spread_join_leaves_no_heavy_task(spark):
    """Joined by key alone, one task would get at least a third of all rows."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        df = hot(spark)
        counts = dedup.key_counts(df, ["k"]).filter("n > 1")
        joined = skew.semi_join_spread(df, counts, ["k"])
        sizes = rows_per_task(joined)
        assert sum(sizes) == 200_000
        assert sizes[-1] < 200_000 / 8
        plain = df.join(counts, "k", "left_semi")
        assert rows_per_task(plain)[-1] > 200_000 / 3
        # hot rows meet a broadcast only: the one shuffled row join comes after the anti join
        plan = joined._jdf.queryExecution().executedPlan().toString()
        hot_side = plan[: plan.index("LeftAnti")]
        assert "BroadcastHashJoin" in hot_side and "SortMergeJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_adaptive_join_splits_a_hot_dimension_key(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.shuffle.partitions": "40",
    }
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        dim = spark.range(-1, 5000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("d"))
        joined = gold.fact_to_dim(hot(spark, 400_000), dim, "k")
        assert joined.filter("d is not null").count() == 400_000
        joined.write.format("noop").mode("overwrite").save()
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for key in settings:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_funnel_sums_before_its_join(spark):
    fact = spark.createDataFrame(
        [(1, 10, 8, 4, 2.0), (1, 10, 2, 1, 1.0), (9, 5, 5, 0, 0.0)],
        "scheme_id int, applications bigint, approved bigint, disbursed bigint, amount double",
    )
    schemes = spark.createDataFrame([(1, "Health")], "scheme_id int, scheme_type string")
    steps = ("applications", "approved", "disbursed", "amount")
    df = gold.scheme_funnel_kpi(fact, schemes, columns={c: c for c in steps})
    rows = {r["scheme_type"]: r for r in df.collect()}
    assert (rows["Health"]["approval_pct"], rows["Health"]["amount_per_head"]) == (50.0, 0.6)
    assert (rows["Other"]["disbursal_pct"], rows["Other"]["amount_per_head"]) == (0.0, 0.0)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Join") < plan.rindex("HashAggregate")


def test_a_doubled_alias_does_not_multiply_rows(spark):
    df = spark.createDataFrame([(" up ",), ("Bihar",), (None,)], "state string")
    aliases = spark.createDataFrame(
        [("up", "Uttar Pradesh"), ("up", "Upper")], "alias string, canonical string"
    )
    got = [r[0] for r in gold.canonicalize(df, "state", aliases).collect()]
    assert sorted(got, key=str) == ["Bihar", None, "Upper"]


def feeds(spark):
    """Three feeds of 20,000 keys each, a third of the first one row, with odd dates and labels."""

    def feed(first, hot):
        key = F.when((F.col("id") % 3 == 0) & F.lit(hot), F.lit(7)).otherwise(F.col("id") % 20_000 + first)
        day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (key % 300).cast("int")), "d-M-yyyy")
        return spark.range(0, 30_000, 1, 8).select(
            F.when(key % 211 == 0, "never").otherwise(day).alias("date"),
            F.when(key % 97 == 0, None).when(key % 2 == 0, " Up ").otherwise("up").alias("state"),
            F.lit("D").alias("district"),
            F.concat(key.cast("string"), F.when(F.col("id") % 5 == 0, ".0").otherwise("")).alias("pincode"),
        )

    return [feed(0, True), feed(500, False), feed(30_000, False)]


def test_coverage_keeps_the_rows_of_a_task_alike(spark, monkeypatch):
    """By the session's eight partitions alone, a task would group a growing part of the keys."""
    monkeypatch.setattr(skew, "TASK_ROWS", 2000)
    tables, rows = feeds(spark), [30_000] * 3
    named = dict(zip("abc", tables))
    sizes = rows_per_task(keys.key_presence(named, rows=rows))
    assert sizes[-1] < 2 * 2000 < rows_per_task(keys.key_presence(named))[-1]
    for compat in (False, True):
        want = keys.coverage_summary(*tables, compat=compat).collect()
        assert keys.coverage_summary(*tables, compat=compat, rows=rows).collect() == want
        assert min(r.value for r in want) > 100
    assert keys.coverage_pct(*tables, rows=rows).collect() == keys.coverage_pct(*tables).collect()


def test_copies_of_one_row_meet_in_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(skew, "TASK_ROWS", 1000)
    hot_feed = feeds(spark)[0]
    found = skew.spread_distinct(hot_feed, 30_000)
    want = hot_feed.distinct()
    assert found.distinct().exceptAll(want).isEmpty() and want.exceptAll(found).isEmpty()
    most = found.groupBy(*found.columns).count().agg(F.max("count")).first()[0]
    assert 4 <= most <= skew.DEALS  # eight scans hold the hot row
    assert skew.spread_distinct(hot_feed, 8000).count() == want.count() == skew.spread_distinct(hot_feed, None).count()


def test_line_items_of_a_task_stay_alike(spark, sf001, monkeypatch):
    monkeypatch.setattr(skew, "TASK_ROWS", 2000)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = DriverInputs(spark, sf001).lines
        sizes = rows_per_task(lines)
        assert len(sizes) == 30 and sizes[-1] < 2 * 2000 and sum(sizes) == 60_000
        plan = lines._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(l_orderkey") == 1
        assert "Exchange hashpartitioning(o_orderkey" in plan and plan.index("l_orderkey") < plan.index("c_custkey")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
