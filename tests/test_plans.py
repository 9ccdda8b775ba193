"""Physical plans: no cross joins, no single-task windows over rows, pruned scans."""

import re

import pytest
from pyspark.sql import functions as F

from rollbook.plans.driver_queries import all_queries

SF = "/root/testdata/sf0.01"
QUERIES = all_queries()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan


def test_scans_read_only_needed_columns(spark):
    plan = plan_of(QUERIES["state_month_total"](spark, SF))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert not any("o_orderpriority" in s or "c_acctbal" in s for s in schemas)


def test_coverage_needs_one_shuffle_of_keys(spark):
    plan = plan_of(QUERIES["coverage_summary"](spark, SF))
    keyed = re.findall(r"Exchange hashpartitioning\(date_key[^)]*\)", plan)
    assert len(keyed) == 1


def test_net_change_sums_no_orders_or_customers(spark):
    """As many sums as rows would be held by a task; months and states are few."""
    plan = plan_of(QUERIES["net_change_kpi"](spark, SF))
    assert not re.search(r"HashAggregate\(keys=\[(l_orderkey|o_custkey)", plan)
    assert re.search(r"HashAggregate\(keys=\[state", plan)


def test_missing_keys_reuses_the_distinct_shuffles(spark):
    plan = plan_of(QUERIES["missing_keys_ab"](spark, SF))
    keyed = re.findall(r"Exchange hashpartitioning\(date_key[^)]*\)", plan)
    assert len(keyed) == 2


def test_silver_filter_is_pushed_to_a_silver_table(spark, tmp_path):
    path = str(tmp_path / "silver")
    df = QUERIES["silver_rows"](spark, SF).withColumn("month", F.date_format("date", "yyyy-MM"))
    df.write.partitionBy("month").parquet(path)
    read = spark.read.parquet(path).filter("month = '1996-01' and state = 'Asia'")
    plan = plan_of(read.select("age_0_5"))
    assert "PartitionFilters: [isnotnull(month" in plan
    assert "EqualTo(state,Asia)" in plan
