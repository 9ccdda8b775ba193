"""Change logs, alias proposals, bucketed intervals and dead letters, on small tables."""

import random
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from rollbook.operators import aliases, changes, gold
from rollbook.plans.driver_queries import all_queries
from rollbook.sources import readers

LOG = "k int, seq int, kind string, v int"


def rows_of(df, *columns):
    return sorted(map(tuple, (df.select(*columns) if columns else df).collect()), key=repr)


def plain_latest(log):
    best = {}
    for k, seq, kind, v in log:
        rank = (seq is not None, seq or 0, kind == "delete", v is not None, v or 0)
        if k not in best or rank > best[k][0]:
            best[k] = (rank, kind, v)
    return sorted(((k, v) for k, (_, kind, v) in best.items() if kind != "delete"), key=repr)


def some_log(seed, n=400):
    rng = random.Random(seed)
    kinds = ["insert", "update", "update", "delete", None]
    return [(rng.choice([None, *range(40)]), rng.choice([None, *range(60)]), rng.choice(kinds), rng.choice([None, *range(9)])) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_latest_change_wins_in_any_order(spark, seed):
    log = some_log(seed)
    want = plain_latest(log)
    shuffled = random.Random(seed).sample(log, len(log))
    for some in (log, shuffled, log + log):
        state = changes.latest(spark.createDataFrame(some, LOG), ["k"], "seq")
        assert rows_of(changes.live(state, "seq"), "k", "v") == want
    empty = changes.latest(spark.createDataFrame([], LOG), ["k"], "seq")
    assert changes.live(empty, "seq").count() == 0


def test_states_merge_to_the_state_of_all(spark):
    log = some_log(3)
    parts = [changes.latest(spark.createDataFrame(log[i::3], LOG), ["k"], "seq") for i in range(3)]
    want = rows_of(changes.latest(spark.createDataFrame(log, LOG), ["k"], "seq"))
    assert rows_of(changes.merge(*parts, keys=["k"], sequence="seq")) == want
    assert rows_of(changes.merge(*parts[::-1], keys=["k"], sequence="seq")) == want


def edit_distance(a, b):
    @lru_cache(None)
    def d(i, j):
        if not i or not j:
            return i + j
        return min(d(i - 1, j) + 1, d(i, j - 1) + 1, d(i - 1, j - 1) + (a[i - 1] != b[j - 1]))

    return d(len(a), len(b))


@pytest.mark.parametrize("distance", [1, 2])
def test_alias_proposals_against_all_pairs(spark, distance):
    rng = random.Random(distance)
    names = ["karnataka", "kerala", "tamil nadu", "goa", "bihar", "odisha", "ab"]
    counts = {name: 30 + i for i, name in enumerate(names)}
    for name in names:
        for _ in range(6):
            chars = list(name)
            for _ in range(rng.randrange(1, 4)):
                at = rng.randrange(len(chars) + 1)
                chars[at : at + rng.randrange(2)] = rng.choice(["", "x", "a"])
            counts.setdefault("".join(chars).strip(), 1)
    counts.pop("", None)
    rows = [(f" {k.upper()}" if i % 2 else k,) for k, n in counts.items() for i in range(n)] + [(None,), ("  ",)]
    got = aliases.propose_aliases(spark.createDataFrame(rows, "label string"), "label", distance)
    want = []
    for a, n in counts.items():
        near = [(-m, edit_distance(a, b), b) for b, m in counts.items() if m >= 10 * n and edit_distance(a, b) <= distance]
        if near:
            m, d, b = min(near)
            want.append((a, b, n, -m, d))
    assert rows_of(got) == sorted(want, key=repr) and len(want) > 10
    proposed = got.select("alias", "canonical")
    fixed = gold.canonicalize(spark.createDataFrame(rows, "label string").dropna(), "label", proposed)
    assert fixed.select("label").distinct().count() < len(counts)


def test_bucketed_intervals_equal_the_plain_join(spark):
    rng = random.Random(4)

    def date(day):
        return F.date_add(F.lit("2024-01-01").cast("date"), day)

    facts = [(rng.randrange(4), rng.randrange(-50, 900), i) for i in range(300)] + [(None, 5, 900), (1, None, 901)]
    spans = [(rng.randrange(4), s, s + rng.randrange(-3, 200), j) for j, s in enumerate(rng.choices(range(-300, 1200), k=200))]
    spans += [(1, 10, None, 900), (1, None, 10, 901), (2, 0, 2_900_000, 902), (2, -700_000, 3, 903), (None, 1, 2, 904)]
    fact = spark.createDataFrame(facts, "k int, d int, i int").select("k", date(F.col("d")).alias("date"), "i")
    dim = spark.createDataFrame(spans, "k int, s int, e int, j int").select(
        "k", date(F.col("s")).alias("start_date"), date(F.col("e")).alias("end_date"), "j"
    )
    want = gold.active_interval_join(fact, dim, "k", "date")
    for days in (1, 64, 10_000):
        got = gold.bucketed_interval_join(fact, dim, "k", "date", days=days)
        assert got.columns == want.columns and rows_of(got) == rows_of(want)
    assert gold.bucketed_interval_join(fact.limit(0), dim, "k", "date").count() == 0


def test_a_key_with_many_intervals_meets_near_ones_only(spark):
    """One key, 2,000 facts and 2,000 intervals of ten days: the join itself emits few pairs."""
    day = F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int"))
    fact = spark.range(2000).select(F.lit(1).alias("k"), day.alias("date"))
    dim = spark.range(2000).select(F.lit(1).alias("k"), day.alias("start_date"), F.date_add(day, 9).alias("end_date"))
    met = gold.bucketed_interval_join(fact, dim, "k", "date", days=16)
    assert met.count() == 2000 * 10 - 45
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "bucket_" in plan and "CartesianProduct" not in plan
    # without the final filter: at most the intervals that touch the bucket of a fact
    loose = gold.bucketed_interval_join(fact, dim.withColumn("end_date", F.date_add("end_date", 0)), "k", "date", days=16)
    assert loose.count() <= 2000 * (16 + 10)


def test_intervals_in_buckets_are_never_broadcast(spark):
    """One row of the dimension becomes 40,000 before it is joined, and the planner counts it as one."""
    day = F.lit("2000-01-01").cast("date")
    dim = spark.range(1).select(F.col("id").alias("k"), day.alias("start_date"), F.date_add(day, 40_000).alias("end_date"))
    fact = spark.range(40_001).select(F.lit(0).cast("bigint").alias("k"), F.date_add(day, F.col("id").cast("int")).alias("date"))
    met = gold.bucketed_interval_join(fact, dim, "k", "date", days=1)
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert met.count() == 40_001


def test_parts_are_dealt_out_before_they_become_intervals(spark, sf001):
    df = all_queries()["bucketed_interval_join"](spark, sf001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange hashpartitioning(p_partkey" in plan


def test_dead_letters_keep_what_came(spark):
    values = ['{"date":"1-1-2025","state":"s","odd":{"x":[1]}}', "{", "[]", '"text"', "7", "null", "{}", '{"odd":1}', None, "", '{"date":null}']
    messages = spark.createDataFrame([(v, "t", 0, i) for i, v in enumerate(values)], "value string, topic string, partition int, offset long")
    messages = messages.withColumns({"value": F.col("value").cast("binary"), "timestamp": F.current_timestamp()})
    good, dead = readers.split_messages(messages, "enrolment")
    assert [r.offset for r in good.orderBy("offset").collect()] == [0, 10]
    first = good.orderBy("offset").select("date", "state", "pincode", F.to_json("rest").alias("rest")).first()
    assert (first.date, first.state, first.pincode) == ("1-1-2025", "s", None) and "odd" in first.rest
    found = {r.offset: (r.raw, r.reason) for r in dead.collect()}
    assert {k: v[0] for k, v in found.items()} == {i: v for i, v in enumerate(values) if i not in (0, 10)}
    assert found[8][1] == "no value" and found[1][1] == "unreadable JSON" and found[7][1] == "no declared field"
    assert {found[i][1] for i in (2, 3, 4, 5)} == {"not an object"} and found[6][1] == "no declared field"
