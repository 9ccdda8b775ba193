"""One registered query per operator, over the whole tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.catalog import KEY, SCHEMAS, SPECS, conform_schema
from rollbook.functions import columns as fn
from rollbook.operators import aliases, changes, contracts, dedup, gold, keys, profile, reports, sketches, stats
from rollbook.operators.reshape import settled
from rollbook.plans.driver_inputs import DriverInputs
from rollbook.plans.silver import silver_split, silver_table
from rollbook.sources import readers, writers
from rollbook.streaming import streams

ENROL = SPECS["enrolment"]
MEASURES = list(ENROL.measures)
COLUMNS = list(ENROL.data_columns)
AS_OF = "2001-12-31"


def _total():
    return fn.row_total(*MEASURES)


_REGISTRY: dict[str, Callable[[DriverInputs], DataFrame]] = {}


def query(function: Callable[[DriverInputs], DataFrame]):
    _REGISTRY[function.__name__] = function
    return function


_INPUTS: dict[tuple, DriverInputs] = {}


def _inputs(spark: SparkSession, folder: str) -> DriverInputs:
    """The views of a folder, whose file schemas are read once per session. No data is kept."""
    key = (spark.sparkContext.applicationId, id(spark), folder)
    if key not in _INPUTS:
        _INPUTS[key] = DriverInputs(spark, folder)
    return _INPUTS[key]


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(function):
        return lambda spark, folder: function(_inputs(spark, folder))

    return {name: bind(function) for name, function in _REGISTRY.items()}


# --- sources and sinks ---------------------------------------------------------


@query
def schema_conform(t):
    drifted = t.demographic.withColumnRenamed("demo_age_17", "demo_age_7")
    return conform_schema(drifted, SCHEMAS["demographic"])


@query
def load_audit_counts(t):
    shard = F.when(F.col("ingest_seq") % 2 == 0, "base").otherwise("copies")
    bad = fn.parse_date("date").isNull()
    return writers.load_audit(t.enrolment.withColumn("shard", shard), "shard", bad)


@query
def scan_full(t):
    return t.enrolment


@query
def merged_row_count(t):
    return writers.verify_row_count(keys.union_shards(_order_shards(t)))


@query
def bronze_lineage(t):
    event_ts = fn.parse_date("date").cast("timestamp_ntz")
    ingest_ts = F.lit("2002-01-01").cast("timestamp_ntz")
    lineage = writers.with_lineage(
        t.enrolment,
        "orders",
        7,
        event_ts,
        ingest_ts,
        F.lit("enrolment"),
        F.col("ingest_seq"),
    )
    return lineage.select(
        "ingest_seq", "source", "event_ts", "ingest_ts", "topic", "offset", "batch_id"
    )


def _order_shards(t):
    orders = t.table("orders")
    top = orders.agg(F.max("o_orderkey")).scalar()
    low, high = top * 0.33, top * 0.66
    key = F.col("o_orderkey")
    return [
        orders.filter(key < low),
        orders.filter((key >= low) & (key < high)),
        orders.filter(key.isNull() | (key >= high)),  # whatever no other shard takes
    ]


@query
def union_shards(t):
    return keys.union_shards(_order_shards(t))


# --- projections, filters, scalar functions ------------------------------------


@query
def key_projection(t):
    return t.enrolment.select(*KEY, "ingest_seq")


@query
def preview_ordered(t):
    return stats.preview(t.enrolment, ["ingest_seq"], 10)


@query
def parse_date(t):
    return t.enrolment.select("ingest_seq", "date", fn.parse_date("date").alias("parsed"))


@query
def normalize_pincode(t):
    return t.enrolment.select(
        "ingest_seq", "pincode", fn.normalize_pincode("pincode").alias("normalized")
    )


@query
def normalize_name(t):
    return t.enrolment.select(
        "ingest_seq",
        fn.normalize_name("state").alias("state_name"),
        fn.normalize_name("district").alias("district_name"),
    )


@query
def title_name(t):
    return t.enrolment.select(
        "ingest_seq",
        fn.title_name("state").alias("state_title"),
        fn.title_name("district").alias("district_title"),
    )


@query
def numeric_coerce(t):
    return t.enrolment.select(
        "ingest_seq",
        fn.to_numeric("pincode").alias("pincode_number"),
        fn.to_numeric("date").alias("date_number"),
        fn.to_whole("pincode").alias("pincode_whole"),
    )


@query
def row_total(t):
    return t.enrolment.select("ingest_seq", _total().alias("total"))


@query
def negative_rows(t):
    return t.enrolment.filter(fn.any_negative(*MEASURES)).select("ingest_seq", *COLUMNS)


@query
def state_slice(t):
    return t.enrolment.filter(fn.normalize_name("state") == "middle east")


@query
def drop_null_keys(t):
    return t.enrolment.dropna(subset=list(KEY))


@query
def month_bucket(t):
    d = fn.parse_date("date")
    return t.enrolment.select(
        "ingest_seq",
        fn.month_of(d).alias("month"),
        fn.month_of(d, keep_invalid=True).alias("month_or_nat"),
    )


@query
def valid_pincode_flag(t):
    return t.enrolment.select("ingest_seq", fn.is_valid_pincode("pincode").alias("valid_pincode"))


@query
def blank_rows(t):
    return t.enrolment.filter(fn.is_blank("state"))


@query
def pincode_length_dist(t):
    return profile.text_length_distribution(t.enrolment, fn.normalize_pincode("pincode"))


@query
def surrogate_code(t):
    return t.table("part").select(
        "p_partkey", fn.make_code("SCH", F.col("p_partkey") + 1).alias("scheme_id")
    )


@query
def ratio_guarded(t):
    return t.enrolment.select("ingest_seq", fn.pct_of("age_0_5", "age_5_17").alias("ratio_pct"))


@query
def canonical_names(t):
    named = gold.canonicalize(t.enrolment, "district", t.aliases)
    return gold.canonicalize(named, "state", t.aliases).select("ingest_seq", "state", "district")


# --- joins ----------------------------------------------------------------------


@query
def conformed_key(t):
    return keys.conformed_key(t.enrolment)


@query
def conformed_key_compat(t):
    return keys.conformed_key(t.enrolment, compat=True)


@query
def missing_keys_ab(t):
    return keys.missing_keys(keys.conformed_key(t.enrolment), keys.conformed_key(t.demographic))


@query
def missing_keys_ba(t):
    return keys.missing_keys(keys.conformed_key(t.demographic), keys.conformed_key(t.enrolment))


@query
def missing_keys_ac(t):
    return keys.missing_keys(keys.conformed_key(t.enrolment), keys.conformed_key(t.biometric))


@query
def missing_keys_ca(t):
    return keys.missing_keys(keys.conformed_key(t.biometric), keys.conformed_key(t.enrolment))


@query
def matched_keys(t):
    return keys.matched_keys(keys.conformed_key(t.enrolment), keys.conformed_key(t.biometric))


@query
def merge_indicator(t):
    return keys.merge_indicator(
        keys.conformed_key(t.enrolment), keys.conformed_key(t.demographic)
    )


@query
def coverage_pct(t):
    return keys.coverage_pct(t.enrolment, t.demographic, t.biometric, rows=t.feed_rows)


@query
def coverage_summary(t):
    return keys.coverage_summary(t.enrolment, t.demographic, t.biometric, rows=t.feed_rows)


@query
def coverage_summary_compat(t):
    return keys.coverage_summary(t.enrolment, t.demographic, t.biometric, compat=True, rows=t.feed_rows)


@query
def conformed_wide(t):
    return keys.conformed_wide(
        {
            "enrolment": (t.enrolment, ENROL.measures),
            "demographic": (t.demographic, SPECS["demographic"].measures),
            "biometric": (t.biometric, SPECS["biometric"].measures),
        }
    )


@query
def fact_star_join(t):
    silver = settled(silver_table(t.enrolment, ENROL, {"district": t.aliases}))
    fact = gold.fact_table(silver, ["ingest_seq", *MEASURES])
    dated = gold.fact_to_dim(
        fact, gold.dim_date(silver).select("date_key", "year", "quarter", "month"), "date_key"
    )
    return gold.fact_to_dim(dated, gold.dim_location(silver), "location_key")


@query
def active_interval_join(t):
    start = F.date_add(F.lit("1995-01-01").cast("date"), F.col("p_size"))
    dim = t.table("part").select(
        F.col("p_partkey").alias("l_partkey"),
        start.alias("start_date"),
        F.date_add(start, 1000).alias("end_date"),
    )
    fact = t.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.to_date("l_shipdate").alias("date")
    )
    return gold.active_interval_join(fact, dim, "l_partkey", "date")


@query
def bucketed_interval_join(t):
    start = F.date_add(F.lit("1994-01-01").cast("date"), F.col("p_size") + 45 * F.col("k"))
    # the parts lie in one or two splits of a file: dealt out before each becomes 41 intervals
    part = t.table("part").select("p_partkey", "p_size").repartition("p_partkey")
    dim = part.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(40)))).select(
        F.col("p_partkey").alias("l_partkey"), "k", start.alias("start_date"), F.date_add(start, 60).alias("end_date")
    )
    fact = t.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.to_date("l_shipdate").alias("date")
    )
    return gold.bucketed_interval_join(fact, dim, "l_partkey", "date")


@query
def change_log_state(t):
    state = changes.latest(t.changes, ["user_id", "event_type"], "event_id")
    return changes.live(state, "event_id")


@query
def alias_proposals(t):
    return aliases.propose_aliases(t.spellings, "label")


@query
def messages_parsed(t):
    rows, _ = readers.split_messages(t.messages, "enrolment")
    return rows.withColumn("rest", F.to_json("rest"))


@query
def messages_dead_letters(t):
    _, dead = readers.split_messages(t.messages, "enrolment")
    return dead


@query
def window_day_totals(t):
    totals = streams.window_totals(t.table("events"), "ts", ["event_type"], ["value"])
    return totals.withColumn("value", F.round("value", 4))


# --- aggregations -----------------------------------------------------------------


@query
def table_shape(t):
    return profile.table_shape(t.enrolment, COLUMNS)


@query
def dup_full_count(t):
    return dedup.count_duplicates(t.enrolment, COLUMNS, "full_duplicates")


@query
def dup_key_count(t):
    return dedup.count_duplicates(t.enrolment, KEY, "key_duplicates")


@query
def null_profile(t):
    return profile.null_profile(t.enrolment, COLUMNS)


@query
def blank_profile(t):
    return profile.blank_profile(t.enrolment, COLUMNS)


@query
def missing_profile(t):
    return profile.missing_profile(t.enrolment, COLUMNS)


@query
def fully_empty_rows(t):
    return profile.fully_empty_rows(t.enrolment, COLUMNS)


@query
def column_profile(t):
    return profile.column_profile(t.enrolment, COLUMNS)


@query
def merged_sketches(t):
    """Sketches of three parts of the table, merged: exact counts, and whether estimates hold."""
    parts = [t.enrolment.filter(F.col("ingest_seq") % 3 == k) for k in range(3)]
    stored = [sketches.column_sketches(p, COLUMNS, MEASURES) for p in parts]
    merged = sketches.merge_sketches(keys.union_shards(stored))
    unique = profile.column_profile(t.enrolment, COLUMNS).select("column", "unique_count")
    off = F.abs(F.col("unique_estimate") - F.col("unique_count"))
    near = off <= F.greatest(sketches.DISTINCT_ERROR * F.col("unique_count"), F.lit(1))
    return sketches.sketch_profile(merged).join(unique, "column").select(
        "column", "rows", "null_count", "blank_count", "min", "max", near.alias("unique_within_bound")
    )


@query
def describe_numeric(t):
    return profile.describe_numeric(t.enrolment, MEASURES)


@query
def describe_text(t):
    return profile.describe_text(t.enrolment, list(KEY))


@query
def distinct_counts(t):
    month = fn.month_of(fn.parse_date("date"))
    return profile.distinct_count(
        t.enrolment.withColumn("month", month), ["state", "district", "pincode", "month"]
    )


@query
def distinct_labels(t):
    return profile.distinct_values(t.enrolment, "district")


@query
def districts_per_state(t):
    return profile.cardinality_by(t.enrolment, "state", "district", "district_nunique")


@query
def fd_pincode_district(t):
    return profile.fd_violations(t.enrolment, "pincode", "district", "district_nunique")


@query
def fd_district_state(t):
    return profile.fd_violations(t.enrolment, "district", "state", "state_nunique")


@query
def fd_violation_counts(t):
    return profile.fd_violation_count(
        t.enrolment, "pincode", "district", "pincode_district"
    ).unionByName(profile.fd_violation_count(t.enrolment, "district", "state", "district_state"))


@query
def fd_in_state(t):
    rows = t.enrolment.filter(fn.normalize_name("state") == "asia")
    return profile.fd_violations(rows, "pincode", "district", "district_count")


@query
def date_range(t):
    return profile.date_range(t.enrolment)


@query
def monthly_total(t):
    return profile.monthly_total(t.enrolment, _total())


@query
def monthly_total_with_invalid(t):
    return profile.monthly_total(t.enrolment, _total(), keep_invalid_month=True)


@query
def monthly_rows(t):
    return profile.monthly_rows(t.enrolment, keep_invalid_month=True)


@query
def state_month_total(t):
    return profile.group_month_total(t.enrolment, _total())


def _yearly(t):
    year = F.year(fn.parse_date("date"))
    return t.enrolment.select(year.alias("year"), _total().alias("total"))


@query
def decile_edges(t):
    edges = stats.decile_edges(_yearly(t), "total")
    return edges.select("idx", F.round("edge", 6).alias("edge"))


@query
def histogram_counts(t):
    rows = _yearly(t)
    return stats.histogram(rows, "total", rows).select(
        "bin",
        F.round("lower_edge", 6).alias("lower_edge"),
        F.round("upper_edge", 6).alias("upper_edge"),
        "n",
    )


@query
def kpi_rollup(t):
    return gold.kpi_rollup(silver_table(t.enrolment, ENROL), MEASURES)


@query
def kpi_cube(t):
    return gold.kpi_cube(silver_table(t.enrolment, ENROL), MEASURES)


# --- windows, sorts, limits ---------------------------------------------------------


@query
def dedup_keep_first(t):
    return dedup.dedup_keep_first(t.enrolment, KEY, ENROL.order)


@query
def duplicate_groups(t):
    return dedup.duplicate_groups(t.enrolment, KEY)


@query
def zscore_outliers(t):
    out = stats.zscore_outliers(t.enrolment, [*KEY, "ingest_seq"], _total(), k=1.5)
    return out.withColumn("z", F.round("z", 6))


@query
def state_month_pct_change(t):
    series = profile.group_month_total(t.enrolment, _total())
    changed = stats.pct_change(series, "total", "state", "month")
    return changed.withColumn("pct_change", F.round("pct_change", 6))


@query
def mom_growth(t):
    return stats.mom_growth(t.enrolment, _total())


@query
def trend_moving_avg(t):
    return stats.trend_mart(profile.group_month_total(t.enrolment, _total()))


@query
def state_rank_by_month(t):
    return stats.rank_locations(profile.group_month_total(t.enrolment, _total()), 3)


@query
def top_conflict_pincodes(t):
    conflicts = profile.fd_violations(t.enrolment, "pincode", "district", "district_nunique")
    return stats.top_n(conflicts, "district_nunique", 20, ["pincode"])


@query
def last_n_months(t):
    return stats.last_n_months(t.enrolment, 24)


# --- set operations -------------------------------------------------------------------


@query
def distinct_keys(t):
    return keys.distinct_keys(t.enrolment, ["state", "district", "pincode"])


@query
def key_except(t):
    return keys.key_except(keys.key_columns(t.enrolment), keys.key_columns(t.demographic))


@query
def key_intersect(t):
    return keys.key_intersect(keys.key_columns(t.enrolment), keys.key_columns(t.demographic))


# --- quality and reporting ---------------------------------------------------------------


@query
def duplicate_impact(t):
    return dedup.duplicate_impact(t.enrolment, COLUMNS, KEY, ENROL.order)


@query
def contract_check(t):
    first = dedup.dedup_keep_first(t.enrolment, KEY, ENROL.order)
    return contracts.contract_check(first, contracts.contract_rules(ENROL))


@query
def contract_check_raw(t):
    return contracts.contract_check(t.enrolment, contracts.contract_rules(ENROL))


@query
def key_null_check(t):
    return contracts.key_null_check(t.enrolment, KEY)


@query
def column_roles(t):
    return reports.classify_columns(t.enrolment, ENROL)


@query
def key_feasibility(t):
    tables = {
        "enrollment": t.enrolment,
        "demographic": t.demographic,
        "biometric": t.biometric,
    }
    return keys.key_feasibility(tables, KEY)


@query
def psi_drift(t):
    drift = stats.psi_drift(_yearly(t), "total", "year")
    return drift.withColumn("year", F.col("year").cast("string"))


@query
def psi_drift_monthly(t):
    month = F.trunc(fn.parse_date("date"), "month")
    rows = t.enrolment.select(month.alias("month"), _total().alias("total"))
    drift = stats.psi_drift(rows, "total", "month", include_base=True)
    return drift.withColumn("month", fn.month_of("month"))


@query
def state_month_anomaly(t):
    return stats.state_month_anomaly(t.enrolment, _total())


@query
def state_month_anomaly_sensitive(t):
    return stats.state_month_anomaly(t.enrolment, _total(), pct=0.2, z=1.5)


@query
def rule_status(t):
    return reports.rule_status(t.enrolment, ENROL)


@query
def risk_register(t):
    return reports.risk_register(t.enrolment, ENROL)


@query
def summary_metrics(t):
    return reports.summary_metrics(t.enrolment, ENROL)


@query
def findings_table(t):
    return reports.findings_table(t.enrolment, ENROL)


@query
def month_completeness(t):
    return stats.month_completeness(t.enrolment)


@query
def silver_valid(t):
    valid, _ = silver_split(t.enrolment, ENROL, {"district": t.aliases})
    return valid


@query
def silver_quarantine(t):
    _, quarantine = silver_split(t.enrolment, ENROL)
    return quarantine.withColumn("reasons", F.array_join("reasons", ","))


@query
def silver_rows(t):
    return silver_table(t.enrolment, ENROL, {"district": t.aliases})


@query
def quality_score(t):
    return contracts.quality_score(
        t.enrolment, contracts.silver_rules(ENROL), contracts.rule_severities(ENROL)
    )


@query
def freshness(t):
    return stats.freshness(t.enrolment, AS_OF)


@query
def balance_check(t):
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    quantity = F.floor("l_quantity")

    def when(condition):
        return F.coalesce(F.sum(F.when(condition, quantity)), F.lit(0))

    net = F.col("l_extendedprice").cast("decimal(18,2)") * (
        1 - F.col("l_discount").cast("decimal(4,2)")
    )
    per_order = (
        t.table("lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.sum(quantity).alias("total"),
            when(flag == "A").alias("flag_a"),
            when(flag == "N").alias("flag_n"),
            when(flag == "R").alias("flag_r"),
            when(status == "F").alias("finished"),
            F.max(net).alias("top_line"),
        )
        .join(t.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    )
    return contracts.balance_check(
        per_order,
        {
            "flags_sum_to_total": "flag_a + flag_n + flag_r = total",
            "finished_within_total": "finished <= total",
            "line_within_order": "top_line <= cast(o_totalprice as decimal(18,2))",
        },
    )


# --- gold -------------------------------------------------------------------------------------


@query
def dim_date(t):
    dated = t.enrolment.select(fn.parse_date("date").alias("date"))
    return gold.dim_date(dated)


@query
def dim_location(t):
    return gold.dim_location(silver_table(t.enrolment, ENROL))


@query
def linkage_kpi(t):
    status = F.col("o_orderstatus")

    def count(condition):
        return condition.cast("bigint")

    by_customer = (
        t.table("orders")
        .withColumn("month", fn.month_of("o_orderdate"))
        .groupBy("o_custkey", "month")
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.sum(count(status == "F")).alias("linked"),
            F.sum(count(status == "P")).alias("pending"),
            F.sum(count(status == "O")).alias("rejected"),
        )
    )
    rows = by_customer.join(t.geo, F.col("o_custkey") == F.col("c_custkey"))
    return gold.linkage_kpi(rows, ["state", "month"], "total", "linked", ["pending", "rejected"])


@query
def net_change_kpi(t):
    quantity = F.floor("l_quantity")
    new = F.when(F.col("l_linestatus") == "O", quantity).otherwise(0)
    deleted = F.when(F.col("l_returnflag") == "R", quantity).otherwise(0)
    accepted = F.when(F.col("l_returnflag") == "A", quantity).otherwise(0)
    normal = F.when(F.col("l_returnflag") == "N", quantity).otherwise(0)
    # five states and a month each: the rows are summed where they are joined, not per order before
    monthly = t.lines.groupBy("state", F.trunc("l_shipdate", "month").alias("start")).agg(
        F.sum(quantity).alias("total"),
        F.sum(new).alias("new"),
        F.sum(deleted).alias("deletions"),
        F.sum(accepted).alias("accepted"),
        F.sum(normal).alias("normal"),
    )
    rows = monthly.withColumn("month", fn.month_of("start"))
    return gold.net_change_kpi(
        rows, ["state", "month"], "new", "deletions", "total", ("accepted", "normal")
    )


@query
def scheme_funnel_kpi(t):
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    quantity = F.floor("l_quantity")
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    fact = t.table("lineitem").select(
        F.col("l_partkey").alias("scheme_id"),
        quantity.alias("applications"),
        F.when(flag != "R", quantity).otherwise(0).alias("approved"),
        F.when((flag != "R") & (status == "F"), quantity).otherwise(0).alias("disbursed"),
        (price * (1 - F.col("l_discount").cast("decimal(4,2)"))).alias("amount"),
    )
    schemes = t.table("part").select(
        F.col("p_partkey").alias("scheme_id"), F.col("p_type").alias("scheme_type")
    )
    steps = ("applications", "approved", "disbursed", "amount")
    return gold.scheme_funnel_kpi(fact, schemes, columns={c: c for c in steps})


@query
def location_pool(t):
    districts = t.geo.groupBy("state", "district").agg(
        (F.lit(100000) + F.min("c_custkey") * 10).alias("pincode_base")
    )
    return gold.location_pool(districts, 4)


@query
def dense_location_month(t):
    return gold.dense_location_month(silver_table(t.enrolment, ENROL), MEASURES)
