"""Report tables: roles, summaries, rule status, risks and findings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.catalog import TableSpec
from rollbook.functions.columns import any_negative, normalize_name, row_total
from rollbook.operators.dedup import duplicate_counts, key_counts
from rollbook.operators.profile import column_profile, fd_violation_count, null_cells
from rollbook.operators.reshape import metric_rows
from rollbook.operators.stats import state_month_anomaly


def column_role(column: str, spec: TableSpec) -> str:
    if column == spec.date:
        return "Time Dimension"
    if column in spec.keys:
        return "Location Dimension"
    return "Measure" if column in spec.measures else "Attribute"


def classify_columns(df: DataFrame, spec: TableSpec, exact: bool = True) -> DataFrame:
    """Column profile with each column's role: time, location, measure or attribute."""
    columns = list(spec.data_columns) + [c for c in df.columns if c not in spec.data_columns]
    roles = F.create_map(*[F.lit(x) for c in columns for x in (c, column_role(c, spec))])
    return column_profile(df, columns, exact).select(
        "column", roles[F.col("column")].alias("role"), "dtype", "null_pct", "unique_count"
    )


def summary_metrics(df: DataFrame, spec: TableSpec) -> DataFrame:
    """(metric, value): rows, columns, null cells, duplicates and states, from one scan."""
    columns = list(spec.data_columns)
    per_row = key_counts(df, columns)
    per_key = per_row.groupBy(*spec.keys).agg(
        F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.sum(F.col("n") * null_cells(columns)).alias("null_cells"),
    )
    per_state = per_key.groupBy("state").agg(
        F.sum("n").alias("n"),
        F.sum("distinct_rows").alias("distinct_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.sum("null_cells").alias("null_cells"),
    )
    row = per_state.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.lit(len(columns)).alias("columns"),
        F.coalesce(F.sum("null_cells"), F.lit(0)).alias("null_cells_total"),
        F.coalesce(F.sum(F.col("n") - F.col("distinct_rows")), F.lit(0)).alias(
            "full_row_duplicates"
        ),
        F.coalesce(F.sum(F.col("n") - F.col("distinct_keys")), F.lit(0)).alias("duplicates_key"),
        F.count("state").alias("unique_states"),
    )
    return metric_rows(row, row.columns)


def quality_metrics(df: DataFrame, spec: TableSpec, wanted: set[str]) -> DataFrame:
    """(metric, value): the measured numbers behind rule status, risks and findings.

    Only the aggregations that yield a wanted metric are planned.
    """
    parts = []
    if wanted & {"full_duplicates", "key_duplicates"}:
        duplicates = duplicate_counts(df, spec.data_columns, spec.keys)
        parts.append(metric_rows(duplicates, ["full_duplicates", "key_duplicates"]))
    if wanted & {"null_keys", "null_cells", "negative_rows"}:
        cells = df.agg(
            F.coalesce(F.sum(null_cells(spec.keys)), F.lit(0)).alias("null_keys"),
            F.coalesce(F.sum(null_cells(spec.data_columns)), F.lit(0)).alias("null_cells"),
            F.count_if(any_negative(*spec.measures)).alias("negative_rows"),
        )
        parts.append(metric_rows(cells, cells.columns))
    if "pincode_conflicts" in wanted:
        parts.append(fd_violation_count(df, "pincode", "district", "pincode_conflicts"))
    if "spelling_variants" in wanted:
        spelling = df.select(normalize_name("district").alias("name"), "district")
        parts.append(fd_violation_count(spelling, "name", "district", "spelling_variants"))
    if "anomalies" in wanted:
        anomalies = state_month_anomaly(
            df, row_total(*spec.total_measures), date=spec.date, formats=spec.date_formats
        ).agg(
            F.count_if(F.col("anomaly_class") != "normal").alias("anomalies")
        )
        parts.append(metric_rows(anomalies, ["anomalies"]))
    return reduce(DataFrame.unionByName, parts)


# Rule name, expectation and the metric that decides it.
RULES = (
    ("Natural key uniqueness", "0 duplicates", "key_duplicates"),
    ("Key null checks", "0 null keys", "null_keys"),
    ("No negative age counts", "0 negative rows", "negative_rows"),
    ("Pincode stability", "minimal conflicts", "pincode_conflicts"),
    ("Trend stability", "explainable spikes", "anomalies"),
)

# Risk id, risk, severity, check and the metric that keeps it open.
RISKS = (
    ("R1", "Duplicate business keys", "High", "key duplicate count", "key_duplicates"),
    ("R2", "Null key fields", "High", "nulls in date/state/district/pincode", "null_keys"),
    (
        "R3",
        "District/state naming inconsistency",
        "Medium",
        "mapping coverage and mismatch rows",
        "spelling_variants",
    ),
    (
        "R4",
        "Pincode referential conflicts",
        "Medium",
        "pincode->district/state nunique",
        "pincode_conflicts",
    ),
    ("R5", "Outlier spikes", "Medium", "z-score and pct-change anomalies", "anomalies"),
)


def _register(metrics: DataFrame, entries, fields, verdict: Column) -> DataFrame:
    """Join a fixed register to its measured values by metric name."""
    chosen = {entry[-1]: entry for entry in entries}
    lookup = F.create_map(
        *[
            x
            for metric, entry in chosen.items()
            for x in (
                F.lit(metric),
                F.struct(*[F.lit(v).alias(f) for f, v in zip(fields, entry)]),
            )
        ]
    )
    found = metrics.filter(F.col("metric").isin(*chosen)).withColumn(
        "entry", lookup[F.col("metric")]
    )
    return found.select("entry.*", F.col("value").alias("current"), verdict)


def rule_status(df: DataFrame, spec: TableSpec) -> DataFrame:
    """(rule, expected, current, pass_flag), with the current value measured."""
    verdict = F.when(F.col("value") == 0, "Pass").otherwise("Fail").alias("pass_flag")
    metrics = quality_metrics(df, spec, {rule[-1] for rule in RULES})
    return _register(metrics, RULES, ("rule", "expected"), verdict)


def risk_register(df: DataFrame, spec: TableSpec) -> DataFrame:
    """(risk_id, risk, severity, check, current, status): open while its metric is not 0."""
    verdict = F.when(F.col("value") == 0, "Closed").otherwise("Open").alias("status")
    metrics = quality_metrics(df, spec, {risk[-1] for risk in RISKS})
    return _register(metrics, RISKS, ("risk_id", "risk", "severity", "check"), verdict)


def findings_table(df: DataFrame, spec: TableSpec) -> DataFrame:
    """(section, details): the closing findings with measured numbers in place."""
    names = ["full_duplicates", "key_duplicates", "null_cells", "negative_rows", "pincode_conflicts"]
    metrics = quality_metrics(df, spec, set(names))
    row = metrics.agg(*[F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in names])
    key = ", ".join(spec.keys)
    issues = F.format_string(
        "Full duplicates=%d; Key duplicates=%d; Total nulls=%d; Negative-age rows=%d",
        "full_duplicates",
        "key_duplicates",
        "null_cells",
        "negative_rows",
    )
    conflicts = F.format_string("Pincode mapped to multiple districts=%d", "pincode_conflicts")
    sections = [
        ("Grain", F.lit(f"{spec.name} counts, one row per {'-'.join(spec.keys)}")),
        ("Natural Key", F.lit(f"({key})")),
        ("Identified issues", issues),
        ("Data inconsistencies", conflicts),
        ("Expected fixes", F.lit("Keep one row per key; enforce contracts; map names; quarantine")),
        ("Modeling direction", F.lit("Join facts on date and location; publish checked rows only")),
    ]
    return row.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(name).alias("section"), details.alias("details"))
                    for name, details in sections
                ]
            )
        )
    )

