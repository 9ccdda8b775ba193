"""The batch run from feed files to reports: bronze, silver, gold, quality reports.

Each layer is written before the next one reads it, so lineage stays short and a
lost executor costs the tasks of one stage only.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.catalog import SPECS, TableSpec
from rollbook.functions.columns import DAY_FIRST, parse_date, row_total
from rollbook.operators import contracts, dedup, gold, keys, profile, reports, sketches, stats
from rollbook.plans.silver import silver_tables, typed_measures, write_silver
from rollbook.sources import readers, snapshots, writers


def run_bronze(
    spark: SparkSession, paths: Sequence[str], name: str, batch_id: int, folder: str
) -> str:
    """Ingest the shards of a feed as one batch and record its audit; returns the table path.

    A shard that cannot be read is recorded as failed with its error; the others are
    loaded, then the first error is raised.
    """
    table = f"{folder}/bronze/{name}"
    started = time.time()
    good, errors, first = [], {}, None
    for path in paths:
        try:
            readers.read_bronze_csv(spark, readers.list_sources(spark, [path]), name)
            good.append(path)
        except Exception as error:  # recorded below, then raised
            errors[path] = str(error)
            first = first or error
    raw = readers.read_bronze_csv(spark, good, name) if good else None
    if raw is not None:
        lineage = writers.with_lineage(raw, F.col("src_file"), batch_id)
        writers.write_batch(lineage, table, batch_id)
        stored = spark.read.parquet(f"{table}/batch_id={batch_id}")
        audit = writers.load_audit(stored, "source", F.col("_corrupt").isNotNull())
    else:
        audit = spark.createDataFrame([], "source string, rows bigint, bad_rows bigint")
    writers.append_audit(audit, f"{folder}/audit/{name}", batch_id, started, time.time(), errors)
    if first:
        raise first
    return table


def bronze_spec(name: str) -> TableSpec:
    """The spec of a feed ingested from files: batches in order, then file order."""
    return replace(SPECS[name], order=("batch_id",) + readers.FILE_ORDER)


def run_silver(
    spark: SparkSession,
    name: str,
    folder: str,
    aliases: dict[str, DataFrame] | None = None,
    publish: bool = False,
) -> tuple[str, str]:
    """Silver valid and quarantine tables of a feed from its bronze table.

    With ``publish`` both become visible at once, as a new version (see ``snapshots``).
    """
    bronze, spec = spark.read.parquet(f"{folder}/bronze/{name}"), bronze_spec(name)
    out = f"{folder}/silver/{name}"
    if not publish:
        return write_silver(bronze, spec, out, aliases)
    snapshots.publish(spark, out, silver_tables(bronze, spec, aliases))
    return snapshots.path_of(spark, out, "valid"), snapshots.path_of(spark, out, "quarantine")


def month_marts(spec: TableSpec, monthly: DataFrame) -> dict[str, DataFrame]:
    """The monthly marts of a feed, from its ``gold.month_sums``: whole or merged from a stream."""
    series = monthly.groupBy("state", "month").agg(F.sum("total").alias("total"))
    marts = {
        "kpi_rollup": gold.month_rollup(monthly, spec.measures),
        "kpi_cube": gold.month_cube(monthly, spec.measures),
        "trend": stats.trend_mart(series),
        "rank": stats.rank_locations(series, 10),
        "anomaly": stats.score_series(series),
        "dense": gold.dense_months(monthly, spec.measures),
    }
    if spec.name == "identity_voter_link":
        marts["linkage"] = gold.linkage_kpi(monthly, ["month", "state"])
    if spec.name == "voter_registry":
        marts["net_change"] = gold.net_change_kpi(monthly, ["month", "state"])
    return marts


def run_gold(
    spark: SparkSession,
    name: str,
    folder: str,
    publish: bool = False,
    schemes: DataFrame | None = None,
) -> dict[str, str]:
    """Dimensions, fact and monthly marts of one feed; returns each table's path.

    Silver is read for the dimensions, the fact and once for all monthly marts, whose sums per
    month, state and district are written first. ``schemes`` (scheme_id, scheme_type) adds the
    funnel of the scheme feed. With ``publish`` silver is read by its latest version, and all
    tables become visible at once.
    """
    spec = SPECS[name]
    stored = f"{folder}/silver/{name}"
    silver = snapshots.read(spark, stored, "valid") if publish else spark.read.parquet(f"{stored}/valid")
    out = f"{folder}/gold/{name}"
    money = [c for c, kind in spec.attributes.items() if kind.startswith("decimal") and c in silver.columns]
    fact = gold.fact_table(silver, [*spec.measures, *money], spec.date, spec.label_keys)
    sums = gold.month_sums(silver, spec.measures, row_total(*spec.total_measures), spec.date)
    writers.refresh_table(sums, f"{folder}/work/{name}/month_sums")
    monthly = spark.read.parquet(f"{folder}/work/{name}/month_sums")
    tables = {
        "dim_date": gold.dim_date(silver),
        "dim_location": gold.dim_location(silver),
        "fact": fact.withColumn("year", F.col("date_key").substr(1, 4).cast("int")),
        **month_marts(spec, monthly),
    }
    if name == "scheme_beneficiary" and schemes is not None:
        tables["funnel"] = gold.scheme_funnel_kpi(fact, schemes)
    parts = {table: ["year"] if table == "fact" else [] for table in tables}
    if publish:
        snapshots.publish(spark, out, {t: (df, parts[t]) for t, df in tables.items()})
        return {table: snapshots.path_of(spark, out, table) for table in tables}
    for table, df in tables.items():
        writers.refresh_table(df, f"{out}/{table}", parts[table])
    return {table: f"{out}/{table}" for table in tables}


def run_stream_gold(spark: SparkSession, spec: TableSpec, folder: str, out: str) -> int:
    """Publish the monthly marts of a streamed feed from the sums that its batches have stored.

    ``folder`` is the one of ``silver_stream``. The work grows with months and locations, not
    with rows; returns the version.
    """
    monthly = gold.merge_month_sums(spark.read.parquet(f"{folder}/monthly"), spec.measures)
    return snapshots.publish(spark, out, {t: (df, ()) for t, df in month_marts(spec, monthly).items()})


def run_profile(
    spark: SparkSession, raw: DataFrame, spec: TableSpec, folder: str
) -> dict[str, DataFrame]:
    """All quality reports of a raw table, each written as CSV under ``folder/reports``.

    The de-duplicated table is written once and read by every report, so each
    report prunes it to the columns it needs.
    """
    work = f"{folder}/profile/{spec.name}"
    raw = typed_measures(raw, spec)
    dedup.dedup_keep_first(raw, spec.keys, spec.order).write.mode("overwrite").parquet(work)
    df = spark.read.parquet(work)
    columns = list(spec.data_columns)
    total = row_total(*spec.total_measures)
    month_start = F.trunc(parse_date(spec.date, spec.date_formats), "month")
    by_month = df.select(month_start.alias("month"), total.alias("total"))
    result = {
        "duplicate_impact": dedup.duplicate_impact(raw, columns, spec.keys, spec.order),
        "missing_profile": profile.missing_profile(df, columns),
        "column_roles": reports.classify_columns(df, spec, exact=False),
        "describe_numeric": profile.describe_numeric(df, spec.measures),
        "key_nulls": contracts.key_null_check(df, spec.keys),
        "contract": contracts.contract_check(df, contracts.contract_rules(spec)),
        "quality_score": contracts.quality_score(
            df, contracts.silver_rules(spec), contracts.rule_severities(spec)
        ),
        "outliers": stats.zscore_outliers(df, spec.keys, total),
        "drift": stats.psi_drift(by_month, "total", "month"),
        "anomalies": stats.state_month_anomaly(df, total, date=spec.date, formats=spec.date_formats),
        "trend": stats.mom_growth(df, total, spec.date, formats=spec.date_formats),
        "months": stats.month_completeness(df, spec.date, spec.date_formats),
        "summary_metrics": reports.summary_metrics(df, spec),
        "rule_status": reports.rule_status(df, spec),
        "risk_register": reports.risk_register(df, spec),
        "findings": reports.findings_table(df, spec),
    }
    for name, report in result.items():
        writers.write_report_csv(report, f"{folder}/reports/{spec.name}/{name}")
    return result


def run_sketches(spark: SparkSession, name: str, folder: str, batch_id: int) -> dict[str, DataFrame]:
    """Add one bronze batch to the feed's running profile; returns ``profile`` and ``history``.

    Only the batch itself is read. Its sketches and its failed rows per rule are stored under
    ``folder/sketch``; profile and history are put together from what all batches have stored.
    """
    spec, base = bronze_spec(name), f"{folder}/sketch/{name}"
    rows = typed_measures(spark.read.parquet(f"{folder}/bronze/{name}/batch_id={batch_id}"), spec)
    found = sketches.column_sketches(rows, spec.data_columns, spec.measures)
    writers.write_batch(found, f"{base}/columns", batch_id)
    rules = contracts.silver_rules(spec)
    failed = contracts.failed_rows(rows, rules)
    writers.write_batch(failed, f"{base}/scores", batch_id)
    merged = sketches.merge_sketches(spark.read.parquet(f"{base}/columns"))
    scores = spark.read.parquet(f"{base}/scores")
    return {
        "profile": sketches.sketch_profile(merged),
        "history": sketches.score_history(scores, contracts.rule_severities(spec)),
    }


def run_coverage(
    enrol: DataFrame,
    demo: DataFrame,
    bio: DataFrame,
    folder: str,
    compat: bool = True,
    formats: tuple[str, ...] = DAY_FIRST,
) -> None:
    """The cross-table coverage summary and the four missing-key lists as CSV."""
    sets = {
        name: keys.conformed_key(df, compat, formats)
        for name, df in {"enrollment": enrol, "demographic": demo, "biometric": bio}.items()
    }
    summary = keys.coverage_summary(enrol, demo, bio, compat, formats)
    writers.write_report_csv(summary, f"{folder}/cross_table_coverage_summary")
    pairs = [
        ("enrollment", "demographic"),
        ("enrollment", "biometric"),
        ("demographic", "enrollment"),
        ("biometric", "enrollment"),
    ]
    for a, b in pairs:
        missing = keys.missing_keys(sets[a], sets[b])
        writers.write_report_csv(missing, f"{folder}/{a}_keys_missing_in_{b}")
