"""Conformed keys, cross-table coverage and set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.functions.columns import (
    DAY_FIRST,
    format_key_date,
    normalize_name,
    normalize_pincode,
    parse_date,
)
from rollbook.operators.reshape import metric_rows
from rollbook.operators.skew import spread, spread_distinct

KEY_COLUMNS = ("date_key", "state_key", "district_key", "pincode_key")


def key_columns(
    df: DataFrame,
    compat: bool = False,
    date_text: bool = True,
    formats: tuple[str, ...] = DAY_FIRST,
) -> DataFrame:
    """The four normalised key columns of each row, before ``distinct``.

    Rows whose date cannot be read go. A null label also removes the row, or,
    with ``compat``, turns into the text ``nan`` as pandas would have it.
    ``date_text=False`` leaves the date a date, where no one reads the key.
    """
    day = parse_date("date", formats)

    def text(c):
        return F.coalesce(c, F.lit("nan")) if compat else c

    keyed = df.select(
        (format_key_date(day) if date_text else day).alias("date_key"),
        text(normalize_name("state")).alias("state_key"),
        text(normalize_name("district")).alias("district_key"),
        text(normalize_pincode("pincode")).alias("pincode_key"),
    )
    return keyed.filter(complete(KEY_COLUMNS))


def complete(columns: Sequence[str]) -> Column:
    """True if no column is null.

    Written as single null tests, unlike ``dropna``: the optimizer then knows the
    columns are not null and adds no second test of its own before a join.
    """
    return reduce(and_, [F.col(c).isNotNull() for c in columns])


def conformed_key(
    df: DataFrame, compat: bool = False, formats: tuple[str, ...] = DAY_FIRST
) -> DataFrame:
    """Distinct normalised (date, state, district, pincode) keys."""
    return key_columns(df, compat, formats=formats).distinct()


def distinct_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """De-duplicated key set of the given columns, null parts left out."""
    return df.select(*columns).filter(complete(columns)).distinct()


def missing_keys(left: DataFrame, right: DataFrame, on: Sequence[str] = KEY_COLUMNS) -> DataFrame:
    """Left keys with no match on the right."""
    return left.join(right, list(on), "left_anti")


def matched_keys(left: DataFrame, right: DataFrame, on: Sequence[str] = KEY_COLUMNS) -> DataFrame:
    """Left keys with a match on the right."""
    return left.join(right, list(on), "left_semi")


def merge_indicator(
    left: DataFrame, right: DataFrame, on: Sequence[str] = KEY_COLUMNS
) -> DataFrame:
    """Left join of two key sets with a ``merge_status`` of ``both`` or ``left_only``."""
    flagged = right.select(*on).withColumn("found_", F.lit(True))
    return left.join(flagged, list(on), "left").select(
        *left.columns,
        F.when(F.col("found_").isNull(), "left_only").otherwise("both").alias("merge_status"),
    )


def key_except(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.subtract(right)


def key_intersect(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.intersect(right)


def key_presence(
    tables: Mapping[str, DataFrame],
    compat: bool = False,
    date_text: bool = True,
    formats: tuple[str, ...] = DAY_FIRST,
    rows: Sequence[int] | None = None,
) -> DataFrame:
    """One row per conformed key over all tables, with an ``in_<table>`` flag each.

    All keys are de-duplicated and matched in a single combined aggregation, in
    place of one distinct per table and one join per pair. ``rows``, the tables' row
    counts where known, keep the rows of a task alike at every size.
    """
    raw = ("date", "state", "district", "pincode")
    tagged = [
        key_columns(spread_distinct(df.select(*raw), n), compat, date_text, formats).select(
            *KEY_COLUMNS, *[F.lit(other == name).alias(f"in_{other}") for other in tables]
        )
        for (name, df), n in zip(tables.items(), rows or [None] * len(tables))
    ]
    return (
        spread(reduce(DataFrame.unionByName, tagged), KEY_COLUMNS, sum(rows or []))
        .groupBy(*KEY_COLUMNS)
        .agg(*[F.max(f"in_{name}").alias(f"in_{name}") for name in tables])
    )


def _only(a: str, b: str):
    return F.count_if(F.col(f"in_{a}") & ~F.col(f"in_{b}"))


def coverage_summary(
    enrol: DataFrame,
    demo: DataFrame,
    bio: DataFrame,
    compat: bool = False,
    formats: tuple[str, ...] = DAY_FIRST,
    rows: Sequence[int] | None = None,
) -> DataFrame:
    """(metric, value): keys of one table missing in another, four ways."""
    tables = {"enroll": enrol, "demo": demo, "bio": bio}
    seen = key_presence(tables, compat, date_text=False, formats=formats, rows=rows)
    pairs = [("enroll", "demo"), ("enroll", "bio"), ("demo", "enroll"), ("bio", "enroll")]
    counts = seen.agg(*[_only(a, b).alias(f"{a}_not_in_{b}") for a, b in pairs])
    return metric_rows(counts, counts.columns)


def coverage_pct(
    enrol: DataFrame,
    demo: DataFrame,
    bio: DataFrame,
    compat: bool = False,
    formats: tuple[str, ...] = DAY_FIRST,
    rows: Sequence[int] | None = None,
) -> DataFrame:
    """One row: enrolment key count and the percentage found in each other table."""
    tables = {"enroll": enrol, "demo": demo, "bio": bio}
    seen = key_presence(tables, compat, date_text=False, formats=formats, rows=rows)
    keys = F.count_if("in_enroll")

    def pct(other):
        missing = _only("enroll", other) / F.greatest(keys, F.lit(1))
        return F.round((1 - missing) * 100, 4).alias(f"enroll_in_{other}_pct")

    return seen.agg(keys.alias("enroll_key_count"), pct("demo"), pct("bio"))


def conformed_wide(
    tables: Mapping[str, tuple[DataFrame, Sequence[str]]],
    formats: tuple[str, ...] = DAY_FIRST,
) -> DataFrame:
    """All tables' measures on one conformed key, null where a table lacks the key.

    Equal to a full outer join of the pre-aggregated tables, but done as one
    union and one combined aggregation: no hot join key. Each table is summed by its raw
    key first, so a date or name is parsed once and not with every row that holds it.
    """
    all_measures = [m for _, measures in tables.values() for m in measures]
    parts = []
    for df, measures in tables.values():
        raw = df.groupBy("date", "state", "district", "pincode").agg(
            *[F.sum(F.col(m).cast("bigint")).alias(m) for m in measures]
        )
        conformed = raw.select(
            parse_date("date", formats).alias("date_key"),
            normalize_name("state").alias("state_key"),
            normalize_name("district").alias("district_key"),
            normalize_pincode("pincode").alias("pincode_key"),
            *measures,
        )
        parts.append(conformed.filter(complete(KEY_COLUMNS)))
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    sums = merged.groupBy(*KEY_COLUMNS).agg(*[F.sum(m).alias(m) for m in all_measures])
    return sums.withColumn("date_key", format_key_date("date_key"))


def union_shards(shards: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL of shards, matched by column name."""
    return reduce(DataFrame.unionByName, shards)


def key_feasibility(tables: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """(table, rows, has_all_keys) per table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table"),
            "rows",
            F.lit(all(k in df.columns for k in keys)).alias("has_all_keys"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)
