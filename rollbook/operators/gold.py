"""Gold: conformed dimensions, star joins, KPIs and roll-ups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.catalog import LOCATION
from rollbook.functions.columns import hash_key, month_of, normalize_name, pct_of, title_name
from rollbook.operators.reshape import settled


def canonicalize(df: DataFrame, column: str, aliases: DataFrame) -> DataFrame:
    """Replace a raw label by its canonical name from (alias, canonical).

    An unlisted label falls back to its trimmed title case. Should an alias be
    listed twice, the smaller canonical name wins, so no row is multiplied.
    """
    unique = aliases.groupBy(F.col("alias").alias("alias_")).agg(
        F.min("canonical").alias("canonical_")
    )
    return (
        df.join(unique, normalize_name(column) == F.col("alias_"), "left")
        .withColumn(column, F.coalesce("canonical_", title_name(column)))
        .drop("alias_", "canonical_")
    )


def date_key(date: str) -> Column:
    return F.date_format(date, "yyyyMMdd").cast("int")


def dim_date(df: DataFrame, date: str = "date") -> DataFrame:
    """Calendar from the first to the last date of ``df``, one row per day."""
    span = df.agg(F.min(date).alias("lo"), F.max(date).alias("hi"))
    return span.select(F.explode(F.sequence("lo", "hi")).alias("date")).select(
        date_key("date").alias("date_key"),
        "date",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month_of_year"),
        F.dayofmonth("date").alias("day_of_month"),
        month_of("date").alias("month"),
    )


def dim_location(df: DataFrame, columns: Sequence[str] = LOCATION) -> DataFrame:
    """Distinct locations with a hash key that needs no numbering over all rows."""
    return (
        df.select(*columns)
        .dropna()
        .distinct()
        .withColumn("location_key", hash_key(*columns))
        .select("location_key", *columns)
    )


def fact_table(
    df: DataFrame, measures: Sequence[str], date: str = "date", labels: Sequence[str] = ()
) -> DataFrame:
    """Fact with dimension keys in place of labels; the keys are computed, not joined.

    ``labels`` are further key columns, such as a scheme, that keep the fact's grain.
    """
    return df.select(
        date_key(date).alias("date_key"),
        hash_key(*LOCATION).alias("location_key"),
        *labels,
        *measures,
    )


def fact_to_dim(fact: DataFrame, dim: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Star join keeping every fact row.

    No broadcast is forced: the measured size of the dimension decides, and
    where it is too large, adaptive execution splits a hot key's partition.
    """
    return fact.join(dim, on, "left")


def active_interval_join(
    fact: DataFrame,
    dim: DataFrame,
    on: str,
    date: str,
    start: str = "start_date",
    end: str = "end_date",
) -> DataFrame:
    """Fact rows whose date lies in the validity interval of their dimension row."""
    return fact.join(dim, on).filter(F.col(date).between(F.col(start), F.col(end)))


def bucketed_interval_join(
    fact: DataFrame,
    dim: DataFrame,
    on: str,
    date: str,
    start: str = "start_date",
    end: str = "end_date",
    days: int = 64,
) -> DataFrame:
    """``active_interval_join`` for keys with very many intervals.

    Time is cut into buckets of ``days``. An interval stands in each bucket that it touches, a
    fact row in the one bucket of its date; they meet on key and bucket, so a key's rows meet
    only the intervals near them, and each pair is there once. Intervals are cut to the span
    of the facts first: one without a near end does not fill buckets that no fact has.
    """

    def bucket(day: Column) -> Column:
        return F.floor(F.datediff(day, F.lit("1970-01-01").cast("date")) / days).cast("int")

    span = fact.select(F.min(date).alias("low"), F.max(date).alias("high"))
    low, high = (span.select(c).scalar() for c in ("low", "high"))
    first = F.greatest(F.col(start).cast("date"), low.cast("date"))
    last = F.least(F.col(end).cast("date"), high.cast("date"))
    near = dim.withColumns({"first_": first, "last_": last}).filter(
        F.col(start).isNotNull() & F.col(end).isNotNull() & (F.col("first_") <= F.col("last_"))
    )
    cut = near.withColumn("bucket_", F.explode(F.sequence(bucket(F.col("first_")), bucket(F.col("last_"))))).drop("first_", "last_")
    dated = fact.withColumn("bucket_", bucket(F.col(date)))
    met = dated.join(cut.hint("merge"), [on, "bucket_"]).filter(F.col(date).between(F.col(start), F.col(end)))
    return met.select(*fact.columns, *[c for c in dim.columns if c != on])


def kpi_rollup(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Totals per month at district, state and national level, with ``level`` 0, 1, 3.

    Rows are combined to the finest level first, so the grouping sets multiply
    that small table and not the raw rows.
    """
    return month_rollup(_monthly(df, ["state", "district"], measures), measures)


def month_rollup(finest: DataFrame, measures: Sequence[str]) -> DataFrame:
    """``kpi_rollup`` of a table (state, district, month, measures) that may hold partial sums."""
    sets = [["month", "state", "district"], ["month", "state"], ["month"]]
    return finest.groupingSets(sets, "month", "state", "district").agg(
        F.grouping_id().cast("bigint").alias("level"), *[F.sum(m).alias(m) for m in measures]
    )


def kpi_cube(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Cross totals over state and month with ``level`` 0 to 3."""
    return month_cube(_monthly(df, ["state"], measures), measures)


def month_cube(finest: DataFrame, measures: Sequence[str]) -> DataFrame:
    """``kpi_cube`` of a table (state, month, measures) that may hold partial sums."""
    finest = finest.groupBy("state", "month").agg(*[F.sum(m).alias(m) for m in measures])
    return finest.cube("state", "month").agg(
        F.grouping_id().cast("bigint").alias("level"), *[F.sum(m).alias(m) for m in measures]
    )


def month_sums(df: DataFrame, measures: Sequence[str], total: Column, date: str = "date") -> DataFrame:
    """(month, state, district, rows, measures, total): the table that all monthly marts follow from."""
    start = F.trunc(date, "month").alias("month_start_")
    sums = df.groupBy("state", "district", start).agg(
        F.count(F.lit(1)).alias("rows"), *[F.sum(m).alias(m) for m in measures], F.sum(total).alias("total")
    )
    return sums.select(month_of("month_start_").alias("month"), "state", "district", "rows", *measures, "total")


def merge_month_sums(partial: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Partial ``month_sums`` of any split of the rows made one: late rows are added to their month."""
    return partial.groupBy("month", "state", "district").agg(
        *[F.sum(c).alias(c) for c in ("rows", *measures, "total")]
    )


def _monthly(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Measures summed per key and month; the month is formatted after the sum."""
    sums = df.groupBy(*keys, F.trunc("date", "month").alias("month_start_")).agg(
        *[F.sum(m).alias(m) for m in measures]
    )
    return sums.select(*keys, month_of("month_start_").alias("month"), *measures)


def linkage_kpi(
    df: DataFrame,
    by: Sequence[str],
    total: str = "voter_total",
    linked: str = "aadhaar_voter_linked",
    others: Sequence[str] = ("linkage_pending", "linkage_rejected", "kyc_pending"),
) -> DataFrame:
    """Linkage per group: summed counts and linked / total as a ratio of sums."""
    sums = df.groupBy(*by).agg(*[F.sum(c).alias(c) for c in (total, linked, *others)])
    return sums.withColumn("linkage_pct", pct_of(linked, total))


def net_change_kpi(
    df: DataFrame,
    by: Sequence[str],
    new: str = "new_registrations",
    deletions: str = "deletions",
    total: str = "voter_total",
    known: Sequence[str] = ("male_voters", "female_voters"),
) -> DataFrame:
    """New, deleted and net registrations per group, and the total not in ``known``."""
    sums = df.groupBy(*by).agg(*[F.sum(c).alias(c) for c in (total, *known, new, deletions)])
    rest = F.col(total)
    for c in known:
        rest = rest - F.col(c)
    return sums.withColumn("net_change", F.col(new) - F.col(deletions)).withColumn(
        "other", F.greatest(rest, F.lit(0).cast("bigint"))
    )


# The funnel's steps and the columns of the feed that hold them.
FUNNEL = {
    "applications": "applications_received",
    "approved": "beneficiaries_approved",
    "disbursed": "beneficiaries_disbursed",
    "amount": "disbursed_amount",
}


def scheme_funnel_kpi(
    fact: DataFrame,
    schemes: DataFrame,
    default_type: str = "Other",
    columns: Mapping[str, str] = FUNNEL,
) -> DataFrame:
    """Applications to approvals to disbursements per scheme type.

    ``columns`` names the fact's column for each step of the funnel.

    The fact is summed per scheme before the join, so a scheme with a large part
    of all rows reaches the join as one row.
    """
    counts = ["applications", "approved", "disbursed", "amount"]
    per_scheme = fact.groupBy("scheme_id").agg(*[F.sum(columns[c]).alias(c) for c in counts])
    typed = per_scheme.join(schemes.select("scheme_id", "scheme_type"), "scheme_id", "left")
    per_type = typed.groupBy(
        F.coalesce("scheme_type", F.lit(default_type)).alias("scheme_type")
    ).agg(*[F.sum(c).alias(c) for c in counts])
    return per_type.select(
        "scheme_type",
        "applications",
        "approved",
        "disbursed",
        F.col("amount").cast("double").alias("amount"),
        pct_of("approved", "applications").alias("approval_pct"),
        pct_of("disbursed", "approved").alias("disbursal_pct"),
        F.round(
            F.coalesce(
                F.try_divide(F.col("amount").cast("double"), F.col("disbursed").cast("double")),
                F.lit(0.0),
            ),
            4,
        ).alias("amount_per_head"),
    )


def location_pool(districts: DataFrame, n: int, base: str = "pincode_base") -> DataFrame:
    """Each district with ``n`` consecutive pincodes from its base."""
    offset = F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("offset_")
    return districts.select("state", "district", base, offset).select(
        "state", "district", (F.col(base) + F.col("offset_")).cast("string").alias("pincode")
    )


def dense_location_month(
    df: DataFrame,
    measures: Sequence[str],
    location: Sequence[str] = ("state", "district"),
    first: str | None = None,
    last: str | None = None,
) -> DataFrame:
    """Every location in every month of the span; gaps are 0.

    The span goes from ``first`` to ``last`` (``yyyy-MM``), by default those of the table; give
    both where a stray date may stretch it. Each location's months lie in one row, so
    neither a cross join nor a join with a month spine takes place.
    """
    return dense_months(settled(_monthly(df, location, measures)), measures, location, first, last)


def dense_months(
    monthly: DataFrame,
    measures: Sequence[str],
    location: Sequence[str] = ("state", "district"),
    first: str | None = None,
    last: str | None = None,
) -> DataFrame:
    """``dense_location_month`` of a table with one row per location and month."""
    known = F.filter(
        F.collect_list(F.struct("month", F.struct(*measures).alias("sums"))),
        lambda x: x["month"].isNotNull(),
    )
    by_location = monthly.groupBy(*location).agg(F.map_from_entries(known).alias("by_month"))

    def edge(given: str | None, pick) -> Column:
        month = F.lit(given) if given else monthly.agg(pick("month")).scalar()
        return F.to_date(F.concat(month, F.lit("-01")))

    months = F.sequence(edge(first, F.min), edge(last, F.max), F.expr("interval 1 month"))
    month = month_of("start").alias("month")
    filled = by_location.select(*location, "by_month", F.explode(months).alias("start")).select(
        *location, month, F.col("by_month")[month_of("start")].alias("sums")
    )
    return filled.select(
        *location, "month", *[F.coalesce(f"sums.{m}", F.lit(0)).alias(m) for m in measures]
    )
