"""Outliers, drift, trends and anomalies."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollbook.functions.columns import DAY_FIRST, classify, parse_date
from rollbook.operators.profile import group_month_total, monthly_rows, monthly_total
from rollbook.operators.quantiles import exact_quantiles, quantiles_of_counts, value_counts
from rollbook.operators.reshape import let, settled


def zscore_global(df: DataFrame, value: Column, name: str = "z") -> DataFrame:
    """Adds (value - mean) / sample std over the whole table; null if the std is 0 or null.

    Mean and std come from a one-row scalar subquery: no window over all rows
    and no join.
    """
    stats = df.agg(F.avg(value).alias("mu"), F.stddev_samp(value).alias("sd"))
    s = stats.select(F.struct("mu", "sd")).scalar()
    return df.withColumn(
        name, (value - s.getField("mu")) / F.nullif(s.getField("sd"), F.lit(0.0))
    )


def zscore_outliers(
    df: DataFrame, keys: Sequence[str], total: Column, k: float = 3.0, name: str = "total"
) -> DataFrame:
    """Rows whose total lies more than ``k`` sample standard deviations from the mean."""
    scored = zscore_global(df.select(*keys, total.alias(name)), F.col(name))
    return scored.filter(F.abs("z") > k)


def zscore_by(df: DataFrame, value: str, group: str, name: str = "z") -> DataFrame:
    """Adds the z-score of ``value`` within its group, for already aggregated series."""
    w = Window.partitionBy(group)
    sd = F.nullif(F.stddev_samp(value).over(w), F.lit(0.0))
    return df.withColumn(name, (F.col(value) - F.avg(value).over(w)) / sd)


def pct_change(
    df: DataFrame, value: str, group: str, order: str, name: str = "pct_change"
) -> DataFrame:
    """Adds the relative change against the previous row of the group; null after a 0."""
    previous = F.lag(value).over(Window.partitionBy(group).orderBy(order))
    return df.withColumn(
        name, F.try_divide(F.col(value).cast("double"), previous.cast("double")) - 1
    )


def mom_growth(
    df: DataFrame,
    total: Column,
    date: str = "date",
    last_n: int | None = None,
    formats: tuple[str, ...] = DAY_FIRST,
) -> DataFrame:
    """(month, total, mom_growth_pct) of the national series, optionally its last months."""
    monthly = monthly_total(df, total, date, formats=formats)
    # one row per calendar month remains, so a single ordered window is small
    previous = F.lag("total").over(Window.orderBy("month"))
    growth = F.try_divide(F.col("total").cast("double"), previous.cast("double")) - 1
    trend = monthly.withColumn("mom_growth_pct", F.round(growth * 100, 6))
    return trend.orderBy(F.desc("month")).limit(last_n) if last_n else trend


def state_month_anomaly(
    df: DataFrame,
    total: Column,
    group: str = "state",
    date: str = "date",
    pct: float = 0.6,
    z: float = 3.0,
    formats: tuple[str, ...] = DAY_FIRST,
) -> DataFrame:
    """(group, month, total, pct_change, z, anomaly_class).

    With sample std a series of n months has |z| at most (n - 1) / sqrt(n), so at
    z = 3 a series of ten months or fewer cannot flag; both limits are parameters.
    """
    return score_series(group_month_total(df, total, group, date, formats), group, pct, z)


def score_series(
    series: DataFrame, group: str = "state", pct: float = 0.6, z: float = 3.0
) -> DataFrame:
    """Anomaly class of each row of a (group, month, total) series."""
    scored = zscore_by(pct_change(series, "total", group, "month"), "total", group)
    suspicious = (F.abs("pct_change") > pct) & (F.abs("z") > z)
    return scored.select(
        group,
        "month",
        "total",
        F.round("pct_change", 6).alias("pct_change"),
        F.round("z", 6).alias("z"),
        classify(suspicious, "likely_data_issue", "normal").alias("anomaly_class"),
    )


def trend_mart(series: DataFrame, group: str = "state", value: str = "total") -> DataFrame:
    """Adds a three-month moving average and a running total to a (group, month) series."""
    w = Window.partitionBy(group).orderBy("month")
    return series.select(
        group,
        "month",
        value,
        F.round(F.avg(value).over(w.rowsBetween(-2, 0)), 6).alias("moving_avg_3"),
        F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cumulative"),
    )


def rank_locations(
    series: DataFrame, n: int, group: str = "state", value: str = "total", best: bool = True
) -> DataFrame:
    """Best (or worst) ``n`` groups of each month, ties sharing a rank."""
    order = F.desc(value) if best else F.asc(value)
    ranked = series.withColumn(
        "rank", F.rank().over(Window.partitionBy("month").orderBy(order)).cast("bigint")
    )
    return ranked.filter(F.col("rank") <= n)


def _even_probs(bins: int) -> list[float]:
    """0 to 1 in even steps, each a multiple of the step as in numpy's linspace."""
    return [i * (1 / bins) for i in range(bins)] + [1.0]


def decile_edges(df: DataFrame, value: str, bins: int = 10) -> DataFrame:
    """(idx, edge): distinct linear quantiles, ascending, at most ``bins`` + 1 of them."""
    quantiles = exact_quantiles(df, value, _even_probs(bins))
    edges = quantiles.agg(F.array_sort(F.collect_set("quantile")).alias("edges"))
    return edges.select(F.posexplode("edges").alias("idx", "edge"))


def _bin_of(value: str) -> Column:
    """1-based bin of a value between the sorted edges in ``edges``; null outside them."""
    v = F.col(value).cast("double")

    def place(e: Column) -> Column:
        last = F.size(e) - 1
        reached = F.size(F.filter(e, lambda x: x <= v))
        inside = (v >= F.get(e, F.lit(0))) & (v <= F.get(e, last))
        return F.when(inside, F.least(reached, last))

    return let(F.col("edges"), place)


def histogram(df: DataFrame, value: str, base: DataFrame, bins: int = 10) -> DataFrame:
    """(bin, lower_edge, upper_edge, n) of ``value`` over the decile edges of ``base``.

    Bins are half-open and the last one is closed; values outside are dropped and
    empty bins are kept with 0.
    """
    edges = settled(exact_quantiles(base, value, _even_probs(bins)).agg(F.array_sort(F.collect_set("quantile")).alias("edges")))
    edged = df.select(value).withColumn("edges", edges.scalar())
    binned = edged.select(_bin_of(value).alias("bin")).filter(F.col("bin").isNotNull())
    counts = binned.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    bounds = edges.select(F.posexplode("edges").alias("at", "lower_edge"), "edges").select(
        (F.col("at") + 1).alias("bin"), "lower_edge", F.get("edges", F.col("at") + 1).alias("upper_edge")
    )
    return (
        bounds.filter(F.col("upper_edge").isNotNull())
        .join(counts, "bin", "left")
        .select("bin", "lower_edge", "upper_edge", F.coalesce("n", F.lit(0)).alias("n"))
    )


def psi_drift(
    df: DataFrame, value: str, period: str, bins: int = 10, include_base: bool = False
) -> DataFrame:
    """(period, psi): population stability index of each period against the first one.

    The source is read once, into counts of each value per period (see ``settled``). The
    first period, its deciles and the bins of all periods come from those counts; bins
    are summed side by side, so no period x bin grid has to be built and one row
    per period is left. Null psi if fewer than three distinct edges exist.
    """
    counts = settled(value_counts(df.filter(F.col(period).isNotNull()), value, period))
    first = counts.agg(F.min(period)).scalar()
    base = quantiles_of_counts(counts.filter(F.col(period) == first), _even_probs(bins))
    edges = settled(base.agg(F.array_sort(F.collect_set("quantile")).alias("edges")))
    binned = counts.withColumn("edges", edges.scalar()).select(period, "n", _bin_of("v").alias("bin"))
    n_edges = edges.select(F.size("edges")).scalar()
    counts = binned.groupBy(period).agg(
        *[
            F.coalesce(F.sum(F.when(F.col("bin") == b, F.col("n"))), F.lit(0)).alias(f"n{b}")
            for b in range(1, bins + 1)
        ],
    )

    total = F.greatest(reduce(add, [F.col(f"n{b}") for b in range(1, bins + 1)]), F.lit(1))
    shares = counts.select(
        period,
        n_edges.alias("n_edges"),
        *[F.greatest(F.col(f"n{b}") / total, F.lit(1e-6)).alias(f"a{b}") for b in range(1, bins + 1)],
    )
    # one row per period remains, so a single ordered window is small
    ordered = Window.orderBy(period).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    expected = shares.select(
        "*",
        F.row_number().over(Window.orderBy(period)).alias("position"),
        *[F.first(f"a{b}").over(ordered).alias(f"e{b}") for b in range(1, bins + 1)],
    )
    terms = [
        F.when(
            F.lit(b) < F.col("n_edges"),
            (F.col(f"a{b}") - F.col(f"e{b}")) * F.ln(F.col(f"a{b}") / F.col(f"e{b}")),
        ).otherwise(0.0)
        for b in range(1, bins + 1)
    ]
    psi = F.when(F.col("n_edges") >= 3, F.round(reduce(add, terms), 6))
    result = expected if include_base else expected.filter("position > 1")
    return result.select(period, psi.alias("psi"))


def month_completeness(
    df: DataFrame, date: str = "date", formats: tuple[str, ...] = DAY_FIRST
) -> DataFrame:
    """(month, row_count, min_date, max_date): every calendar month, missing ones with 0."""
    days = (
        df.select(parse_date(date, formats).alias("d"))
        .filter(F.col("d").isNotNull())
        .groupBy(F.trunc("d", "month").alias("month_start"))
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.min("d").alias("min_date"),
            F.max("d").alias("max_date"),
        )
    )
    span = days.agg(F.min("month_start").alias("lo"), F.max("month_start").alias("hi"))
    spine = span.select(
        F.explode(F.sequence("lo", "hi", F.expr("interval 1 month"))).alias("month_start")
    )
    return spine.join(days, "month_start", "left").select(
        F.date_format("month_start", "yyyy-MM").alias("month"),
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
        "min_date",
        "max_date",
    )


def freshness(
    df: DataFrame,
    as_of: str,
    group: str = "state",
    date: str = "date",
    formats: tuple[str, ...] = DAY_FIRST,
) -> DataFrame:
    """(group, max_date, lag_days): age of the newest date at ``as_of`` (ISO text)."""
    return (
        df.filter(F.col(group).isNotNull())
        .groupBy(group)
        .agg(F.max(parse_date(date, formats)).alias("max_date"))
        .withColumn(
            "lag_days", F.datediff(F.lit(as_of).cast("date"), "max_date").cast("bigint")
        )
    )


def last_n_months(
    df: DataFrame, n: int, date: str = "date", formats: tuple[str, ...] = DAY_FIRST
) -> DataFrame:
    """(month, row_count) of the last ``n`` months that have rows."""
    return monthly_rows(df, date, formats=formats).orderBy(F.desc("month")).limit(n)


def preview(df: DataFrame, order: Sequence[str], n: int = 10) -> DataFrame:
    """First ``n`` rows in the given order."""
    return df.orderBy(*order).limit(n)


def sample(df: DataFrame, key: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """``n`` rows picked by a seeded hash of the key: repeatable under any partitioning."""
    return df.orderBy(F.xxhash64(*key, F.lit(seed)), *key).limit(n)


def top_n(df: DataFrame, by: str, n: int, tie_break: Sequence[str]) -> DataFrame:
    """Largest ``n`` rows by a column."""
    return df.orderBy(F.desc_nulls_last(by), *tie_break).limit(n)
