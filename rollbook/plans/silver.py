"""Bronze to silver: contract, quarantine, typing, canonical names and one row per key.

The functions up to ``conform`` keep no state, so batch and stream share them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.catalog import TableSpec
from rollbook.functions.columns import normalize_pincode, parse_date, title_name, to_whole
from rollbook.operators.contracts import silver_rules, split_valid_quarantine
from rollbook.operators.dedup import dedup_keep_first
from rollbook.operators.gold import canonicalize
from rollbook.sources import writers


def typed_measures(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Measures as numbers, unreadable ones null, so that the contract can judge them."""
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}

    def whole(m: str) -> Column:
        return F.when(F.col(m) == F.floor(m), F.col(m)).try_cast("bigint")

    return df.withColumns({m: whole(m) if m in numeric else to_whole(m) for m in spec.measures})


def typed_attributes(df: DataFrame, spec: TableSpec) -> dict[str, Column]:
    """The feed's further declared columns that ``df`` has, typed; unreadable values are null."""
    named_date = [c for c in spec.attributes if c in ("start_date", "end_date")]
    return {
        c: parse_date(c, spec.date_formats) if c in named_date else F.col(c).try_cast(kind)
        for c, kind in spec.attributes.items()
        if c in df.columns
    }


def conform(
    valid: DataFrame, spec: TableSpec, aliases: dict[str, DataFrame] | None = None
) -> DataFrame:
    """Typed silver columns of rows that passed the contract.

    ``aliases`` may hold an (alias, canonical) table per label column.
    """
    for label in ("state", "district"):
        table = (aliases or {}).get(label)
        if table is None:
            valid = valid.withColumn(label, title_name(label))
        else:
            valid = canonicalize(valid, label, table)
    typed = valid.withColumns(
        {
            spec.date: parse_date(spec.date, spec.date_formats),
            "pincode": normalize_pincode("pincode"),
            **typed_attributes(valid, spec),
        }
    )
    kept = [*spec.data_columns, *(c for c in spec.attributes if c in valid.columns)]
    return typed.select(*kept, *(c for c in spec.order if c not in kept))


def silver_split(
    bronze: DataFrame, spec: TableSpec, aliases: dict[str, DataFrame] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(conformed valid rows, quarantined raw rows with reasons); no state, no shuffle."""
    valid, quarantine = split_valid_quarantine(typed_measures(bronze, spec), silver_rules(spec))
    return conform(valid, spec, aliases), quarantine


def silver_table(
    bronze: DataFrame, spec: TableSpec, aliases: dict[str, DataFrame] | None = None
) -> DataFrame:
    """Valid rows, one per key: the first to arrive."""
    valid, _ = silver_split(bronze, spec, aliases)
    return dedup_keep_first(valid, spec.keys, spec.order)


def silver_tables(
    bronze: DataFrame,
    spec: TableSpec,
    aliases: dict[str, DataFrame] | None = None,
    partition_by: Sequence[str] = ("month",),
) -> dict[str, tuple[DataFrame, Sequence[str]]]:
    """``valid`` and ``quarantine`` of a bronze table, each with its partition columns."""
    month = F.date_format(spec.date, "yyyy-MM")
    _, quarantine = silver_split(bronze, spec, aliases)
    valid = silver_table(bronze, spec, aliases).withColumn("month", month)
    return {"valid": (valid, partition_by), "quarantine": (quarantine, ())}


def write_silver(
    bronze: DataFrame,
    spec: TableSpec,
    folder: str,
    aliases: dict[str, DataFrame] | None = None,
    partition_by: Sequence[str] = ("month",),
) -> tuple[str, str]:
    """Refresh ``folder/valid`` (by month) and ``folder/quarantine``; return both paths.

    ``bronze`` should be a written table: it is scanned once per output, and the
    quarantine scan ends in the map stage. Rows are not cached.
    """
    for name, (df, parts) in silver_tables(bronze, spec, aliases, partition_by).items():
        writers.write_parts(df, f"{folder}/{name}", parts)
    return f"{folder}/valid", f"{folder}/quarantine"
