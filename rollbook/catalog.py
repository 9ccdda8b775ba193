"""Table specifications and declared schemas.

Every operator takes its key, date and measure columns from a ``TableSpec``
(or as plain arguments), so the same code runs on any count table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.functions.columns import DAY_FIRST

KEY = ("date", "state", "district", "pincode")
LOCATION = ("state", "district", "pincode")
ISO_FIRST = ("yyyy-MM-dd", *DAY_FIRST)


@dataclass(frozen=True)
class TableSpec:
    """Key, date, measures and arrival order of one count table."""

    name: str
    measures: tuple[str, ...]
    keys: tuple[str, ...] = KEY
    date: str = "date"
    order: tuple[str, ...] = ("ingest_seq",)
    # name of the non-negative contract rule in reports
    non_negative_rule: str = "non_negative_measures"
    date_formats: tuple[str, ...] = DAY_FIRST
    # measures that add up to the row's total without counting anyone twice; all if empty
    total_of: tuple[str, ...] = ()

    @property
    def data_columns(self) -> tuple[str, ...]:
        """Columns that came from the feed: the key and the measures."""
        return self.keys + self.measures

    @property
    def total_measures(self) -> tuple[str, ...]:
        return self.total_of or self.measures

    @property
    def attributes(self) -> dict[str, str]:
        """Declared columns of the feed besides key and measures, with their types."""
        declared = SCHEMAS.get(self.name, {})
        return {c: t for c, t in declared.items() if c not in self.data_columns}

    @property
    def label_keys(self) -> tuple[str, ...]:
        """Key columns besides the date and the location, such as a scheme."""
        return tuple(k for k in self.keys if k != self.date and k not in LOCATION)


# Column names and types of the source feeds.
SCHEMAS: dict[str, dict[str, str]] = {
    "enrolment": {
        "date": "string",
        "state": "string",
        "district": "string",
        "pincode": "string",
        "age_0_5": "int",
        "age_5_17": "int",
        "age_18_greater": "int",
    },
    "demographic": {
        "date": "string",
        "state": "string",
        "district": "string",
        "pincode": "string",
        "demo_age_5_17": "int",
        "demo_age_17": "int",
    },
    "biometric": {
        "date": "string",
        "state": "string",
        "district": "string",
        "pincode": "string",
        "bio_age_5_17": "int",
        "bio_age_17": "int",
    },
    "population": {
        "date": "string",
        "state": "string",
        "district": "string",
        "pincode": "string",
        "population_total": "bigint",
        "male": "bigint",
        "female": "bigint",
        "age_0_5": "bigint",
        "age_6_17": "bigint",
        "age_18_plus": "bigint",
    },
    "voter_registry": {
        "date": "string",
        "state": "string",
        "district": "string",
        "pincode": "string",
        "voter_total": "bigint",
        "male_voters": "bigint",
        "female_voters": "bigint",
        "other_voters": "bigint",
        "new_registrations": "bigint",
        "deletions": "bigint",
        "net_change": "bigint",
        "turnout_pct_est": "double",
        "data_source": "string",
        "ingest_ts": "timestamp",
    },
    "identity_voter_link": {
        "date": "string",
        "state": "string",
        "district": "string",
        "pincode": "string",
        "voter_total": "bigint",
        "aadhaar_available": "bigint",
        "aadhaar_voter_linked": "bigint",
        "linkage_pending": "bigint",
        "linkage_rejected": "bigint",
        "linkage_pct": "decimal(5,2)",
        "kyc_pending": "bigint",
        "duplicate_suspected": "bigint",
        "data_source": "string",
        "ingest_ts": "timestamp",
    },
    "scheme_master": {
        "scheme_id": "string",
        "scheme_name": "string",
        "scheme_type": "string",
        "target_group": "string",
        "start_date": "date",
        "end_date": "date",
        "eligibility_rule": "string",
        "active_flag": "int",
    },
    "scheme_beneficiary": {
        "date": "string",
        "start_date": "string",
        "end_date": "string",
        "state": "string",
        "district": "string",
        "pincode": "string",
        "scheme_id": "string",
        "applications_received": "bigint",
        "beneficiaries_approved": "bigint",
        "beneficiaries_rejected": "bigint",
        "beneficiaries_disbursed": "bigint",
        "disbursed_amount": "decimal(18,2)",
        "data_source": "string",
        "ingest_ts": "timestamp",
    },
    "district_master": {
        "State Name": "string",
        "District Name": "string",
    },
}

# Misspelt feed columns and the name they stand for.
COLUMN_ALIASES = {"demo_age_7": "demo_age_17"}

SPECS: dict[str, TableSpec] = {
    "enrolment": TableSpec(
        "enrolment",
        ("age_0_5", "age_5_17", "age_18_greater"),
        non_negative_rule="non_negative_age",
    ),
    "demographic": TableSpec("demographic", ("demo_age_5_17", "demo_age_17")),
    "biometric": TableSpec("biometric", ("bio_age_5_17", "bio_age_17")),
    "population": TableSpec(
        "population",
        ("population_total", "male", "female", "age_0_5", "age_6_17", "age_18_plus"),
        date_formats=ISO_FIRST,
        total_of=("population_total",),
    ),
    "voter_registry": TableSpec(
        "voter_registry",
        (
            "voter_total",
            "male_voters",
            "female_voters",
            "other_voters",
            "new_registrations",
            "deletions",
        ),
        date_formats=ISO_FIRST,
        total_of=("voter_total",),
    ),
    "identity_voter_link": TableSpec(
        "identity_voter_link",
        (
            "voter_total",
            "aadhaar_available",
            "aadhaar_voter_linked",
            "linkage_pending",
            "linkage_rejected",
            "kyc_pending",
            "duplicate_suspected",
        ),
        date_formats=ISO_FIRST,
        total_of=("voter_total",),
    ),
    "scheme_beneficiary": TableSpec(
        "scheme_beneficiary",
        (
            "applications_received",
            "beneficiaries_approved",
            "beneficiaries_rejected",
            "beneficiaries_disbursed",
        ),
        keys=("date", "state", "district", "pincode", "scheme_id"),
        date_formats=ISO_FIRST,
        total_of=("beneficiaries_approved",),
    ),
}


def schema_ddl(name: str, strings_only: bool = False) -> str:
    """DDL text of a declared schema; ``strings_only`` gives the bronze form."""
    return ", ".join(
        f"`{column}` {'string' if strings_only else dtype}"
        for column, dtype in SCHEMAS[name].items()
    )


def conform_schema(
    df: DataFrame, schema: dict[str, str], aliases: dict[str, str] | None = None
) -> DataFrame:
    """Rename aliased columns, then put the declared columns in order and type.

    Values that do not fit the declared type become null; a declared column the
    input lacks is an error, raised when the plan is built.
    """
    aliases = COLUMN_ALIASES if aliases is None else aliases
    renamed = {old: new for old, new in aliases.items() if old in df.columns and new in schema}
    df = df.withColumnsRenamed(renamed)
    missing = [c for c in schema if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing from input: {missing}")
    return df.select(*[F.col(f"`{c}`").try_cast(t).alias(c) for c, t in schema.items()])


def measure_columns(df: DataFrame, keys: tuple[str, ...] = KEY) -> list[str]:
    """Numeric columns outside the key, found from the schema at plan time."""
    return [
        f.name
        for f in df.schema.fields
        if f.name not in keys and isinstance(f.dataType, T.NumericType)
    ]
