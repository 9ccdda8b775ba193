"""Contracts: rules over rows, quarantine and quality scores."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.catalog import TableSpec
from rollbook.functions.columns import (
    all_non_negative,
    is_blank,
    is_valid_pincode,
    parse_date,
)
from rollbook.operators.profile import null_profile
from rollbook.operators.reshape import metric_rows

SEVERITY_WEIGHT = {"high": 3, "medium": 2, "low": 1}


def present(c: str) -> Column:
    """True if the text is neither null nor blank."""
    return F.coalesce(~is_blank(c), F.lit(False))


def contract_rules(spec: TableSpec) -> dict[str, Column]:
    """The published contract: readable date, six-digit pincode, no negative measure."""
    return {
        "valid_date": parse_date(spec.date, spec.date_formats).isNotNull(),
        "valid_6_digit_pincode": is_valid_pincode("pincode"),
        spec.non_negative_rule: all_non_negative(*spec.measures),
    }


def silver_rules(spec: TableSpec) -> dict[str, Column]:
    """The contract plus the key parts a conformed row needs."""
    return {
        **contract_rules(spec),
        "state_present": present("state"),
        "district_present": present("district"),
    }


def rule_severities(spec: TableSpec) -> dict[str, str]:
    return {
        "valid_date": "high",
        "valid_6_digit_pincode": "medium",
        spec.non_negative_rule: "high",
        "state_present": "high",
        "district_present": "low",
    }


def _fails(rule: Column) -> Column:
    return ~F.coalesce(rule, F.lit(False))


def contract_check(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """(check, failed_rows) for all rules in one scan; a rule that is null fails."""
    counts = df.agg(*[F.count_if(_fails(rule)).alias(name) for name, rule in rules.items()])
    return metric_rows(counts, list(rules), "check", "failed_rows")


def with_reasons(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Adds ``reasons``, the names of the rules a row fails, in rule order."""
    names = F.array(*[F.when(_fails(rule), F.lit(name)) for name, rule in rules.items()])
    return df.withColumn("reasons", F.array_compact(names))


def split_valid_quarantine(
    df: DataFrame, rules: Mapping[str, Column]
) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with reasons); together they are exactly the input."""
    tagged = with_reasons(df, rules)
    valid = tagged.filter(F.size("reasons") == 0).drop("reasons")
    return valid, tagged.filter(F.size("reasons") > 0)


def failed_rows(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row: rows checked, and how many fail each rule."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(_fails(rule)).alias(name) for name, rule in rules.items()],
    )


def quality_score(
    df: DataFrame, rules: Mapping[str, Column], severities: Mapping[str, str]
) -> DataFrame:
    """One row: rows checked and the severity-weighted percentage of rules passed."""
    counts = failed_rows(df, rules)
    weights = {name: SEVERITY_WEIGHT[severities[name]] for name in rules}
    lost = sum(
        F.col(name) / F.greatest("rows", F.lit(1)) * weight for name, weight in weights.items()
    )
    score = (1 - lost / sum(weights.values())) * 100
    return counts.select("rows", F.round(score, 6).alias("quality_score"))


def key_null_check(df: DataFrame, keys) -> DataFrame:
    """(key_column, null_count, null_pct) of the key columns."""
    return null_profile(df, list(keys)).select(
        F.col("column").alias("key_column"), "null_count", F.round("null_pct", 4).alias("null_pct")
    )


# Cross-measure identities of the feeds, as rule name -> condition.
BALANCE_RULES: dict[str, dict[str, str]] = {
    "population": {
        "sexes_sum_to_total": "male + female = population_total",
        "ages_sum_to_total": "age_0_5 + age_6_17 + age_18_plus = population_total",
    },
    "voter_registry": {"net_is_new_minus_deleted": "net_change = new_registrations - deletions"},
    "identity_voter_link": {
        "linked_within_available": "aadhaar_voter_linked <= aadhaar_available",
        "states_sum_to_available": (
            "aadhaar_voter_linked + linkage_pending + linkage_rejected = aadhaar_available"
        ),
    },
    "scheme_beneficiary": {
        "decisions_sum_to_applications": (
            "beneficiaries_approved + beneficiaries_rejected = applications_received"
        ),
        "disbursed_within_approved": "beneficiaries_disbursed <= beneficiaries_approved",
    },
}


def balance_check(df: DataFrame, rules: str | Mapping[str, str]) -> DataFrame:
    """(check, failed_rows) of cross-measure identities, by table name or given conditions."""
    conditions = BALANCE_RULES[rules] if isinstance(rules, str) else rules
    return contract_check(df, {name: F.expr(text) for name, text in conditions.items()})
