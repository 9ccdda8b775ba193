"""Column -> Column functions: parsing, normalising, flags and guarded arithmetic.

All are built-in expressions, so they stay inside whole-stage code generation.
"""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_FIRST = ("d-M-yyyy",)


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c: str | Column, formats: tuple[str, ...] = DAY_FIRST) -> Column:
    """Date from text by the first format that fits; null if none does."""
    return F.coalesce(*[F.try_to_date(as_col(c), f) for f in formats])


def format_key_date(d: str | Column) -> Column:
    return F.date_format(as_col(d), "yyyy-MM-dd")


def month_of(d: str | Column, keep_invalid: bool = False) -> Column:
    """``YYYY-MM`` bucket; ``keep_invalid`` puts null dates in a bucket named NaT."""
    month = F.date_format(as_col(d), "yyyy-MM")
    return F.coalesce(month, F.lit("NaT")) if keep_invalid else month


def strip_decimal_tail(c: str | Column) -> Column:
    """Text without a final ``.0``, which numbers read as floats carry."""
    text = as_col(c)
    return F.when(text.endswith(".0"), F.left(text, F.length(text) - 2)).otherwise(text)


def normalize_pincode(c: str | Column) -> Column:
    """Text pincode without a ``.0`` tail or padding; leading zeros stay."""
    return F.trim(strip_decimal_tail(c))


def is_valid_pincode(c: str | Column) -> Column:
    """True for exactly six digits after the ``.0`` tail is cut; null is false."""
    return F.coalesce(as_col(c).rlike(r"^[0-9]{6}(\.0)?$"), F.lit(False))


def normalize_name(c: str | Column) -> Column:
    return F.lower(F.trim(as_col(c)))


def title_name(c: str | Column) -> Column:
    """Trimmed title case where a capital follows any non-letter, as in South-West.

    ``initcap`` capitalises after blanks only, so a marked blank is set after the
    other non-letters first and taken out again. Most labels need no such mark.
    """
    text = F.trim(as_col(c))
    marked = F.regexp_replace(text, r"([^\p{L}\s])(?=\p{L})", "$1\u0001 ")
    return F.when(
        text.rlike(r"[^\p{L}\s]\p{L}"), F.regexp_replace(F.initcap(marked), "\u0001 ", "")
    ).otherwise(F.initcap(text))


def is_blank(c: str | Column) -> Column:
    """True if the text is empty once trimmed; null gives null, not true."""
    return F.trim(as_col(c).cast("string")) == ""


def to_numeric(c: str | Column, dtype: str = "double") -> Column:
    """Number from text; null if it is none."""
    return as_col(c).try_cast(dtype)


def to_whole(c: str | Column) -> Column:
    """Whole number from text such as ``12`` or ``12.0``; null for ``12.5`` or words."""
    return F.regexp_replace(F.trim(as_col(c)), r"\.0+$", "").try_cast("bigint")


def row_total(*measures: str, dtype: str = "bigint") -> Column:
    """Sum across measures, a null counting as 0."""
    return reduce(add, [F.coalesce(F.col(m).cast(dtype), F.lit(0).cast(dtype)) for m in measures])


def any_negative(*measures: str) -> Column:
    """True if some measure is below zero; nulls do not count."""
    return reduce(or_, [F.coalesce(F.col(m) < 0, F.lit(False)) for m in measures])


def all_non_negative(*measures: str) -> Column:
    """True if every measure is present and at least zero; a null fails."""
    ok = F.lit(True)
    for m in measures:
        ok = ok & F.coalesce(F.col(m) >= 0, F.lit(False))
    return ok


def make_code(prefix: str, n: str | Column, width: int = 4) -> Column:
    """``SCH0001``-style code; numbers longer than ``width`` keep all digits."""
    return F.format_string(f"{prefix}%0{width}d", as_col(n))


def pct_of(a: str | Column, b: str | Column, digits: int = 2) -> Column:
    """100 * a / b, rounded; 0.0 where b is 0 or null."""
    ratio = F.try_divide(as_col(a).cast("double"), as_col(b).cast("double"))
    return F.round(F.coalesce(ratio, F.lit(0.0)) * 100, digits)


def classify(condition: Column, yes: str, no: str) -> Column:
    """Two-way label; a null condition gives ``no``."""
    return F.when(condition, yes).otherwise(no)


def hash_key(*columns: str) -> Column:
    """Stable surrogate key of a natural key: equal on every run and engine.

    Each part carries its length and a null its own mark, so different keys never
    give the same text.
    """
    parts = [F.col(c).cast("string") for c in columns]
    marked = [
        F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts
    ]
    return F.md5(F.concat(*marked))
