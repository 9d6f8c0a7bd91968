"""Column functions shared by the models. All return built-in Spark column
expressions (JVM side, inside whole-stage codegen); no Python UDFs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The placeholder a NULL key part hashes as in surrogate keys,
# and the separator between key parts. Both must equal the reference's
# hashing for keys to match.
SURROGATE_KEY_NULL = "_dbt_utils_surrogate_key_null_"
SURROGATE_KEY_SEPARATOR = "-"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def title_trimmed(c: str | Column) -> Column:
    """initcap(trim(c)): blanks trimmed, each blank-separated word
    capitalised, the rest lower-cased ('mcCARTHY o-neil' -> 'Mccarthy O-neil')."""
    return F.initcap(F.trim(_col(c)))


def lower_trimmed(c: str | Column) -> Column:
    return F.lower(F.trim(_col(c)))


def upper_trimmed(c: str | Column) -> Column:
    return F.upper(F.trim(_col(c)))


def blank_as_null_lower(c: str | Column) -> Column:
    """nullif(lower(trim(c)), '')."""
    return F.nullif(lower_trimmed(c), F.lit(""))


def dollars_to_cents(c: str | Column) -> Column:
    """cast(round(c * 100) as bigint). Feed decimals: a double 1.005 rounds
    to 100 cents, decimal 1.005 to 101 (HALF_UP on the exact value)."""
    return F.round(_col(c) * 100).cast("bigint")


def surrogate_key(*cols: str | Column) -> Column:
    """md5 hex of the key parts cast to string, NULL parts replaced by a
    fixed placeholder, joined by '-'. Stable across engines."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(SURROGATE_KEY_NULL)) for c in cols]
    return F.md5(F.concat_ws(SURROGATE_KEY_SEPARATOR, *parts))


def null_safe_differs(a: Column, b: Column) -> Column:
    """True when a and b differ, NULL compared as a value (never NULL)."""
    return ~a.eqNullSafe(b)
