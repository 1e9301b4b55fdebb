"""Column expressions that stay in the JVM and, where they filter, reach the file scan."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ACCOUNTS_PER_CLASS = 10_000_000_000  # account codes have twelve digits, the first two are the class

# Markers in the analysis code, and the letters of head office (A) and regions.
HEAD = "HEAD"
DIRECT = "DVML"
HEAD_OFFICE_LETTER = "A"
AREA_LETTERS = ("A", "B", "C", "D", "E", "F", "G", "H")


def account_class(column: str = "account_code") -> Column:
    return F.expr(f"{column} div {ACCOUNTS_PER_CLASS}L")


def in_account_class(column: str, number: int) -> Column:
    """A range, since Parquet has no filter for a division."""
    first = number * ACCOUNTS_PER_CLASS
    return F.col(column).between(first, first + ACCOUNTS_PER_CLASS - 1)


def is_head(column: str = "analysis_code") -> Column:
    return F.col(column).startswith(HEAD)


def is_direct(column: str = "analysis_code") -> Column:
    return F.col(column).startswith(DIRECT)


def area_letter(column: str = "analysis_code") -> Column:
    return F.substring(column, 9, 1)


def month_key(year: Column, month: Column) -> Column:
    return year * 100 + month


def bucket_or_1(column: str = "max_bucket") -> Column:
    return F.coalesce(F.col(column), F.lit(1))


def or_default(column: str, default: int = -1) -> Column:
    return F.coalesce(F.col(column), F.lit(default))


def to_whole(value: Column) -> Column:
    """Round half away from zero to a long; a bare cast would cut the fraction off."""
    return F.round(value, 0).cast("long")


def percent(part: Column, whole: Column) -> Column:
    """Two-digit percentage, NULL where the whole is zero."""
    return F.round(part / F.nullif(whole, F.lit(0)) * 100, 2)


def per_unit(amount: Column, units: Column) -> Column:
    """Two-digit amount per unit, NULL where there are no units."""
    return F.round(amount / F.nullif(units, F.lit(0)), 2)


def as_text(value: Column, decimals: Column) -> Column:
    """A number as plain text without an exponent, with two decimals where ``decimals`` holds."""
    return F.when(decimals, value.cast("decimal(38,2)").cast("string")).otherwise(
        value.cast("decimal(38,0)").cast("string")
    )


def position_in(column: Column, ordered: tuple[str, ...]) -> Column:
    """1-based place of a value in a list, NULL for values that are not listed."""
    return F.nullif(F.array_position(F.array(*[F.lit(v) for v in ordered]), column), F.lit(0)).cast("int")
