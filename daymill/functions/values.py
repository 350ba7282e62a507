"""Money, rates and masking expressions shared by facts and reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(16,2)"

# --- fixed values: accepted phone and e-mail shapes ---
PHONE_PATTERN = r"^(13[0-9]|14[01456879]|15[0-35-9]|16[2567]|17[0-8]|18[0-9]|19[0-35-9])\d{8}$"
EMAIL_PATTERN = r"^[a-zA-Z0-9_-]+@[a-zA-Z0-9_-]+(\.[a-zA-Z0-9_-]+)+$"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: str | Column) -> Column:
    return col(c).cast(MONEY)


def decimal_ratio(numerator: str | Column, denominator: str | Column, digits: int = 2) -> Column:
    """Rounded quotient of amounts, divided as decimals so that halves round up."""
    return F.round(col(numerator) / F.nullif(col(denominator), F.lit(0)), digits)


def ratio(numerator: str | Column, denominator: str | Column, digits: int) -> Column:
    """Rounded quotient of whole numbers as double; null when the denominator is zero or null."""
    top, bottom = col(numerator).cast("double"), col(denominator).cast("double")
    return F.round(top / F.nullif(bottom, F.lit(0.0)), digits)


def mask_name(c: str | Column) -> Column:
    """First character followed by one star."""
    return F.concat(F.substring(col(c), 1, 1), F.lit("*"))


def hash_if_valid(c: str | Column, pattern: str) -> Column:
    """md5 of the text when it has the expected shape, else null."""
    return F.md5(F.when(col(c).rlike(pattern), col(c)))
