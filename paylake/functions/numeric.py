"""Money and ratio arithmetic with exact decimal semantics."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sums of money keep two decimals; 22 digits hold any sum of 10^10 rows of
# decimal(12,2) values.
MONEY_SUM = "decimal(22,2)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money_sum(c) -> Column:
    return F.sum(_col(c)).cast(MONEY_SUM)


def safe_ratio(num, den) -> Column:
    """``num * 100.0 / nullif(den, 0)``: NULL instead of an error on 0."""
    return _col(num) * F.lit(Decimal("100.0")) / F.nullif(_col(den), F.lit(0))


def percent(num, den, scale: int) -> Column:
    """Percentage rounded half-up (decimal arithmetic), returned as double."""
    return F.round(safe_ratio(num, den), scale).cast("double")


def rounded_avg(c, scale: int = 2) -> Column:
    return F.round(F.avg(_col(c)), scale).cast("double")


def scaled_millions(c, scale: int = 2) -> Column:
    """``round(sum(x) / 1e6, scale)`` on the exact decimal sum."""
    return F.round(F.sum(_col(c)) / F.lit(1000000), scale).cast("double")
