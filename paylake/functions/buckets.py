"""CASE-style labels and flags (all plain ``when`` chains)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paylake.sources import fixed


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_success(status="status") -> Column:
    """``status = 'SUCCESS'``; a NULL status is false."""
    return F.when(_col(status) == F.lit("SUCCESS"), F.lit(True)).otherwise(F.lit(False))


def is_success_int(status="status") -> Column:
    return F.when(_col(status) == F.lit("SUCCESS"), F.lit(1)).otherwise(F.lit(0))


def time_of_day(hour="txn_hour") -> Column:
    """Hour-of-day bucket; hours outside every range (and NULL) are late night."""
    h = _col(hour)
    expr = None
    for lo, hi, label in fixed.TIME_OF_DAY_BUCKETS:
        cond = h.between(lo, hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(fixed.LATE_NIGHT))


def amount_bucket(amount="amount_inr") -> Column:
    """Size bucket by exclusive upper bounds; the top bucket also takes NULL."""
    a = _col(amount)
    expr = None
    for bound, label in fixed.AMOUNT_BUCKETS:
        cond = a < F.lit(bound)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(fixed.HIGH_VALUE))


def season(month) -> Column:
    m = _col(month)
    expr = None
    for months, label in fixed.SEASONS:
        cond = m.isin(*months)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(fixed.DEFAULT_SEASON))


def fiscal_quarter(month) -> Column:
    m = _col(month)
    expr = None
    for lo, hi, label in fixed.FISCAL_QUARTERS:
        cond = m.between(lo, hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(fixed.DEFAULT_FISCAL_QUARTER))


def population_bucket(tier="tier") -> Column:
    t = _col(tier)
    expr = None
    for value, label in fixed.POPULATION_BUCKETS:
        cond = t == F.lit(value)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(fixed.DEFAULT_POPULATION_BUCKET))


def day_type_label(flag="is_weekend") -> Column:
    return F.when(_col(flag), F.lit("Weekend")).otherwise(F.lit("Weekday"))
