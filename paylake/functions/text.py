"""String cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paylake.sources import fixed


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def upper_trim(c) -> Column:
    """``upper(trim(x))`` — trim strips blanks only."""
    return F.upper(F.trim(_col(c)))


def lower_trim(c) -> Column:
    """``lower(trim(x))``."""
    return F.lower(F.trim(_col(c)))


def lake_city_key(c) -> Column:
    """City folder name of the lake: blanks and hyphens become underscores."""
    chars = fixed.LAKE_KEY_CHARS
    return F.translate(_col(c), chars, "_" * len(chars))
