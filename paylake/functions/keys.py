"""Deterministic surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paylake.sources import fixed


def surrogate_key(*cols) -> Column:
    """MD5 hex of the key columns: each cast to string, NULL replaced by a
    fixed token, several columns joined by ``-``. The same value always gives
    the same key, so facts stay joinable when a dimension is rebuilt."""
    parts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"),
                   F.lit(fixed.SURROGATE_NULL_TOKEN))
        for c in cols
    ]
    joined = parts[0] if len(parts) == 1 else F.concat_ws(fixed.SURROGATE_SEPARATOR, *parts)
    return F.md5(joined)
