"""Share of total over already-aggregated rows."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_share(grouped: DataFrame, count_col: str, out_col: str, scale: int = 1) -> DataFrame:
    """Add ``round(count * 100.0 / sum(count) over (), scale)``.

    The total is a scalar subquery over the aggregated rows (one row per
    group), so no fact row is pulled into a single partition and no window
    over the whole set runs; Spark evaluates the subquery once.
    """
    total = grouped.agg(F.sum(count_col).alias("__total")).scalar()
    return grouped.withColumn(
        out_col,
        F.round(F.col(count_col) * F.lit(Decimal("100.0")) / total, scale).cast("double"))
