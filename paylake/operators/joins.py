"""Joins with a size-checked broadcast side.

A side is broadcast only when its row count has a proven upper bound — a
constant relation, or a relation derived from one by operations that cannot
grow it (filter, semi/inner join on its unique key) — and that bound is below
``BROADCAST_ROW_LIMIT``. Anything else is left to the planner: with AQE on,
Spark starts a shuffle join and converts it at run time only if the measured
size is small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows a broadcast side may hold: the dimension seeds here are <= 731 rows;
# a million narrow rows stay well within a few tens of MB per executor.
BROADCAST_ROW_LIMIT = 1_000_000


def bounded(df: DataFrame, row_bound: int | None) -> DataFrame:
    """Hint a broadcast if ``row_bound`` is known and under the limit."""
    if row_bound is not None and row_bound <= BROADCAST_ROW_LIMIT:
        return F.broadcast(df)
    return df


def lookup_left(df: DataFrame, small: DataFrame, row_bound: int | None, left_key: str,
                right_key: str, columns: list[str]) -> DataFrame:
    """Left join ``df`` to a keyed lookup and keep ``columns`` of it.

    The lookup key must be unique, so the join never multiplies rows."""
    right = small.select(F.col(right_key).alias("__lk"), *columns)
    out = df.join(bounded(right, row_bound), df[left_key] == right["__lk"], "left")
    return out.drop("__lk")
