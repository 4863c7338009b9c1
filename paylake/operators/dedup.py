"""Keep one version per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Rows ranked first within ``key`` by ``order`` (row_number = 1).

    NULL keys are removed before the shuffle (they would all meet in one
    task). Catalyst turns ``row_number = 1`` into a partial WindowGroupLimit
    before the exchange, so a key repeated many times is cut to one row per
    map task before it is shuffled: a hot key cannot pile up in one reducer.
    The caller should make ``order`` a total order (ties otherwise resolve
    arbitrarily).

    Rows are grouped by the key's hash and the key: both sorts then compare one
    long for nearly every pair of rows. Ids that begin alike would be told
    apart only by comparing the whole strings.
    """
    w = Window.partitionBy(F.xxhash64(key), key).orderBy(*order)
    return (df.filter(F.col(key).isNotNull())
            .withColumn("__rn", F.row_number().over(w))
            .filter(F.col("__rn") == 1)
            .drop("__rn"))


def first_per_key(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Alias of :func:`latest_per_key` named for insert-if-absent (first wins)."""
    return latest_per_key(df, key, order)
