"""Values that occur more than once, without shuffling the values.

The 64-bit hashes of a column are counted (partial sums before the exchange, so
a hot value is one row per task); values are looked at only where a hash occurs
twice, which tells true duplicates from collisions. The hashes that occur twice
are staged: there are as many as duplicates, usually none, and their number
decides how they are joined back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.operators.joins import bounded
from paylake.session import scratch_path, sized_shuffle


def duplicate_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, value, n) of the non-NULL values that occur n > 1 times in
    one of ``columns``; values as strings."""
    spark = df.sparkSession
    cells = df.select(F.explode(F.array(*[F.struct(F.lit(k).cast("byte").alias("k"), F.xxhash64(c).alias("h"),
                                                   F.col(c).cast("string").alias("value"))
                                          for k, c in enumerate(columns)])).alias("x")).select("x.*").filter("value IS NOT NULL")
    hashes = cells.select("k", "h")
    path = scratch_path(spark, "repeated-hashes")
    with sized_shuffle(spark, hashes):
        (hashes.groupBy("k", "h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("k", "h")
         .write.parquet(path))
    twice = spark.read.schema("k byte, h long").parquet(path)
    n = twice.count()
    if n == 0:
        return spark.createDataFrame([], "column_name string, value string, n long")
    found = cells.join(bounded(twice, n), ["k", "h"], "left_semi")
    return (found.groupBy("k", "value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
            .select(F.array(*[F.lit(c) for c in columns])[F.col("k").cast("int")].alias("column_name"), "value", "n"))
