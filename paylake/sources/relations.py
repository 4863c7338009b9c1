"""Constant relations (the dimension seeds and lookup lists) as DataFrames.

Each one is a local relation of a fixed, known row count, so it is safe to
broadcast; ``ROW_BOUND`` records that bound for the join helpers.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.sources import fixed

ROW_BOUND = {
    "city_mapping": len(fixed.CITY_MAPPING),
    "source_city_state": len(fixed.SOURCE_CITIES),
    "merchant_categories": len(fixed.MERCHANT_CATEGORIES),
    "category_ranges": len(fixed.CATEGORY_AMOUNT_RANGES),
    "upi_apps": len(fixed.UPI_APPS),
    "payment_types": len(fixed.PAYMENT_TYPES),
    "calendar_festivals": len(fixed.CALENDAR_FESTIVALS),
    "source_festivals": len(fixed.SOURCE_FESTIVALS),
}


def _date(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def city_mapping(spark: SparkSession) -> DataFrame:
    schema = T.StructType([
        T.StructField("city", T.StringType(), False),
        T.StructField("state", T.StringType(), False),
        T.StructField("region", T.StringType(), False),
        T.StructField("tier", T.StringType(), False),
        T.StructField("is_metro", T.BooleanType(), False),
    ])
    return spark.createDataFrame(fixed.CITY_MAPPING, schema)


def source_city_state(spark: SparkSession) -> DataFrame:
    """City -> state as the loader looks it up: exact (case-sensitive) names;
    for a name listed twice the later entry wins."""
    lookup = {}
    for city, state, *_ in fixed.SOURCE_CITIES:
        lookup[city] = state
    schema = T.StructType([
        T.StructField("city", T.StringType(), False),
        T.StructField("state", T.StringType(), False),
    ])
    return spark.createDataFrame(list(lookup.items()), schema)


def source_city_names() -> list[str]:
    """Distinct source city names in first-listed order."""
    seen: list[str] = []
    for city, *_ in fixed.SOURCE_CITIES:
        if city not in seen:
            seen.append(city)
    return seen


def merchant_categories(spark: SparkSession) -> DataFrame:
    schema = T.StructType([
        T.StructField("category_code", T.StringType(), False),
        T.StructField("category_name", T.StringType(), False),
        T.StructField("category_group", T.StringType(), False),
        T.StructField("is_essential", T.BooleanType(), False),
    ])
    return spark.createDataFrame(fixed.MERCHANT_CATEGORIES, schema)


def category_ranges(spark: SparkSession) -> DataFrame:
    schema = T.StructType([
        T.StructField("category_code", T.StringType(), False),
        T.StructField("min_amount", T.IntegerType(), False),
        T.StructField("max_amount", T.IntegerType(), False),
    ])
    return spark.createDataFrame(fixed.CATEGORY_AMOUNT_RANGES, schema)


def upi_apps(spark: SparkSession) -> DataFrame:
    schema = T.StructType([
        T.StructField("app_name", T.StringType(), False),
        T.StructField("company", T.StringType(), False),
        T.StructField("market_share_pct", T.DoubleType(), False),
    ])
    return (spark.createDataFrame(fixed.UPI_APPS, schema)
            .withColumn("market_share_pct", F.col("market_share_pct").cast("decimal(3,1)")))


def payment_types(spark: SparkSession) -> DataFrame:
    schema = T.StructType([
        T.StructField("type_code", T.StringType(), False),
        T.StructField("type_name", T.StringType(), False),
    ])
    return spark.createDataFrame(fixed.PAYMENT_TYPES, schema)


def _festivals(spark: SparkSession, rows) -> DataFrame:
    schema = T.StructType([
        T.StructField("festival_date", T.DateType(), False),
        T.StructField("festival_name", T.StringType(), False),
    ])
    return spark.createDataFrame([(_date(d), n) for d, n in rows], schema)


def calendar_festivals(spark: SparkSession) -> DataFrame:
    return _festivals(spark, fixed.CALENDAR_FESTIVALS)


def source_festivals(spark: SparkSession) -> DataFrame:
    return _festivals(spark, fixed.SOURCE_FESTIVALS)


def source_festival_dates() -> list[dt.date]:
    return [_date(d) for d, _ in fixed.SOURCE_FESTIVALS]


def date_spine(spark: SparkSession, start: str = fixed.CALENDAR_START,
               end: str = fixed.CALENDAR_END) -> DataFrame:
    """One row per day in ``[start, end)``, gap-free."""
    return spark.range(1).select(
        F.explode(F.sequence(F.to_date(F.lit(start)),
                             F.date_sub(F.to_date(F.lit(end)), 1),
                             F.expr("INTERVAL 1 DAY"))).alias("date_day"))
