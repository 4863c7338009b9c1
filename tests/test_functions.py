"""Column expressions on the edge frames (hours, amounts, dates, keys, text)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from paylake.functions import buckets, calendar
from paylake.functions.keys import surrogate_key
from paylake.functions.text import lake_city_key, lower_trim, upper_trim


def test_time_of_day_edges(spark):
    hours = [0, 4, 5, 8, 9, 11, 12, 13, 14, 16, 17, 19, 20, 22, 23, None]
    df = spark.createDataFrame([(h,) for h in hours], "h smallint")
    got = dict(df.select("h", buckets.time_of_day("h").alias("b")).collect())
    assert got[0] == got[4] == got[23] == got[None] == "Late Night"
    assert got[5] == got[8] == "Early Morning"
    assert got[9] == got[11] == "Morning"
    assert got[12] == got[13] == "Lunch"
    assert got[14] == got[16] == "Afternoon"
    assert got[17] == got[19] == "Evening"
    assert got[20] == got[22] == "Night"


def test_amount_bucket_edges(spark):
    amounts = ["0.01", "99.99", "100", "499.99", "500", "1999.99", "2000", "9999.99", "10000", "9999999999.99"]
    df = spark.createDataFrame([(Decimal(a),) for a in amounts] + [(None,)], "a decimal(12,2)")
    got = {str(r[0]) if r[0] is not None else None: r[1]
           for r in df.select("a", buckets.amount_bucket("a")).collect()}
    assert got["99.99"].startswith("Micro") and got["100.00"].startswith("Small")
    assert got["499.99"].startswith("Small") and got["500.00"].startswith("Medium")
    assert got["1999.99"].startswith("Medium") and got["2000.00"].startswith("Large")
    assert got["9999.99"].startswith("Large") and got["10000.00"].startswith("High Value")
    assert got[None].startswith("High Value")


def test_success_flags_null_status(spark):
    df = spark.createDataFrame([("SUCCESS",), ("FAILED",), (None,)], "s string")
    got = df.select("s", buckets.is_success("s"), buckets.is_success_int("s")).collect()
    assert [(r[1], r[2]) for r in got] == [(True, 1), (False, 0), (False, 0)]


def test_calendar_parts(spark):
    days = [dt.date(2023, 1, 1), dt.date(2024, 2, 28), dt.date(2024, 2, 29), dt.date(2024, 3, 31),
            dt.date(2024, 12, 31)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    rows = df.select(
        "d", calendar.date_key("d").alias("k"), F.weekofyear("d").alias("w"),
        calendar.day_of_week_num("d").alias("dow"), calendar.is_month_end("d").alias("me"),
        calendar.month_name("d").alias("mn"), calendar.day_name("d").alias("dn"),
        calendar.is_weekend_day("d").alias("we")).collect()
    by = {r.d: r for r in rows}
    assert by[dt.date(2023, 1, 1)].k == 20230101
    assert by[dt.date(2023, 1, 1)].w == 52 and by[dt.date(2024, 12, 31)].w == 1
    assert by[dt.date(2023, 1, 1)].dow == 0 and by[dt.date(2023, 1, 1)].we is True
    assert by[dt.date(2024, 2, 28)].me is False and by[dt.date(2024, 2, 29)].me is True
    assert by[dt.date(2024, 3, 31)].me is True
    assert by[dt.date(2023, 1, 1)].mn == "January  " and len(by[dt.date(2023, 1, 1)].dn) == 9
    assert by[dt.date(2023, 1, 1)].dn == "Sunday   "


def test_source_festival_list_differs_from_calendar(spark):
    df = spark.createDataFrame([(dt.date(2023, 11, 12),), (dt.date(2024, 6, 17),), (dt.date(2024, 3, 5),)], "d date")
    got = dict(df.select("d", calendar.is_source_festival("d")).collect())
    assert got[dt.date(2023, 11, 12)] and got[dt.date(2024, 6, 17)] and not got[dt.date(2024, 3, 5)]


def test_surrogate_key_is_md5_with_null_token(spark):
    import hashlib
    df = spark.createDataFrame([("MUMBAI",), (None,)], "c string")
    got = [r[0] for r in df.select(surrogate_key("c")).collect()]
    assert got[0] == hashlib.md5(b"MUMBAI").hexdigest()
    assert got[1] == hashlib.md5(b"_dbt_utils_surrogate_key_null_").hexdigest()


def test_text_cleaning_and_lake_key(spark):
    df = spark.createDataFrame([("  navi mumbai ", "Mira-Bhayandar")], "a string, b string")
    r = df.select(upper_trim("a"), lower_trim("a"), lake_city_key("b"), lake_city_key(F.lit("Navi Mumbai"))).first()
    assert tuple(r) == ("NAVI MUMBAI", "navi mumbai", "Mira_Bhayandar", "Navi_Mumbai")
