"""Schemas of the lake file, the raw table, the load log and the fact."""

from __future__ import annotations

from pyspark.sql import types as T

AMOUNT = T.DecimalType(12, 2)

# Columns of one lake file, as the source writes them (schema-on-read).
LAKE_FIELDS = [
    ("txn_id", T.StringType()),
    ("amount_inr", T.DoubleType()),
    ("city", T.StringType()),
    ("merchant_category", T.StringType()),
    ("upi_app", T.StringType()),
    ("payment_type", T.StringType()),
    ("status", T.StringType()),
    ("failure_reason", T.StringType()),
    ("txn_date", T.DateType()),
    ("txn_hour", T.ByteType()),
    ("is_weekend", T.BooleanType()),
    ("is_festival", T.BooleanType()),
    ("sender_upi", T.StringType()),
    ("receiver_upi", T.StringType()),
    ("device_type", T.StringType()),
    ("created_at", T.TimestampType()),
]
LAKE_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in LAKE_FIELDS])
LAKE_COLUMNS = [n for n, _ in LAKE_FIELDS]

# The raw transaction table: fixed schema-on-write, 18 columns.
RAW_FIELDS = [
    ("txn_id", T.StringType()),
    ("amount_inr", AMOUNT),
    ("city", T.StringType()),
    ("state", T.StringType()),
    ("merchant_category", T.StringType()),
    ("upi_app", T.StringType()),
    ("payment_type", T.StringType()),
    ("status", T.StringType()),
    ("failure_reason", T.StringType()),
    ("txn_date", T.DateType()),
    ("txn_hour", T.ShortType()),
    ("is_weekend", T.BooleanType()),
    ("is_festival", T.BooleanType()),
    ("sender_upi", T.StringType()),
    ("receiver_upi", T.StringType()),
    ("device_type", T.StringType()),
    ("created_at", T.TimestampType()),
    ("loaded_at", T.TimestampType()),
]
RAW_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in RAW_FIELDS])
# All other raw columns are NOT NULL.
RAW_NULLABLE = ["failure_reason"]
RAW_COLUMNS = [n for n, _ in RAW_FIELDS]

# One row per source file and load attempt.
LOAD_LOG_SCHEMA = T.StructType([
    T.StructField("object_key", T.StringType(), False),
    T.StructField("row_count", T.LongType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("error_message", T.StringType(), True),
    T.StructField("loaded_at", T.TimestampType(), True),
])

FACT_COLUMNS = [
    "txn_sk", "txn_id", "date_sk", "location_sk", "merchant_sk", "upi_app_sk",
    "payment_type_sk", "amount_inr", "is_success", "is_success_int", "status",
    "time_of_day", "amount_bucket", "is_weekend", "is_festival", "device_type",
    "txn_hour", "txn_year", "txn_month", "created_at",
]
FACT_PARTITION_COLUMNS = ["txn_year", "txn_month"]
