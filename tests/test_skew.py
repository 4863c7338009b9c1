"""Hot keys: one txn_id or one city holding a third of all rows."""

import datetime as dt
import os
from decimal import Decimal

from pyspark.sql import functions as F

from paylake import schema
from paylake.plans import models
from paylake.sources import lake


def test_hot_txn_id_dedup_is_partial_before_shuffle(spark):
    n = 3000
    t0 = dt.datetime(2024, 1, 1)
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("T"), F.col("id").cast("string")))
        .alias("txn_id"),
        (F.col("id") % 1000 + 1).cast("decimal(12,2)").alias("amount_inr"),
        F.lit("Mumbai").alias("city"), F.lit("Maharashtra").alias("state"), F.lit("retail").alias("merchant_category"),
        F.lit("PhonePe").alias("upi_app"), F.lit("p2m").alias("payment_type"), F.lit("SUCCESS").alias("status"),
        F.lit(None).cast("string").alias("failure_reason"), F.lit(dt.date(2024, 1, 1)).alias("txn_date"),
        F.lit(1).cast("smallint").alias("txn_hour"), F.lit(False).alias("is_weekend"), F.lit(False).alias("is_festival"),
        F.lit("a@x").alias("sender_upi"), F.lit("b@y").alias("receiver_upi"), F.lit("Android").alias("device_type"),
        (F.lit(t0) + F.make_interval(secs=F.col("id").cast("decimal(18,6)"))).alias("created_at"),
        F.lit(t0).alias("loaded_at"),
    ).select(*schema.RAW_COLUMNS).repartition(8)
    stg = models.stg_transactions(df)
    got = {r.txn_id: r.amount_inr for r in stg.collect()}
    assert len(got) == 1 + (n - n // 3)
    assert got["HOT"] == Decimal(((n - 3) % 1000) + 1)  # the newest HOT row (id = 2997)
    plan = stg._jdf.queryExecution().executedPlan().toString()
    # the group limit runs on both sides of the exchange
    assert plan.count("WindowGroupLimit") >= 2


def test_hot_city_folder_is_split_across_writers(spark, tmp):
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        n = 30000
        rows = spark.range(n).select(
            F.concat(F.lit("T"), F.col("id").cast("string")).alias("txn_id"),
            F.lit(10.0).alias("amount_inr"),
            F.when(F.col("id") % 3 == 0, F.lit("Mumbai"))
             .otherwise(F.concat(F.lit("City"), (F.col("id") % 50).cast("string"))).alias("city"),
            *[F.lit(None).cast(t).alias(c) for c, t in schema.LAKE_FIELDS
              if c not in ("txn_id", "amount_inr", "city", "txn_date")],
            F.lit(dt.date(2024, 1, 15)).alias("txn_date"),
        ).select(*schema.LAKE_COLUMNS)
        root = f"{tmp}/lake"
        lake.write_lake(rows, root)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    hot = f"{root}/year=2024/month=01/city_part=Mumbai"
    files = [f for f in os.listdir(hot) if f.endswith(".parquet")]
    assert len(files) > 1
    assert lake.scan_lake(spark, root).filter("city = 'Mumbai'").count() == n // 3


def test_hot_month_of_the_fact_is_split_across_writers(spark, tmp):
    from paylake.operators.upsert import upsert
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        n = 30000
        rows = spark.range(n).select(
            F.md5(F.col("id").cast("string")).alias("txn_sk"),
            (F.col("id") % 1000).cast("decimal(12,2)").alias("amount_inr"),
            F.lit(2024).alias("txn_year"),
            F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise((F.col("id") % 11 + 2).cast("int")).alias("txn_month"),
        )
        path = f"{tmp}/fact"
        assert upsert(spark, rows, path) == "full"
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    hot = f"{path}/txn_year=2024/txn_month=1"
    assert len([f for f in os.listdir(hot) if f.endswith(".parquet")]) > 1
    assert spark.read.parquet(path).count() == n
