"""Stand-in input: transaction rows in the lake-file schema, built from the
driver's test tables (``orders`` joined with ``customer``).

This module only shapes test-table rows into the schema the pipeline reads;
it does none of the pipeline's work. Its rule (per order key ``k``):

* ``txn_id``  'TXN' + k left-padded to 16 digits
* ``amount``  cents of ``o_totalprice`` integer-divided by 1/10/100/1000 for
  k % 4 = 0/1/2/3, in rupees
* ``city``    the distinct source cities in listed order, index o_custkey % 98;
  index 97 is a city with no dimension row
* category by o_custkey % 15, app by order priority, payment type by market
  segment, status by k % 100, reason by k % 7, hour k % 24, device by k % 20/4
* ``txn_date`` 2023-01-01 + (days since 1995-01-01 of the order date) % 731
* plus dirty copies: k % 50 = 0 a later, re-cased second version; k % 500 = 0
  a copy with a new id and amount 0; k % 500 = 1 a copy without id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake import schema
from paylake.functions.calendar import is_source_festival, is_weekend_day
from paylake.sources import fixed, relations

UNMAPPED_CITY = "Unmapped Town"
DATE_ORIGIN = "1995-01-01"
DAYS = 731
BASE, SECOND, ZERO, NO_ID = range(4)  # a row and the kinds of its dirty copies


def _pick(values: list, index: Column) -> Column:
    """``values[index]`` for a 0-based integer index column."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + F.lit(1))


def lake_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in the lake-file schema (16 columns), dirty copies included."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_mktsegment")
    src = orders.join(customer, orders.o_custkey == customer.c_custkey, "inner")

    k = F.col("o_orderkey")
    ck = F.col("o_custkey")
    cents = F.round(F.col("o_totalprice") * F.lit(100)).cast("bigint")
    divisor = _pick([1, 10, 100, 1000], k % 4).cast("bigint")
    amount = (cents - F.pmod(cents, divisor)) / divisor  # exact integer division
    rupees = (amount.cast("bigint").cast("decimal(20,0)") * F.lit(0.01).cast("decimal(3,2)")).cast(schema.AMOUNT)

    cities = relations.source_city_names() + [UNMAPPED_CITY]
    codes = [c[0] for c in fixed.MERCHANT_CATEGORIES]
    status = (F.when(k % 100 < 94, F.lit("SUCCESS"))
              .when(k % 100 < 99, F.lit("FAILED")).otherwise(F.lit("PENDING")))
    payment = (F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit("p2p"))
               .when(F.col("c_mktsegment") == "MACHINERY", F.lit("bill_payment"))
               .when(F.col("c_mktsegment") == "FURNITURE", F.lit("recharge"))
               .otherwise(F.lit("p2m")))
    txn_date = F.date_add(F.to_date(F.lit("2023-01-01")),
                          F.pmod(F.datediff(F.to_date("o_orderdate"), F.to_date(F.lit(DATE_ORIGIN))),
                                 F.lit(DAYS)).cast("int"))
    device = (F.when(k % 20 == 0, F.lit("Web")).when(k % 4 == 1, F.lit("iOS"))
              .otherwise(F.lit("Android")))

    # one pass over the joined rows: each is exploded into its copies, so that
    # the tables are read and joined once, not once for every kind of copy
    copies = (F.when(k % 500 == 0, F.array(F.lit(BASE), F.lit(SECOND), F.lit(ZERO)))
              .when(k % 50 == 0, F.array(F.lit(BASE), F.lit(SECOND)))
              .when(k % 500 == 1, F.array(F.lit(BASE), F.lit(NO_ID)))
              .otherwise(F.array(F.lit(BASE))))
    src = src.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority",
                     "c_mktsegment", F.explode(copies).alias("_copy"))

    base = src.select(
        "_copy",
        F.concat(F.lit(fixed.TXN_PREFIX), F.lpad(k.cast("string"), 16, "0")).alias("txn_id"),
        rupees.cast("double").alias("amount_inr"),
        _pick(cities, F.pmod(ck, F.lit(len(cities)))).alias("city"),
        _pick(codes, F.pmod(ck, F.lit(len(codes)))).alias("merchant_category"),
        _pick(fixed.SOURCE_APP_NAMES,
              F.substring("o_orderpriority", 1, 1).cast("int") - F.lit(1)).alias("upi_app"),
        payment.alias("payment_type"),
        status.alias("status"),
        F.when(status == "FAILED", _pick(fixed.FAILURE_REASONS, k % 7)).alias("failure_reason"),
        txn_date.alias("txn_date"),
        (k % 24).cast("tinyint").alias("txn_hour"),
        F.concat(F.lit("u"), ck.cast("string"), F.lit("@okicici")).alias("sender_upi"),
        F.concat(F.lit("m"), (k % 1000).cast("string"), F.lit("@ybl")).alias("receiver_upi"),
        device.alias("device_type"),
    )
    base = base.select(
        "*",
        is_weekend_day("txn_date").alias("is_weekend"),
        is_source_festival("txn_date").alias("is_festival"),
        (F.col("txn_date").cast("timestamp")
         + F.make_interval(hours=F.col("txn_hour").cast("int"))).alias("created_at"),
    )

    def of(copy: int, column: str, value: Column) -> Column:
        return F.when(F.col("_copy") == copy, value).otherwise(F.col(column))
    out = (base.withColumn("created_at", of(SECOND, "created_at", F.col("created_at") + F.expr("INTERVAL 1 HOUR")))
           .withColumn("amount_inr", F.when(F.col("_copy") == ZERO, F.lit(0.0))
                       .otherwise(of(SECOND, "amount_inr", F.col("amount_inr") + F.lit(1.0))))
           .withColumn("city", of(SECOND, "city", F.concat(F.lit(" "), F.lower("city"), F.lit(" "))))
           .withColumn("merchant_category", of(SECOND, "merchant_category", F.upper("merchant_category")))
           .withColumn("status", of(SECOND, "status", F.lower("status")))
           .withColumn("txn_id", F.when(F.col("_copy") == NO_ID, F.lit(None).cast("string"))
                       .otherwise(of(ZERO, "txn_id", F.concat("txn_id", F.lit("Z"))))))
    return out.select(*[F.col(n).cast(t).alias(n) for n, t in schema.LAKE_FIELDS])


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw transaction table as the loader would produce it from these
    lake rows; the load time is a fixed rule (created_at + 1 day), never now()."""
    from paylake.sources.ingest import to_raw
    lake = lake_rows(spark, sf_dir)
    return to_raw(lake, loaded_at=F.col("created_at") + F.expr("INTERVAL 1 DAY"))
