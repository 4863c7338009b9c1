"""The pipeline models: staging -> enriched -> dimensions -> fact.

Each model is a function from DataFrames to a lazy DataFrame; Catalyst fuses
staging, enrichment and the five dimension lookups of the fact into the stage
that follows the one dedup shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake import schema
from paylake.functions import buckets, calendar
from paylake.functions.keys import surrogate_key
from paylake.functions.text import lower_trim, upper_trim
from paylake.operators.dedup import latest_per_key
from paylake.operators.joins import bounded
from paylake.sources import relations
from paylake.sources.fixed import LOOKBACK

# Total order for "latest version wins": newest event, then newest load, then
# the remaining columns, so equal timestamps still resolve deterministically.
_TIEBREAK = ["amount_inr", "city", "state", "merchant_category", "upi_app", "payment_type",
             "status", "failure_reason", "txn_date", "txn_hour", "is_weekend", "is_festival",
             "sender_upi", "receiver_upi", "device_type"]


def latest_order():
    return ([F.col("created_at").desc_nulls_last(), F.col("loaded_at").desc_nulls_last()]
            + [F.col(c).asc_nulls_first() for c in _TIEBREAK])


def stg_transactions(raw: DataFrame) -> DataFrame:
    """Latest version per txn_id, trimmed and re-cased, valid rows only.

    The ``txn_id IS NOT NULL`` test runs before the dedup (same result, and
    NULL ids never reach the shuffle); ``amount_inr > 0`` runs after it, so a
    latest version with a non-positive amount removes the transaction rather
    than bringing back an older version.
    """
    return stg_from_latest(latest_versions(raw))


def latest_versions(raw: DataFrame) -> DataFrame:
    """The latest version of every transaction, whatever its amount."""
    return latest_per_key(raw, "txn_id", latest_order())


def stg_from_latest(latest: DataFrame) -> DataFrame:
    """Staging over rows that are already the latest version per txn_id (the
    maintained table of :mod:`paylake.plans.staging_store`): no dedup, just
    the amount test and the cleaning projection."""
    return staged_columns(latest.filter(F.col("amount_inr") > 0))


def staged_columns(latest: DataFrame) -> DataFrame:
    """The cleaning projection of staging."""
    return latest.select(
        "txn_id",
        F.col("amount_inr").cast("decimal(12,2)").alias("amount_inr"),
        upper_trim("city").alias("city"),
        upper_trim("state").alias("state"),
        lower_trim("merchant_category").alias("merchant_category"),
        lower_trim("upi_app").alias("upi_app"),
        lower_trim("payment_type").alias("payment_type"),
        upper_trim("status").alias("status"),
        "failure_reason", "txn_date",
        F.col("txn_hour").cast("smallint").alias("txn_hour"),
        "is_weekend", "is_festival", "sender_upi", "receiver_upi",
        lower_trim("device_type").alias("device_type"),
        "created_at", "loaded_at",
    )


def int_enriched(stg: DataFrame) -> DataFrame:
    """Staged rows plus success flags, hour and amount buckets, year/month, day name."""
    return stg.select(
        "txn_id", "amount_inr", "city", "state", "merchant_category", "upi_app",
        "payment_type", "status", "failure_reason", "txn_date", "txn_hour",
        "is_weekend", "is_festival", "sender_upi", "receiver_upi", "device_type",
        "created_at",
        buckets.is_success("status").alias("is_success"),
        buckets.is_success_int("status").alias("is_success_int"),
        buckets.time_of_day("txn_hour").alias("time_of_day"),
        buckets.amount_bucket("amount_inr").alias("amount_bucket"),
        F.year("txn_date").alias("txn_year"),
        F.month("txn_date").alias("txn_month"),
        calendar.day_name("txn_date").alias("day_name"),
    )


# --------------------------------------------------------------------------
# dimensions
# --------------------------------------------------------------------------
DIM_DATE_ROWS = 731  # [2023-01-01, 2025-01-01)


def dim_date(spark: SparkSession) -> DataFrame:
    """Calendar: one row per day of the fixed range, with the 24-day festival list."""
    d = F.col("date_day")
    spine = relations.date_spine(spark)
    fest = relations.calendar_festivals(spark)
    j = spine.join(bounded(fest, relations.ROW_BOUND["calendar_festivals"]),
                   spine.date_day == fest.festival_date, "left")
    return j.select(
        calendar.date_key(d).alias("date_sk"),
        d.alias("date_day"),
        F.year(d).alias("year"),
        F.month(d).alias("month_num"),
        calendar.month_name(d).alias("month_name"),
        calendar.month_short(d).alias("month_short"),
        F.dayofmonth(d).alias("day_of_month"),
        calendar.day_of_week_num(d).alias("day_of_week_num"),
        calendar.day_name(d).alias("day_name"),
        calendar.day_short(d).alias("day_short"),
        F.quarter(d).alias("quarter"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofyear(d).alias("day_of_year"),
        calendar.is_weekend_day(d).alias("is_weekend"),
        calendar.is_month_start(d).alias("is_month_start"),
        calendar.is_month_end(d).alias("is_month_end"),
        buckets.season(F.month(d)).alias("season"),
        buckets.fiscal_quarter(F.month(d)).alias("fiscal_quarter"),
        F.col("festival_name").isNotNull().alias("is_festival_day"),
        "festival_name",
    )


def location_mapping(spark: SparkSession) -> DataFrame:
    """All mapped cities with their dimension columns (keys included)."""
    m = relations.city_mapping(spark)
    return m.select(
        surrogate_key("city").alias("location_sk"),
        "city", "state", "region", "tier", "is_metro",
        buckets.population_bucket("tier").alias("population_bucket"),
    )


def dim_location(stg: DataFrame) -> DataFrame:
    """Mapped cities that occur in the staged data (unmapped or unseen ones vanish).

    Same rows as ``distinct(city) INNER JOIN mapping``: every output column comes
    from the unique-keyed mapping, so a semi join of the 97-row mapping against
    the data's cities is equivalent and keeps the mapping on the build side.
    """
    spark = stg.sparkSession
    cities = stg.select("city").distinct()
    return location_mapping(spark).join(cities, "city", "left_semi").select(
        "location_sk", "city", "state", "region", "tier", "is_metro", "population_bucket")


def dim_merchant(spark: SparkSession) -> DataFrame:
    m = relations.merchant_categories(spark)
    return m.select(surrogate_key("category_code").alias("merchant_sk"),
                    "category_code", "category_name", "category_group", "is_essential")


def dim_upi_app(spark: SparkSession) -> DataFrame:
    a = relations.upi_apps(spark)
    return a.select(surrogate_key("app_name").alias("upi_app_sk"),
                    "app_name", "company", "market_share_pct")


def dim_payment_type(spark: SparkSession) -> DataFrame:
    p = relations.payment_types(spark)
    return p.select(surrogate_key("type_code").alias("payment_type_sk"), "type_code", "type_name")


@dataclass
class Dims:
    date: DataFrame
    location: DataFrame
    merchant: DataFrame
    upi_app: DataFrame
    payment_type: DataFrame


def dims(spark: SparkSession, stg: DataFrame) -> Dims:
    return Dims(dim_date(spark), dim_location(stg), dim_merchant(spark),
                dim_upi_app(spark), dim_payment_type(spark))


# --------------------------------------------------------------------------
# fact
# --------------------------------------------------------------------------
def fact_rows(enriched: DataFrame) -> DataFrame:
    """The fact model over enriched rows: five left joins to the dimensions.

    Unmatched lookups leave a NULL key and keep the row. The location lookup
    joins the city mapping directly: a fact city is by definition in the
    staged data, so matching it against ``mapping ∩ cities-in-data`` and
    against the mapping gives the same key, and the staged data need not be
    computed a second time. Every lookup side is a constant relation of a
    proven size (<= 731 rows) and is broadcast.
    """
    spark = enriched.sparkSession
    t = enriched
    loc = location_mapping(spark).select(F.col("location_sk"), F.col("city").alias("__l_city"))
    dd = dim_date(spark).select("date_sk", F.col("date_day").alias("__d_day"))
    mm = dim_merchant(spark).select("merchant_sk", F.col("category_code").alias("__m_code"))
    uu = dim_upi_app(spark).select("upi_app_sk", F.col("app_name").alias("__u_name"))
    pp = dim_payment_type(spark).select("payment_type_sk", F.col("type_code").alias("__p_code"))
    b = relations.ROW_BOUND
    t = t.join(bounded(loc, b["city_mapping"]), t.city == loc["__l_city"], "left")
    t = t.join(bounded(dd, DIM_DATE_ROWS), t.txn_date == dd["__d_day"], "left")
    t = t.join(bounded(mm, b["merchant_categories"]), t.merchant_category == mm["__m_code"], "left")
    t = t.join(bounded(uu, b["upi_apps"]), t.upi_app == uu["__u_name"], "left")
    t = t.join(bounded(pp, b["payment_types"]), t.payment_type == pp["__p_code"], "left")
    return t.select(
        surrogate_key("txn_id").alias("txn_sk"),
        "txn_id", "date_sk", "location_sk", "merchant_sk", "upi_app_sk", "payment_type_sk",
        "amount_inr", "is_success", "is_success_int", "status", "time_of_day",
        "amount_bucket", "is_weekend", "is_festival", "device_type", "txn_hour",
        "txn_year", "txn_month", "created_at",
    )


def fact_from_raw(raw: DataFrame) -> DataFrame:
    return fact_rows(int_enriched(stg_transactions(raw)))


assert len(schema.FACT_COLUMNS) == 20


# --------------------------------------------------------------------------
# incremental fact
# --------------------------------------------------------------------------
def lookback_cutoff(fact: DataFrame, lookback: str = LOOKBACK):
    """``max(created_at) - lookback`` of the fact as a literal column (None when
    it is empty). Carried as microseconds: a driver-side datetime would be
    ambiguous in a local zone's repeated hour."""
    micros = fact.agg(F.unix_micros(F.max("created_at") - F.expr(lookback)).alias("c")).first()[0]
    return None if micros is None else F.timestamp_micros(F.lit(micros))


def fact_incremental(spark: SparkSession, raw: DataFrame, fact_path: str,
                     lookback: str = LOOKBACK, deduped: bool = False) -> str:
    """Build the fact on the first run, then keep it current by keyed upserts
    of rows newer than ``max(created_at) - lookback``. An empty target counts
    as a first run (``created_at > NULL`` would otherwise keep nothing).

    The cutoff is one value, computed first (a one-column aggregate of the
    fact) and applied as a literal, so the scan pushes ``created_at >
    cutoff`` into Parquet and skips row groups whose newest row is older.
    ``deduped=True`` means ``raw`` is already the latest-version table, so
    staging is a filter and projection (see :func:`stg_from_latest`).
    """
    from paylake.operators.upsert import read_target, upsert
    stage = stg_from_latest if deduped else stg_transactions
    target = read_target(spark, fact_path)
    cutoff = lookback_cutoff(target, lookback) if target is not None else None
    if cutoff is None:
        # full build: the dedup shuffle reads all of raw; size it to raw
        from paylake.session import sized_shuffle
        with sized_shuffle(spark, raw):
            return upsert(spark, fact_rows(int_enriched(stage(raw))), fact_path)
    # Same rows as filtering the enriched model, but before the dedup: if a
    # txn's latest version (first in the dedup's order, which starts with
    # created_at desc) is newer than the cutoff, it is also the first among
    # that txn's rows newer than it; if not, no row of the txn is newer either.
    recent = raw.filter(F.col("created_at") > cutoff)
    return upsert(spark, fact_rows(int_enriched(stage(recent))), fact_path)


def late_rows(raw: DataFrame, fact: DataFrame, cutoff) -> DataFrame:
    """Staged rows at or before ``cutoff`` whose transaction the fact lacks:
    the rows an incremental run skips silently."""
    from paylake.session import partitions_for
    stg, ids = stg_transactions(raw).filter(F.col("created_at") <= cutoff), fact.select("txn_id")
    n = partitions_for(raw.sparkSession, raw, ids)
    return stg.repartition(n, "txn_id").join(ids.repartition(n, "txn_id"), "txn_id", "left_anti")


def dim_location_from_fact(fact: DataFrame) -> DataFrame:
    """``dim_location`` from a built fact, without recomputing staging.

    A mapped city occurs in the staged data exactly when its key
    ``md5(city)`` occurs in the fact's ``location_sk`` (the fact keys every
    staged row, and only mapped cities get a key), so the mapping semi-joined
    with the fact's distinct keys is the same relation. Reads one column.
    """
    keys = fact.select("location_sk").filter(F.col("location_sk").isNotNull()).distinct()
    return location_mapping(fact.sparkSession).join(keys, "location_sk", "left_semi").select(
        "location_sk", "city", "state", "region", "tier", "is_metro", "population_bucket")


def build_star(spark: SparkSession, raw: DataFrame, out_dir: str, deduped: bool = False) -> dict[str, str]:
    """Write the fact (incrementally if it exists) and the five dimensions as
    Parquet tables under ``out_dir``; returns the table paths. ``deduped``:
    ``raw`` is the maintained latest-version table."""
    root = out_dir.rstrip("/")
    paths = {n: f"{root}/{n}" for n in ["fact_transactions", "dim_date", "dim_location", "dim_merchant",
                                         "dim_upi_app", "dim_payment_type"]}
    fact_incremental(spark, raw, paths["fact_transactions"], deduped=deduped)
    fact = spark.read.parquet(paths["fact_transactions"])
    tables = {"dim_date": dim_date(spark), "dim_location": dim_location_from_fact(fact),
              "dim_merchant": dim_merchant(spark), "dim_upi_app": dim_upi_app(spark),
              "dim_payment_type": dim_payment_type(spark)}
    from paylake.operators.publish import rebuild_table
    for name, df in tables.items():
        rebuild_table(df.repartition(1), paths[name])  # at most 731 rows, after their aggregate
    return paths
