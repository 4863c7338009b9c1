"""One query per operator of the inventory, each over the staged pipeline.

Every query reads the stand-in rows derived from the driver's tables, so its
work grows with them. Constant relations (the dimension seeds, the date
spine) are reported together with how many transactions use each row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.functions import buckets, calendar
from paylake.functions.keys import surrogate_key
from paylake.functions.numeric import percent
from paylake.functions.text import lake_city_key, lower_trim, upper_trim
from paylake.operators.joins import bounded
from paylake.plans.models import DIM_DATE_ROWS, latest_order
from paylake.plans.inputs import Inputs
from paylake.sources import fixed, ingest, relations

LOC_BOUND = len(fixed.CITY_MAPPING)


def _n():
    return F.count(F.lit(1))


def _fact_date(i: Inputs) -> DataFrame:
    d = i.dims.date
    return i.fact.select("date_sk").join(bounded(d, DIM_DATE_ROWS), "date_sk")


def _usage(dim: DataFrame, key: str, fact: DataFrame, bound: int) -> DataFrame:
    """Every dimension row with the number of fact rows that reference it."""
    counts = fact.groupBy(key).agg(_n().alias("fact_rows"))
    return (dim.join(counts, key, "left")
            .withColumn("fact_rows", F.coalesce(F.col("fact_rows"), F.lit(0)).cast("bigint")))


# ---- projections / predicates ------------------------------------------------
def fn_trim_case(i: Inputs) -> DataFrame:
    """Distinct raw city/category/status values with their trimmed, re-cased forms."""
    return i.raw.select(
        F.col("city").alias("raw_city"), upper_trim("city").alias("city"),
        F.col("merchant_category").alias("raw_category"), lower_trim("merchant_category").alias("merchant_category"),
        F.col("status").alias("raw_status"), upper_trim("status").alias("status")).distinct()


def stg_filter_valid(i: Inputs) -> DataFrame:
    """Raw rows by what staging does with them: kept, latest version with a
    non-positive amount, older version of an id, or no id.

    One aggregate per id, partial-aggregated map-side (no task holds all rows
    of an id): its rows, and the amount of its latest version. In the dedup's
    order the newest event and load come first, then NULL and the least amount.
    """
    newest = F.struct("created_at", "loaded_at", F.col("amount_inr").isNull().alias("none"),
                      (-F.col("amount_inr")).alias("minus"))
    per_id = i.raw.groupBy("txn_id").agg(_n().alias("c"), F.max(newest).alias("top"))
    has_id, kept = F.col("txn_id").isNotNull(), F.coalesce(F.col("top.minus") < 0, F.lit(False))
    totals = per_id.agg(
        F.count_if(has_id & kept).alias("kept"), F.count_if(has_id & ~kept).alias("non_positive_amount"),
        F.coalesce(F.sum(F.when(has_id, F.col("c") - 1)), F.lit(0)).alias("older_version"),
        F.coalesce(F.sum(F.when(~has_id, F.col("c"))), F.lit(0)).alias("null_id"))
    cells = [F.struct(F.lit(c).alias("outcome"), F.col(c).cast("bigint").alias("rows")) for c in totals.columns]
    return (totals.select(F.explode(F.array(*cells)).alias("r")).select("r.*")
            .filter((F.col("rows") > 0) | (F.col("outcome") == "null_id")))


def success_flags(i: Inputs) -> DataFrame:
    """Enriched rows by status and its two success flags."""
    return i.enr.groupBy("status", "is_success", "is_success_int").agg(_n().alias("rows"))


def time_of_day_bucket(i: Inputs) -> DataFrame:
    """Enriched rows by hour and time-of-day bucket."""
    return i.enr.groupBy("txn_hour", "time_of_day").agg(_n().alias("rows"))


def amount_bucket(i: Inputs) -> DataFrame:
    """Enriched rows by amount bucket, with the bucket's smallest and largest amount."""
    return i.enr.groupBy("amount_bucket").agg(_n().alias("rows"), F.min("amount_inr").alias("min_amount"),
                                              F.max("amount_inr").alias("max_amount"))


def txn_year_month(i: Inputs) -> DataFrame:
    """Enriched rows by year and month of the transaction date."""
    return i.enr.groupBy("txn_year", "txn_month").agg(_n().alias("rows"))


def txn_day_name(i: Inputs) -> DataFrame:
    """Enriched rows by blank-padded weekday name."""
    return i.enr.groupBy("day_name").agg(_n().alias("rows"))


def season(i: Inputs) -> DataFrame:
    """Fact rows by the calendar's season of their day."""
    return _fact_date(i).groupBy("season").agg(_n().alias("rows"))


def fiscal_quarter(i: Inputs) -> DataFrame:
    """Fact rows by the calendar's fiscal quarter of their day."""
    return _fact_date(i).groupBy("fiscal_quarter").agg(_n().alias("rows"))


def population_bucket(i: Inputs) -> DataFrame:
    """Fact rows by city tier and population bucket."""
    loc = i.dims.location.select("location_sk", "tier", "population_bucket")
    return (i.fact.select("location_sk").join(bounded(loc, LOC_BOUND), "location_sk")
            .groupBy("tier", "population_bucket").agg(_n().alias("rows")))


def filter_boolean(i: Inputs) -> DataFrame:
    """Fact rows passing each boolean filter: successful, festival, not festival (one pass)."""
    tests = {"is_success": F.col("is_success"), "is_festival": F.col("is_festival"),
             "not_is_festival": ~F.col("is_festival")}
    totals = i.fact.agg(*[F.count_if(e).alias(k) for k, e in tests.items()])
    cells = [F.struct(F.lit(k).alias("predicate"), F.col(k).alias("n")) for k in tests]
    return totals.select(F.explode(F.array(*cells)).alias("r")).select("r.*")


def day_type_label(i: Inputs) -> DataFrame:
    """Fact rows by Weekend/Weekday label."""
    return i.fact.groupBy(buckets.day_type_label("is_weekend").alias("day_type")).agg(_n().alias("rows"))


def festival_flag_coalesce(i: Inputs) -> DataFrame:
    """Fact rows by the calendar's festival flag and name."""
    return _fact_date(i).groupBy("is_festival_day", "festival_name").agg(_n().alias("rows"))


def safe_ratio(i: Inputs) -> DataFrame:
    """Pending per hundred failed transactions by category (NULL when none failed)."""
    s = F.col("status")
    return i.enr.groupBy("merchant_category").agg(
        percent(F.count_if(s == "PENDING"), F.count_if(s == "FAILED"), 2).alias("pending_per_failed_pct"))


def date_flags(i: Inputs) -> DataFrame:
    """Per lake date: weekend flag and source festival flag recomputed from the date, rows."""
    return (i.lake.groupBy("txn_date").agg(_n().alias("rows"))
            .select("txn_date", calendar.is_weekend_day("txn_date").alias("is_weekend"),
                    calendar.is_source_festival("txn_date").alias("is_festival"), "rows"))


def calendar_weekend_flag(i: Inputs) -> DataFrame:
    """Fact rows by the calendar's day-of-week number and weekend flag."""
    return _fact_date(i).groupBy("day_of_week_num", "is_weekend").agg(_n().alias("rows"))


def lake_city_key_q(i: Inputs) -> DataFrame:
    """Distinct lake cities with their folder key."""
    return i.lake.select("city", lake_city_key("city").alias("city_part")).distinct()


# ---- joins --------------------------------------------------------------------
def star_left_joins(i: Inputs) -> DataFrame:
    """Fact rows, and rows left without each of the five dimension keys."""
    c = {k: F.count_if(F.col(k).isNull()).alias(f"no_{k}")
         for k in ["location_sk", "date_sk", "merchant_sk", "upi_app_sk", "payment_type_sk"]}
    return i.fact.agg(_n().alias("rows"), *c.values())


def date_festival_left(i: Inputs) -> DataFrame:
    """Calendar festival days with the fact rows on each (days without rows kept)."""
    fest = i.dims.date.filter(F.col("is_festival_day")).select("date_sk", "date_day", "festival_name")
    return _usage(fest, "date_sk", i.fact.select("date_sk"), DIM_DATE_ROWS).drop("date_sk")


def fact_dim_inner(i: Inputs) -> DataFrame:
    """Fact rows that survive an inner join with each dimension."""
    keys = [("location_sk", i.dims.location, LOC_BOUND), ("date_sk", i.dims.date, DIM_DATE_ROWS),
            ("merchant_sk", i.dims.merchant, 15), ("upi_app_sk", i.dims.upi_app, 5),
            ("payment_type_sk", i.dims.payment_type, 4)]
    f = i.fact.select(*[k for k, _, _ in keys])
    for k, d, b in keys:
        p = d.select(F.col(k).alias(f"__{k}"))
        f = f.join(bounded(p, b), f[k] == p[f"__{k}"], "left")
    agg = f.agg(*[F.count_if(F.col(f"__{k}").isNotNull()).alias(k) for k, _, _ in keys])
    return agg.select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("fk"), F.col(k).cast("bigint").alias("rows")) for k, _, _ in keys
    ])).alias("r")).select("r.*")


def enrich_state_lookup(i: Inputs) -> DataFrame:
    """Distinct (city, state) pairs of the raw table after the state lookup."""
    return i.raw.select("city", "state").distinct()


def clean_on_load(i: Inputs) -> DataFrame:
    """Lake rows after the load-time cleaning (NaN to NULL, casts)."""
    return ingest.clean_on_load(i.lake)


# ---- aggregates / windows -------------------------------------------------------
def agg_max_scalar(i: Inputs) -> DataFrame:
    """The lookback cutoff: max(created_at) of the fact minus one hour."""
    return i.fact.agg((F.max("created_at") - F.expr("INTERVAL 1 HOUR")).alias("cutoff"))


def agg_distinct_rows(i: Inputs) -> DataFrame:
    """Distinct staged cities."""
    return i.stg.select("city").distinct()


def agg_dup_keys(i: Inputs) -> DataFrame:
    """Raw txn_ids occurring more than once, with their count."""
    from paylake.operators.duplicates import duplicate_values
    return duplicate_values(i.raw, ["txn_id"]).select(F.col("value").alias("txn_id"), "n")


def dedup_latest(i: Inputs) -> DataFrame:
    """Latest version of each raw txn_id, before the amount filter."""
    from paylake.operators.dedup import latest_per_key
    return latest_per_key(i.raw, "txn_id", latest_order())


# ---- scalar functions -------------------------------------------------------------
def fn_extract(i: Inputs) -> DataFrame:
    """Fact rows by the calendar's year, quarter, month, ISO week and day of year."""
    return _fact_date(i).groupBy("year", "quarter", "month_num", "week_of_year", "day_of_year").agg(_n().alias("rows"))


def fn_date_key(i: Inputs) -> DataFrame:
    """Per transaction date: its integer YYYYMMDD key and rows."""
    return i.enr.groupBy("txn_date").agg(_n().alias("rows")).select(
        "txn_date", calendar.date_key("txn_date").alias("date_key"), "rows")


def fn_date_names(i: Inputs) -> DataFrame:
    """Enriched rows by padded/short month and weekday names."""
    d = F.col("txn_date")
    return i.enr.groupBy(calendar.month_name(d).alias("month_name"), calendar.month_short(d).alias("month_short"),
                         calendar.day_name(d).alias("day_name"), calendar.day_short(d).alias("day_short")
                         ).agg(_n().alias("rows"))


def fn_month_end(i: Inputs) -> DataFrame:
    """Enriched rows by month-start and month-end flags of their date."""
    d = F.col("txn_date")
    return i.enr.groupBy(calendar.is_month_start(d).alias("is_month_start"),
                         calendar.is_month_end(d).alias("is_month_end")).agg(_n().alias("rows"))


def fn_interval_arith(i: Inputs) -> DataFrame:
    """Per transaction date: rows, the month's last day (month start + 1 month - 1 day), a week and a
    month earlier, and whether the month ends within a day."""
    d = F.col("txn_date")
    last = (F.date_trunc("month", d) + F.expr("INTERVAL 1 MONTH") - F.expr("INTERVAL 1 DAY")).cast("date")
    return i.enr.groupBy("txn_date").agg(_n().alias("rows")).select(
        "txn_date", "rows", last.alias("month_end"), F.date_sub(d, 7).alias("week_before"),
        F.add_months(d, -1).alias("month_before"), (last <= F.date_add(d, 1)).alias("ends_within_a_day"))


def fn_casts(i: Inputs) -> DataFrame:
    """Casts on load over amounts scaled beyond the column's range: rows by category that fit
    decimal(12,2), that overflow, whose amount is missing, and the rows a load would refuse."""
    scaled = i.lake.withColumn("amount_inr", F.when(F.col("txn_hour") == 0, F.lit(None)).otherwise(
        F.when(F.col("txn_hour") % 2 == 0, F.col("amount_inr") * 1e9).otherwise(F.col("amount_inr"))))
    amount = F.col("amount_inr").try_cast("decimal(12,2)")
    return scaled.groupBy("merchant_category").agg(
        F.count(amount).alias("fits"),
        F.count_if(amount.isNull() & F.col("amount_inr").isNotNull()).alias("overflows"),
        F.count_if(F.col("amount_inr").isNull()).alias("missing"),
        F.count_if(ingest.violation(scaled).isNotNull()).alias("refused"),
        F.sum(F.col("txn_hour").cast("smallint")).alias("hours"))


def fn_surrogate_key(i: Inputs) -> DataFrame:
    """Distinct staged cities with their MD5 surrogate key."""
    return i.stg.select("city").distinct().select("city", surrogate_key("city").alias("city_key"))


def fn_null_handling(i: Inputs) -> DataFrame:
    """Staged rows by status and failure reason (NULL shown as '(none)')."""
    return i.stg.groupBy("status", F.coalesce(F.col("failure_reason"), F.lit("(none)")).alias("reason")).agg(
        _n().alias("rows"), F.count_if(F.col("failure_reason").isNull()).alias("null_reasons"))


def fn_clip(i: Inputs) -> DataFrame:
    """Amounts clipped to their category range: rows raised to the minimum or
    lowered to the maximum."""
    ranges = relations.category_ranges(i.spark)
    j = i.lake.select("merchant_category", "amount_inr").join(
        bounded(ranges, 15), F.col("merchant_category") == ranges.category_code)
    clipped = F.least(F.greatest(F.col("amount_inr"), F.col("min_amount")), F.col("max_amount"))
    return j.groupBy("category_code").agg(
        F.count_if(clipped > F.col("amount_inr")).alias("raised"),
        F.count_if(clipped < F.col("amount_inr")).alias("lowered"))


# ---- constant sources, reported with their use -------------------------------------
def src_date_spine(i: Inputs) -> DataFrame:
    """Gap-free daily series: every calendar day with its staged transactions."""
    spine = relations.date_spine(i.spark)
    per_day = i.stg.groupBy(F.col("txn_date").alias("date_day")).agg(_n().alias("transactions"))
    return (spine.join(per_day, "date_day", "left")
            .withColumn("transactions", F.coalesce(F.col("transactions"), F.lit(0)).cast("bigint")))


def src_values_dims(i: Inputs) -> DataFrame:
    """Each constant code relation with the staged transactions using each code (one pass over staging)."""
    relation = {
        "merchant_category": relations.merchant_categories(i.spark).select(F.col("category_code").alias("code")),
        "upi_app": relations.upi_apps(i.spark).select(F.col("app_name").alias("code")),
        "payment_type": relations.payment_types(i.spark).select(F.col("type_code").alias("code"))}
    codes = None
    for name, values in relation.items():
        part = values.select(F.lit(name).alias("relation"), "code")
        codes = part if codes is None else codes.unionByName(part)
    used = F.array(*[F.struct(F.lit(c).alias("relation"), F.col(c).alias("code")) for c in relation])
    counts = (i.stg.select(F.explode(used).alias("u")).select("u.*").groupBy("relation", "code")
              .agg(_n().alias("n")))
    return codes.join(counts, ["relation", "code"], "left").select(
        "relation", "code", F.coalesce("n", F.lit(0)).cast("bigint").alias("transactions"))


def model_dim_date(i: Inputs) -> DataFrame:
    """The calendar dimension (731 days) with the fact rows on each day."""
    return _usage(i.dims.date, "date_sk", i.fact.select("date_sk"), DIM_DATE_ROWS)


def model_dim_merchant(i: Inputs) -> DataFrame:
    """The merchant dimension with the fact rows of each category."""
    return _usage(i.dims.merchant, "merchant_sk", i.fact.select("merchant_sk"), 15)


def model_dim_upi_app(i: Inputs) -> DataFrame:
    """The app dimension with the fact rows of each app."""
    return _usage(i.dims.upi_app, "upi_app_sk", i.fact.select("upi_app_sk"), 5)


def model_dim_payment_type(i: Inputs) -> DataFrame:
    """The payment-type dimension with the fact rows of each type."""
    return _usage(i.dims.payment_type, "payment_type_sk", i.fact.select("payment_type_sk"), 4)


def materialize_view(i: Inputs) -> DataFrame:
    """Staging as a (lazy, unmaterialised) temp view, queried through SQL."""
    name = "stg_transactions_view"
    i.stg.createOrReplaceTempView(name)
    return i.spark.sql(f"SELECT city, COUNT(*) AS transactions FROM {name} GROUP BY city")


INVENTORY = {
    "fn_trim_case": fn_trim_case, "stg_filter_valid": stg_filter_valid, "success_flags": success_flags,
    "time_of_day_bucket": time_of_day_bucket, "amount_bucket": amount_bucket,
    "txn_year_month": txn_year_month, "txn_day_name": txn_day_name, "season": season,
    "fiscal_quarter": fiscal_quarter, "population_bucket": population_bucket,
    "filter_boolean": filter_boolean, "day_type_label": day_type_label,
    "festival_flag_coalesce": festival_flag_coalesce, "safe_ratio": safe_ratio, "date_flags": date_flags,
    "calendar_weekend_flag": calendar_weekend_flag, "lake_city_key": lake_city_key_q,
    "star_left_joins": star_left_joins, "date_festival_left": date_festival_left,
    "fact_dim_inner": fact_dim_inner, "enrich_state_lookup": enrich_state_lookup,
    "clean_on_load": clean_on_load, "agg_max_scalar": agg_max_scalar,
    "agg_distinct_rows": agg_distinct_rows, "agg_dup_keys": agg_dup_keys, "dedup_latest": dedup_latest,
    "fn_extract": fn_extract, "fn_date_key": fn_date_key, "fn_date_names": fn_date_names,
    "fn_month_end": fn_month_end, "fn_interval_arith": fn_interval_arith, "fn_casts": fn_casts, "fn_surrogate_key": fn_surrogate_key,
    "fn_null_handling": fn_null_handling, "fn_clip": fn_clip, "src_date_spine": src_date_spine,
    "src_values_dims": src_values_dims, "model_dim_date": model_dim_date,
    "model_dim_merchant": model_dim_merchant, "model_dim_upi_app": model_dim_upi_app,
    "model_dim_payment_type": model_dim_payment_type, "materialize_view": materialize_view,
}

# Keys of the inventory whose query is the same as a panel, model or check.
SAME_AS = {
    "stg_clean": "model_stg_transactions", "location_inner": "model_dim_location",
    "anti_orphan_fk": "dq_relationships", "agg_count_all": "panel_total_txns",
    "agg_sum": "panel_total_value", "agg_avg": "panel_avg_success_value",
    "agg_count_distinct": "panel_cities_covered", "agg_conditional_rate": "panel_success_rate",
    "agg_min_order": "panel_amount_buckets", "agg_group_month": "panel_monthly_volume",
    "share_of_total": "panel_device_share", "topk_cities": "panel_top_cities",
    "order_by_agg": "panel_merchant_split", "union_all": "panel_festival_vs_normal",
    "fn_date_trunc": "panel_monthly_volume",
    "fn_round_half_up": "panel_success_by_tier",
}
