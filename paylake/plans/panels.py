"""The seventeen dashboard panels, each over the fact and at most one dimension.

Every panel scans the whole fact (no time filter), reads only the columns it
needs and aggregates with a map-side partial aggregate. A panel labelled by a
dimension aggregates the fact to the dimension key first and joins the
(constant-bounded, broadcast) dimension to those few rows — exact, since
counts and decimal sums add up. Shares of total are computed over the
aggregated rows only.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.functions import buckets
from paylake.functions.numeric import money_sum, percent, rounded_avg, scaled_millions
from paylake.operators import publish
from paylake.operators.joins import bounded
from paylake.operators.share import with_share
from paylake.plans.models import DIM_DATE_ROWS, Dims
from paylake.schema import FACT_PARTITION_COLUMNS
from paylake.session import hadoop_path
from paylake.sources import fixed, relations
from paylake.sources.ingest import path_exists

LOCATION_BOUND = len(fixed.CITY_MAPPING)


def total_txns(fact: DataFrame) -> DataFrame:
    """Count of fact rows."""
    return fact.agg(F.count(F.lit(1)).alias("value"))


def total_value(fact: DataFrame) -> DataFrame:
    """Sum of amounts (decimal)."""
    return fact.agg(money_sum("amount_inr").alias("value"))


def success_rate(fact: DataFrame) -> DataFrame:
    """Percentage of successful rows, 2 decimals, half-up."""
    return fact.agg(percent(F.sum("is_success_int"), F.count(F.lit(1)), 2).alias("value"))


def avg_success_value(fact: DataFrame) -> DataFrame:
    """Average amount of successful rows, 2 decimals."""
    return fact.filter(F.col("is_success")).agg(rounded_avg("amount_inr").alias("value"))


def cities_covered(fact: DataFrame) -> DataFrame:
    """Exact distinct count (NULL keys not counted)."""
    return fact.agg(F.count_distinct("location_sk").alias("value"))


def monthly_volume(fact: DataFrame, dims: Dims) -> DataFrame:
    """Aggregated to the date key first (one row per day), then the ≤ 731
    day rows are joined to the calendar and rolled up to months."""
    per_day = fact.groupBy("date_sk").agg(F.count(F.lit(1)).alias("n"), F.sum("amount_inr").alias("amt"))
    d = dims.date.select("date_sk", "date_day")
    j = per_day.join(bounded(d, DIM_DATE_ROWS), "date_sk")
    return (j.groupBy(F.date_trunc("month", "date_day").cast("date").alias("time"))
            .agg(F.sum("n").alias("transactions"), F.sum("amt").cast("decimal(22,2)").alias("amount_inr"))
            .orderBy("time"))


def hourly_volume(fact: DataFrame) -> DataFrame:
    """Rows per stored (UTC) hour of day."""
    return (fact.groupBy(F.col("txn_hour").alias("hour"))
            .agg(F.count(F.lit(1)).alias("transactions")).orderBy("hour"))


def _by_dim(fact: DataFrame, dim: DataFrame, key: str, label: str, alias: str, bound: int,
            measures: list[str] | None = None) -> DataFrame:
    """Fact aggregated to the key's grain, joined to the dimension label.

    Inner join semantics (NULL keys and keys without a dimension row drop
    out), but the join runs on one row per key, not per fact row: ``n`` rows
    and the sums of ``measures`` per key, to be rolled up by the label.
    """
    aggs = [F.count(F.lit(1)).alias("n")] + [F.sum(m).alias(f"sum_{m}") for m in (measures or [])]
    per_key = fact.groupBy(key).agg(*aggs)
    d = dim.select(key, F.col(label).alias(alias))
    return per_key.join(bounded(d, bound), key)


def top_cities(fact: DataFrame, dims: Dims, k: int = 10) -> DataFrame:
    """Top ``k`` cities by count; ties broken by city name."""
    j = _by_dim(fact, dims.location, "location_sk", "city", "city", LOCATION_BOUND, ["amount_inr"])
    g = j.groupBy("city").agg(F.sum("n").alias("transactions"),
                              scaled_millions("sum_amount_inr").alias("amount_m_inr"))
    return g.orderBy(F.col("transactions").desc(), F.col("city")).limit(k)


def merchant_split(fact: DataFrame, dims: Dims) -> DataFrame:
    """Rows and amount in millions per merchant category, by rows."""
    j = _by_dim(fact, dims.merchant, "merchant_sk", "category_name", "category",
                relations.ROW_BOUND["merchant_categories"], ["amount_inr"])
    g = j.groupBy("category").agg(F.sum("n").alias("transactions"),
                                  scaled_millions("sum_amount_inr").alias("amount_m_inr"))
    return g.orderBy(F.col("transactions").desc(), F.col("category"))


def app_share(fact: DataFrame, dims: Dims) -> DataFrame:
    """Rows and share of all rows (1 decimal) per app."""
    j = _by_dim(fact, dims.upi_app, "upi_app_sk", "app_name", "app", relations.ROW_BOUND["upi_apps"])
    g = j.groupBy("app").agg(F.sum("n").alias("transactions"))
    return with_share(g, "transactions", "share_pct").orderBy(F.col("transactions").desc(), F.col("app"))


def success_by_tier(fact: DataFrame, dims: Dims) -> DataFrame:
    """Success rate per city tier."""
    j = _by_dim(fact, dims.location, "location_sk", "tier", "tier", LOCATION_BOUND, ["is_success_int"])
    return (j.groupBy("tier")
            .agg(percent(F.sum("sum_is_success_int"), F.sum("n"), 2).alias("success_rate_pct"))
            .orderBy("tier"))


def payment_type_share(fact: DataFrame, dims: Dims) -> DataFrame:
    """Rows and share of all rows per payment type."""
    j = _by_dim(fact, dims.payment_type, "payment_type_sk", "type_name", "payment_type",
                relations.ROW_BOUND["payment_types"])
    g = j.groupBy("payment_type").agg(F.sum("n").alias("transactions"))
    return with_share(g, "transactions", "share_pct").orderBy(F.col("transactions").desc(),
                                                               F.col("payment_type"))


def weekday_weekend(fact: DataFrame) -> DataFrame:
    """Grouped on the flag itself (a NULL flag is its own 'Weekday' group)."""
    g = fact.groupBy("is_weekend").agg(F.count(F.lit(1)).alias("transactions"),
                                       rounded_avg("amount_inr").alias("avg_amount"))
    return g.select(buckets.day_type_label("is_weekend").alias("day_type"), "transactions", "avg_amount")


def festival_vs_normal(fact: DataFrame) -> DataFrame:
    """Two averages stacked: festival rows and normal rows (NULL flags in neither).

    One scan and one aggregation with conditional averages, then the two
    result cells are unpivoted — rather than scanning the fact twice for a
    UNION ALL of two filtered aggregates.
    """
    f = F.col("is_festival")
    a = fact.select("is_festival", "amount_inr").agg(
        rounded_avg(F.when(f, F.col("amount_inr"))).alias("fest"),
        rounded_avg(F.when(~f, F.col("amount_inr"))).alias("normal"))
    return a.select(F.explode(F.array(
        F.struct(F.lit("Festival Day").alias("day"), F.col("fest").alias("avg_amount")),
        F.struct(F.lit("Normal Day").alias("day"), F.col("normal").alias("avg_amount")),
    )).alias("r")).select("r.day", "r.avg_amount")


def amount_buckets(fact: DataFrame) -> DataFrame:
    """Rows per amount bucket, ordered by the bucket's smallest amount."""
    g = fact.groupBy("amount_bucket").agg(F.count(F.lit(1)).alias("transactions"),
                                          F.min("amount_inr").alias("__min"))
    return g.orderBy("__min").select("amount_bucket", "transactions")


def region_volume(fact: DataFrame, dims: Dims) -> DataFrame:
    """Rows and amount in millions per region, by rows."""
    j = _by_dim(fact, dims.location, "location_sk", "region", "region", LOCATION_BOUND, ["amount_inr"])
    g = j.groupBy("region").agg(F.sum("n").alias("transactions"),
                                scaled_millions("sum_amount_inr").alias("amount_m_inr"))
    return g.orderBy(F.col("transactions").desc(), F.col("region"))


def device_share(fact: DataFrame) -> DataFrame:
    """Rows and share of all rows per device type."""
    g = fact.groupBy(F.col("device_type").alias("device")).agg(F.count(F.lit(1)).alias("transactions"))
    return with_share(g, "transactions", "share_pct").orderBy(F.col("transactions").desc(),
                                                               F.col("device"))


def hourly_volume_local(fact: DataFrame, zone: str = "Asia/Kolkata") -> DataFrame:
    """Hour of day in the dashboard's display zone (the stored hour is UTC)."""
    from paylake.functions.calendar import local_time
    return (fact.groupBy(F.hour(local_time("created_at", zone)).alias("hour"))
            .agg(F.count(F.lit(1)).alias("transactions")).orderBy("hour"))


PANELS_FACT_ONLY = {
    "panel_total_txns": total_txns,
    "panel_total_value": total_value,
    "panel_success_rate": success_rate,
    "panel_avg_success_value": avg_success_value,
    "panel_cities_covered": cities_covered,
    "panel_hourly_volume": hourly_volume,
    "panel_weekday_weekend": weekday_weekend,
    "panel_festival_vs_normal": festival_vs_normal,
    "panel_amount_buckets": amount_buckets,
    "panel_device_share": device_share,
}
PANELS_WITH_DIMS = {
    "panel_monthly_volume": monthly_volume,
    "panel_top_cities": top_cities,
    "panel_merchant_split": merchant_split,
    "panel_app_share": app_share,
    "panel_success_by_tier": success_by_tier,
    "panel_payment_type_share": payment_type_share,
    "panel_region_volume": region_volume,
}


def run_panel(name: str, fact: DataFrame, dims: Dims) -> DataFrame:
    if name in PANELS_FACT_ONLY:
        return PANELS_FACT_ONLY[name](fact)
    return PANELS_WITH_DIMS[name](fact, dims)


PANEL_NAMES = sorted(list(PANELS_FACT_ONLY) + list(PANELS_WITH_DIMS))


# --------------------------------------------------------------------------
# the whole dashboard from one pass over the fact
# --------------------------------------------------------------------------
DASHBOARD_KEYS = ["date_sk", "txn_hour", "location_sk", "merchant_sk", "upi_app_sk", "payment_type_sk",
                  "is_weekend", "is_festival", "amount_bucket", "device_type"]


def dashboard_base(fact: DataFrame, by: list[str] = ()) -> DataFrame:
    """One scan of the fact, aggregated to every grain a panel needs.

    GROUPING SETS over the ten panel keys plus the grand total: each fact row
    is expanded once per set inside the scan stage and partial-aggregated
    there, so what leaves the stage is a few hundred rows. ``gid`` names the
    set (a key column is NULL both outside its set and for a NULL key, so the
    set must be told by ``gid``, not by NULLs). ``by`` columns are part of
    every set: partial aggregates that :func:`merged_base` adds up.
    """
    sets = [[*by, k] for k in DASHBOARD_KEYS] + [list(by)]
    cols = [F.col(k) for k in (*by, *DASHBOARD_KEYS)]
    amt, ok = F.col("amount_inr"), F.col("is_success")
    g = fact.select(*by, *DASHBOARD_KEYS, "amount_inr", "is_success", "is_success_int").groupingSets(
        [[F.col(k) for k in s] for s in sets], *cols)
    return g.agg(
        F.grouping_id(*cols).alias("gid"),
        F.count(F.lit(1)).alias("n"),
        F.sum(amt).alias("amt"),
        F.count(amt).alias("amt_n"),
        F.min(amt).alias("min_amt"),
        F.sum("is_success_int").alias("succ"),
        F.sum(F.when(ok, amt)).alias("ok_amt"),
        F.count(F.when(ok, amt)).alias("ok_amt_n"),
    )


def merged_base(parts: DataFrame) -> DataFrame:
    """Partial aggregates added up: counts and decimal sums exactly, distinct
    locations as the union of the parts' groups."""
    kinds = dict(parts.dtypes)
    out = parts.groupBy("gid", *DASHBOARD_KEYS).agg(
        *[F.sum(c).cast(kinds[c]).alias(c) for c in ("n", "amt", "amt_n", "succ", "ok_amt", "ok_amt_n")],
        F.min("min_amt").alias("min_amt"))
    return out


def _gid(key: str | None) -> int:
    """grouping_id of the set that groups by ``key`` only (None: grand total)."""
    n = len(DASHBOARD_KEYS)
    bits = 0
    for i, k in enumerate(DASHBOARD_KEYS):
        if k != key:
            bits |= 1 << (n - 1 - i)
    return bits


def _avg2(total, count):
    """round(total / count, 2) on decimals, as double; NULL for no rows."""
    return F.round(total / F.nullif(count, F.lit(0)), 2).cast("double")


def dashboard(base: DataFrame, dims: Dims, k: int = 10) -> dict[str, DataFrame]:
    """The 17 panels derived from :func:`dashboard_base` (same results as the
    single-panel functions above: counts and decimal sums add up exactly)."""
    def part(key):
        return base.filter(F.col("gid") == _gid(key))

    def by_dim(key, dim, label, alias, bound):
        d = dim.select(key, F.col(label).alias(alias))
        return part(key).join(bounded(d, bound), key)

    tot = part(None)
    out: dict[str, DataFrame] = {
        "panel_total_txns": tot.select(F.col("n").alias("value")),
        "panel_total_value": tot.select(F.col("amt").cast("decimal(22,2)").alias("value")),
        "panel_success_rate": tot.select(percent(F.col("succ"), F.col("n"), 2).alias("value")),
        "panel_avg_success_value": tot.select(_avg2(F.col("ok_amt"), F.col("ok_amt_n")).alias("value")),
        "panel_cities_covered": part("location_sk").agg(F.count("location_sk").alias("value")),
        "panel_hourly_volume": part("txn_hour").select(F.col("txn_hour").alias("hour"),
                                                       F.col("n").alias("transactions")).orderBy("hour"),
        "panel_amount_buckets": part("amount_bucket").orderBy("min_amt").select(
            "amount_bucket", F.col("n").alias("transactions")),
        "panel_weekday_weekend": part("is_weekend").select(
            buckets.day_type_label("is_weekend").alias("day_type"), F.col("n").alias("transactions"),
            _avg2(F.col("amt"), F.col("amt_n")).alias("avg_amount")),
    }
    fest = part("is_festival").filter(F.col("is_festival").isNotNull())
    labels = base.sparkSession.createDataFrame([(True, "Festival Day"), (False, "Normal Day")],
                                               "flag boolean, day string")
    out["panel_festival_vs_normal"] = labels.join(
        bounded(fest, 2), labels.flag == fest.is_festival, "left").select(
        "day", _avg2(F.col("amt"), F.col("amt_n")).alias("avg_amount"))
    dev = part("device_type").select(F.col("device_type").alias("device"), F.col("n").alias("transactions"))
    out["panel_device_share"] = with_share(dev, "transactions", "share_pct").orderBy(
        F.col("transactions").desc(), F.col("device"))
    days = by_dim("date_sk", dims.date, "date_day", "date_day", DIM_DATE_ROWS)
    out["panel_monthly_volume"] = (days.groupBy(F.date_trunc("month", "date_day").cast("date").alias("time"))
                                   .agg(F.sum("n").alias("transactions"),
                                        F.sum("amt").cast("decimal(22,2)").alias("amount_inr")).orderBy("time"))
    city = by_dim("location_sk", dims.location, "city", "city", LOCATION_BOUND)
    out["panel_top_cities"] = (city.groupBy("city").agg(F.sum("n").alias("transactions"),
                                                        scaled_millions("amt").alias("amount_m_inr"))
                               .orderBy(F.col("transactions").desc(), F.col("city")).limit(k))
    region = by_dim("location_sk", dims.location, "region", "region", LOCATION_BOUND)
    out["panel_region_volume"] = (region.groupBy("region").agg(F.sum("n").alias("transactions"),
                                                               scaled_millions("amt").alias("amount_m_inr"))
                                  .orderBy(F.col("transactions").desc(), F.col("region")))
    tier = by_dim("location_sk", dims.location, "tier", "tier", LOCATION_BOUND)
    out["panel_success_by_tier"] = (tier.groupBy("tier").agg(
        percent(F.sum("succ"), F.sum("n"), 2).alias("success_rate_pct")).orderBy("tier"))
    cat = by_dim("merchant_sk", dims.merchant, "category_name", "category",
                 relations.ROW_BOUND["merchant_categories"])
    out["panel_merchant_split"] = (cat.groupBy("category").agg(F.sum("n").alias("transactions"),
                                                               scaled_millions("amt").alias("amount_m_inr"))
                                   .orderBy(F.col("transactions").desc(), F.col("category")))
    app = by_dim("upi_app_sk", dims.upi_app, "app_name", "app", relations.ROW_BOUND["upi_apps"])
    app = app.groupBy("app").agg(F.sum("n").alias("transactions"))
    out["panel_app_share"] = with_share(app, "transactions", "share_pct").orderBy(
        F.col("transactions").desc(), F.col("app"))
    pay = by_dim("payment_type_sk", dims.payment_type, "type_name", "payment_type",
                 relations.ROW_BOUND["payment_types"])
    pay = pay.groupBy("payment_type").agg(F.sum("n").alias("transactions"))
    out["panel_payment_type_share"] = with_share(pay, "transactions", "share_pct").orderBy(
        F.col("transactions").desc(), F.col("payment_type"))
    return out


def refresh_dashboard(fact: DataFrame, dims: Dims, path: str) -> dict[str, DataFrame]:
    """Write the one-pass aggregate to ``path`` (shared folder) and return the
    17 panels read from it."""
    # after the merge of the partial groups: a few hundred rows
    dashboard_base(fact).repartition(1).write.mode("overwrite").parquet(path)
    return dashboard(fact.sparkSession.read.parquet(path), dims)


# --------------------------------------------------------------------------
# the dashboard kept up to date: partial aggregates per month of the fact
# --------------------------------------------------------------------------
def month_signatures(spark: SparkSession, fact_path: str) -> dict[tuple, str]:
    """What files each month of the fact has (names are never used twice, so
    equal signatures mean equal rows); listing only."""
    root = hadoop_path(spark, fact_path)[1].toUri().getPath().rstrip("/")
    months: dict[tuple, list] = {}
    for name, size in publish.files_below(spark, fact_path):
        inside = hadoop_path(spark, name)[1].toUri().getPath()[len(root) + 1:]
        values = [x.partition("=")[2] for x in inside.split("/")[:len(FACT_PARTITION_COLUMNS)]]
        month = tuple(None if v == "__HIVE_DEFAULT_PARTITION__" else int(v) for v in values)
        months.setdefault(month, []).append((inside, size))
    return {m: hashlib.md5(json.dumps(sorted(files)).encode()).hexdigest() for m, files in months.items()}


def _of_months(months: list[tuple]) -> Column:
    cond = F.lit(False)
    for values in months:
        one = F.lit(True)
        for c, v in zip(FACT_PARTITION_COLUMNS, values):
            one = one & F.col(c).eqNullSafe(F.lit(v).cast("int"))
        cond = cond | one
    return cond


def scan_months(fact: DataFrame, months: list[tuple]) -> DataFrame:
    """The fact's rows of some months (partition filters), aggregated per month."""
    return dashboard_base(fact.filter(_of_months(months)), FACT_PARTITION_COLUMNS)


def maintain_dashboard(spark: SparkSession, fact_path: str, dims: Dims, path: str) -> dict[str, DataFrame]:
    """The 17 panels from partial aggregates per month at ``path``, of which
    only months whose files changed are scanned again. The aggregates are
    staged and published through the manifest, as the fact is."""
    publish.recover(spark, path)
    now = month_signatures(spark, fact_path)
    known: dict[tuple, str] = {}
    if path_exists(spark, path):
        stored = spark.read.parquet(path).select(*FACT_PARTITION_COLUMNS, "signature").distinct().collect()  # a row a month
        known = {tuple(r)[:-1]: r.signature for r in stored}
    changed = sorted((m for m in now if known.get(m) != now[m]), key=str)
    gone = [m for m in known if m not in now]
    if changed or gone:
        kept = [m for m in known if m in now and m not in changed]
        signature = F.lit(None).cast("string")
        for m in changed:
            signature = F.when(_of_months([m]), F.lit(now[m])).otherwise(signature)
        parts = scan_months(spark.read.parquet(fact_path), changed).withColumn("signature", signature)
        if kept:
            parts = spark.read.parquet(path).filter(_of_months(kept)).unionByName(parts)
        # a few hundred rows a month, after the merge of the partial groups
        publish.rebuild_table(parts.repartition(1), path)
    base = merged_base(spark.read.parquet(path))
    merged = f"{path.rstrip('/')}__merged"
    base.repartition(1).write.mode("overwrite").parquet(merged)
    return dashboard(spark.read.parquet(merged), dims)
