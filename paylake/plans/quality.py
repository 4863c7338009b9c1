"""Data-quality checks: each test counts its failing rows (zero = pass).

Failure counts follow the generic-test semantics of the modelled project:

* ``unique``           number of distinct non-NULL values that occur more than once
* ``not_null``         number of NULL rows
* ``accepted_values``  number of distinct non-NULL values outside the set
* ``relationships``    number of child rows whose non-NULL key has no parent

All tests of a table but ``unique`` are one scan: a row gives a token for each
test it fails, the tokens are counted per (test, column, value) with partial
sums before the shuffle and added up per test. Only failing rows make tokens,
so a table that passes shuffles nothing. ``unique`` columns of the large
tables are counted by 64-bit hashes, their values only where a hash occurs
twice (:mod:`paylake.operators.duplicates`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.operators.duplicates import duplicate_values
from paylake.operators.joins import bounded
from paylake.plans.models import DIM_DATE_ROWS, Dims
from paylake.sources import fixed, relations

STG_ACCEPTED = {
    "status": fixed.STATUSES,
    "merchant_category": [c[0] for c in fixed.MERCHANT_CATEGORIES],
    "upi_app": [a[0] for a in fixed.UPI_APPS],
}
STG_NOT_NULL = ["txn_id", "amount_inr", "status", "city", "merchant_category", "upi_app", "txn_date"]
FACT_NOT_NULL = ["txn_sk", "txn_id", "amount_inr", "location_sk", "date_sk", "merchant_sk",
                 "upi_app_sk", "payment_type_sk"]
FACT_UNIQUE = ["txn_sk", "txn_id"]
FACT_FKS = [("location_sk", "dim_location"), ("date_sk", "dim_date"), ("merchant_sk", "dim_merchant"),
            ("upi_app_sk", "dim_upi_app"), ("payment_type_sk", "dim_payment_type")]


def _token(check: str, column: str, when: Column | None = None, value: Column | None = None) -> Column:
    token = F.struct(F.lit(check).alias("check_name"), F.lit(column).alias("column_name"),
                     (F.lit(None) if value is None else value).cast("string").alias("value"))
    return token if when is None else F.when(when, token)


def run_tests(df: DataFrame, table: str, unique: list[str] = (), not_null: list[str] = (),
              accepted: dict[str, list[str]] | None = None,
              rows: list[tuple[str, str, Column]] = (), rate: bool = False, bound: int | None = None) -> DataFrame:
    """Failures of every named test of ``table``. ``rows`` are further row
    tests (column, check, fails?); ``rate`` adds the success-rate floor.
    ``bound``: rows the table can have at most, when that is few."""
    accepted = accepted or {}
    tokens = [] if bound is None else [_token("unique", c, F.col(c).isNotNull(), F.col(c)) for c in unique]
    tokens += [_token("not_null", c, F.col(c).isNull()) for c in not_null]
    tokens += [_token("accepted_values", c, ~F.col(c).isin(*ok), F.col(c)) for c, ok in accepted.items()]
    tokens += [_token(check, c, fails) for c, check, fails in rows]
    names = [("unique", c) for c in unique] + [("not_null", c) for c in not_null] \
        + [("accepted_values", c) for c in accepted] + [(check, c) for c, check, _ in rows]
    if rate:
        tokens += [_token("_rows", "is_success_int"), _token("_successful", "is_success_int",
                                                             F.col("is_success_int") == 1)]
        names.append(("assert_success_rate_above_threshold", "is_success_int"))
    none = F.array().cast("array<struct<check_name:string,column_name:string,value:string>>")
    counted = (df.select(F.explode(F.filter(F.array(*tokens), lambda t: t.isNotNull()) if tokens else none).alias("t"))
               .select("t.*").groupBy("check_name", "column_name", "value").agg(F.count(F.lit(1)).alias("n")))
    if unique and bound is None:
        counted = counted.unionByName(duplicate_values(df, list(unique)).select(
            F.lit("unique").alias("check_name"), "column_name", "value", "n"))
    failing = (F.when(F.col("check_name") == "unique", (F.col("n") > 1).cast("bigint"))
               .when(F.col("check_name") == "accepted_values", F.lit(1).cast("bigint")).otherwise(F.col("n")))
    found = counted.groupBy("check_name", "column_name").agg(F.sum(failing).alias("failures"))
    # a map of a few tens of tests, so that passing ones are reported too
    by_test = found.agg(F.map_from_entries(F.collect_list(F.struct(
        F.concat_ws("|", "check_name", "column_name"), "failures"))).alias("m"))

    def failures(check, column):
        return F.coalesce(F.col("m")[f"{check}|{column}"], F.lit(0))

    def result(check, column):
        if check != "assert_success_rate_above_threshold":
            return failures(check, column)
        share = failures("_successful", column) * F.lit(100.0) / F.nullif(failures("_rows", column), F.lit(0))
        return F.when(share < F.lit(fixed.SUCCESS_RATE_FLOOR), F.lit(1)).otherwise(F.lit(0))
    cells = [F.struct(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"),
                      F.lit(check).alias("check_name"), result(check, column).cast("bigint").alias("failures"))
             for check, column in names]
    return by_test.select(F.explode(F.array(*cells)).alias("r")).select("r.*")


def _dim_keys(dims: Dims) -> dict[str, tuple[DataFrame, str, int]]:
    return {
        "dim_location": (dims.location, "location_sk", len(fixed.CITY_MAPPING)),
        "dim_date": (dims.date, "date_sk", DIM_DATE_ROWS),
        "dim_merchant": (dims.merchant, "merchant_sk", relations.ROW_BOUND["merchant_categories"]),
        "dim_upi_app": (dims.upi_app, "upi_app_sk", relations.ROW_BOUND["upi_apps"]),
        "dim_payment_type": (dims.payment_type, "payment_type_sk", relations.ROW_BOUND["payment_types"]),
    }


def relationship_tests(fact: DataFrame, dims: Dims) -> tuple[DataFrame, list[tuple[str, str, Column]]]:
    """The fact with each key's parent looked up, and the five row tests."""
    keys, tests = _dim_keys(dims), []
    for col, dim in FACT_FKS:
        d, key, bound = keys[dim]
        parent = d.select(F.col(key).alias(f"__p_{col}")).withColumn(f"__hit_{col}", F.lit(True))
        fact = fact.join(bounded(parent, bound), fact[col] == parent[f"__p_{col}"], "left")
        tests.append((col, "relationships", F.col(col).isNotNull() & F.col(f"__hit_{col}").isNull()))
    return fact, tests


def fact_tests(fact: DataFrame, dims: Dims) -> DataFrame:
    """All fact tests: 2 unique, 8 not-null, accepted status, 5 relationships,
    no non-positive amount, success-rate floor."""
    looked_up, tests = relationship_tests(fact, dims)
    tests.append(("amount_inr", "assert_no_negative_amounts", F.col("amount_inr") <= 0))
    return run_tests(looked_up, "fact_transactions", FACT_UNIQUE, FACT_NOT_NULL, {"status": fixed.STATUSES},
                     tests, rate=True)


def dim_tests(dims: Dims, unique: bool = True, not_null: bool = True, accepted: bool = True) -> DataFrame:
    """Unique / not-null / accepted tests of the five dimensions (731 rows at most)."""
    specs = [
        ("dim_location", dims.location, ["location_sk", "city"], {"tier": fixed.TIERS}),
        ("dim_date", dims.date, ["date_sk", "date_day"], {}),
        ("dim_merchant", dims.merchant, ["merchant_sk", "category_code"], {}),
        ("dim_upi_app", dims.upi_app, ["upi_app_sk"], {}),
        ("dim_payment_type", dims.payment_type, ["payment_type_sk"], {}),
    ]
    out = None
    for table, df, keys, values in specs:
        values = values if accepted else {}
        if not (unique or not_null or values):
            continue
        part = run_tests(df, table, keys if unique else [], keys if not_null else [], values, bound=DIM_DATE_ROWS)
        out = part if out is None else out.unionByName(part)
    return out


def dq_report(stg: DataFrame, fact: DataFrame, dims: Dims) -> DataFrame:
    """All 46 tests of the project as one table (table, column, check, failures):
    one scan of staging, one of the fact."""
    return (run_tests(stg, "stg_transactions", ["txn_id"], STG_NOT_NULL, STG_ACCEPTED)
            .unionByName(fact_tests(fact, dims)).unionByName(dim_tests(dims)))


def dq_unique(stg, fact, dims) -> DataFrame:
    """The eleven unique tests (staging, fact, dimensions)."""
    return (run_tests(stg, "stg_transactions", ["txn_id"])
            .unionByName(run_tests(fact, "fact_transactions", FACT_UNIQUE))
            .unionByName(dim_tests(dims, not_null=False, accepted=False)))


def dq_not_null(stg, fact, dims) -> DataFrame:
    """The twenty-three not-null tests."""
    return (run_tests(stg, "stg_transactions", not_null=STG_NOT_NULL)
            .unionByName(run_tests(fact, "fact_transactions", not_null=FACT_NOT_NULL))
            .unionByName(dim_tests(dims, unique=False, accepted=False)))


def dq_accepted_values(stg, fact, dims) -> DataFrame:
    """The five accepted-values tests."""
    return (run_tests(stg, "stg_transactions", accepted=STG_ACCEPTED)
            .unionByName(run_tests(fact, "fact_transactions", accepted={"status": fixed.STATUSES}))
            .unionByName(dim_tests(dims, unique=False, not_null=False)))


def dq_relationships(fact: DataFrame, dims: Dims) -> DataFrame:
    """The five fact-to-dimension relationship tests."""
    looked_up, tests = relationship_tests(fact.select(*[c for c, _ in FACT_FKS]), dims)
    return run_tests(looked_up, "fact_transactions", rows=tests)


def dq_no_negative_amounts(fact: DataFrame) -> DataFrame:
    """The failing rows themselves: fact rows with amount <= 0."""
    return fact.filter(F.col("amount_inr") <= 0)


def dq_success_rate_floor(fact: DataFrame) -> DataFrame:
    """One row (total, successful) when the success rate is below the floor;
    an empty fact has a NULL rate and passes."""
    stats = fact.agg(F.count(F.lit(1)).alias("total"), F.sum("is_success_int").alias("successful"))
    rate = F.col("successful") * F.lit(100.0) / F.nullif(F.col("total"), F.lit(0))
    return stats.filter(rate < F.lit(fixed.SUCCESS_RATE_FLOOR))


# --------------------------------------------------------------------------
# source-row rules (lake rows as the source writes them)
# --------------------------------------------------------------------------
def row_rule_flags(lake: DataFrame) -> list[tuple[str, Column]]:
    """(rule, violated?) per row; NULL-safe (a NULL input violates its rule)."""
    cities = relations.source_city_names()
    ok = {
        "txn_id_not_null": F.col("txn_id").isNotNull(),
        "txn_id_prefix": F.coalesce(F.col("txn_id").startswith(fixed.TXN_PREFIX), F.lit(False)),
        "hour_in_range": F.coalesce(F.col("txn_hour").between(0, 23), F.lit(False)),
        "sender_upi_has_at": F.coalesce(F.col("sender_upi").contains("@"), F.lit(False)),
        "receiver_upi_has_at": F.coalesce(F.col("receiver_upi").contains("@"), F.lit(False)),
        "amount_positive": F.coalesce(F.col("amount_inr") > 0, F.lit(False)),
        "status_valid": F.coalesce(F.col("status").isin(*fixed.STATUSES), F.lit(False)),
        "reason_null_on_success": ~((F.col("status") == "SUCCESS") & F.col("failure_reason").isNotNull())
        | F.col("status").isNull(),
        "reason_set_on_failed": ~((F.col("status") == "FAILED") & F.col("failure_reason").isNull())
        | F.col("status").isNull(),
        "city_known": F.coalesce(F.col("city").isin(*cities), F.lit(False)),
        "app_known": F.coalesce(F.col("upi_app").isin(*fixed.SOURCE_APP_NAMES), F.lit(False)),
    }
    return [(name, ~F.coalesce(cond, F.lit(False))) for name, cond in ok.items()]


def dq_row_rules(lake: DataFrame) -> DataFrame:
    """Failing rows per source rule, one scan; plus duplicate ids and missing columns."""
    from paylake import schema
    flags = row_rule_flags(lake)
    agg = lake.agg(*[F.count_if(v).alias(f"c{i}") for i, (_, v) in enumerate(flags)])
    structs = [F.struct(F.lit(n).alias("rule"), F.col(f"c{i}").cast("bigint").alias("failures"))
               for i, (n, _) in enumerate(flags)]
    counts = agg.select(F.explode(F.array(*structs)).alias("r")).select("r.*")
    dup = (duplicate_values(lake, ["txn_id"])
           .agg(F.count(F.lit(1)).cast("bigint").alias("failures"))
           .select(F.lit("txn_id_unique").alias("rule"), "failures"))
    missing = len([c for c in schema.LAKE_COLUMNS if c not in lake.columns])
    cols = lake.sparkSession.range(1).select(F.lit("required_columns").alias("rule"),
                                             F.lit(missing).cast("bigint").alias("failures"))
    return counts.unionByName(dup).unionByName(cols)


def quarantine(lake: DataFrame) -> DataFrame:
    """Rows breaking at least one source rule, with the names of the rules."""
    flags = row_rule_flags(lake)
    broken = F.filter(F.array(*[F.when(v, F.lit(n)) for n, v in flags]), lambda x: x.isNotNull())
    return lake.withColumn("violations", broken).filter(F.size("violations") > 0)


def dq_quarantine(lake: DataFrame) -> DataFrame:
    """The quarantined rows: id, amount, city and the rules broken."""
    return quarantine(lake).select("txn_id", "amount_inr", "city", "created_at",
                                   F.array_join("violations", ",").alias("violations"))


def dq_amount_in_category_range(lake: DataFrame) -> DataFrame:
    """Per category: rows and rows outside the category's [min, max] amount."""
    ranges = relations.category_ranges(lake.sparkSession)
    j = lake.select("merchant_category", "amount_inr").join(
        bounded(ranges, relations.ROW_BOUND["category_ranges"]),
        F.col("merchant_category") == ranges.category_code, "inner")
    out = ~F.col("amount_inr").between(F.col("min_amount"), F.col("max_amount"))
    return j.groupBy("category_code").agg(F.count(F.lit(1)).alias("rows"),
                                          F.count_if(out).alias("out_of_range"))


def dq_calendar_flags(lake: DataFrame) -> DataFrame:
    """Rows whose weekend / festival flag disagrees with their date."""
    from paylake.functions.calendar import is_source_festival, is_weekend_day
    agg = lake.agg(
        F.count_if(~F.col("is_weekend").eqNullSafe(is_weekend_day("txn_date"))).alias("w"),
        F.count_if(~F.col("is_festival").eqNullSafe(is_source_festival("txn_date"))).alias("f"))
    return agg.select(F.explode(F.array(
        F.struct(F.lit("is_weekend").alias("flag"), F.col("w").cast("bigint").alias("failures")),
        F.struct(F.lit("is_festival").alias("flag"), F.col("f").cast("bigint").alias("failures")),
    )).alias("r")).select("r.*")


def dq_festival_disagreement(fact: DataFrame, dims: Dims) -> DataFrame:
    """Days where the fact's festival flag and the calendar's festival day differ."""
    d = dims.date.select("date_sk", "date_day", "is_festival_day")
    j = fact.select("date_sk", "is_festival").join(bounded(d, DIM_DATE_ROWS), "date_sk")
    return (j.filter(~F.col("is_festival").eqNullSafe(F.col("is_festival_day")))
            .groupBy("date_day", "is_festival", "is_festival_day")
            .agg(F.count(F.lit(1)).alias("transactions")))
