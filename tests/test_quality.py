"""Data-quality tests on small frames: each check must fire exactly when it should."""

import datetime as dt
from decimal import Decimal

from paylake import schema
from paylake.plans import models, quality
from paylake.sources import ingest


def _dims(spark, fact):
    return models.Dims(models.dim_date(spark), models.dim_location_from_fact(fact), models.dim_merchant(spark),
                       models.dim_upi_app(spark), models.dim_payment_type(spark))


def _fact(spark, rows):
    raw_rows = []
    base = dict(txn_id=None, amount_inr=Decimal("10.00"), city="Mumbai", state="Maharashtra",
                merchant_category="retail", upi_app="PhonePe", payment_type="p2m", status="SUCCESS",
                failure_reason=None, txn_date=dt.date(2024, 1, 15), txn_hour=10, is_weekend=False,
                is_festival=False, sender_upi="a@ok", receiver_upi="b@ok", device_type="Android",
                created_at=dt.datetime(2024, 1, 15, 10), loaded_at=dt.datetime(2024, 1, 16))
    for r in rows:
        full = {**base, **r}
        raw_rows.append(tuple(full[c] for c in schema.RAW_COLUMNS))
    raw = spark.createDataFrame(raw_rows, schema.RAW_SCHEMA)
    return raw, models.fact_from_raw(raw)


def _failures(report):
    return {(r.table_name, r.column_name, r.check_name): r.failures for r in report.collect()}


def test_report_has_46_tests_and_flags_problems(spark):
    raw, fact = _fact(spark, [
        dict(txn_id="A"), dict(txn_id="B", status="weird"), dict(txn_id="C", city="Atlantis"),
        dict(txn_id="D", upi_app="NoPay"), dict(txn_id="E", txn_date=dt.date(2030, 1, 1)),
    ])
    stg = models.stg_transactions(raw)
    got = _failures(quality.dq_report(stg, fact, _dims(spark, fact)))
    assert len(got) == 46
    assert got[("stg_transactions", "status", "accepted_values")] == 1
    assert got[("fact_transactions", "status", "accepted_values")] == 1
    assert got[("stg_transactions", "upi_app", "accepted_values")] == 1
    assert got[("fact_transactions", "location_sk", "not_null")] == 1     # unmapped city
    assert got[("fact_transactions", "upi_app_sk", "not_null")] == 1
    assert got[("fact_transactions", "date_sk", "not_null")] == 1         # outside the calendar
    assert got[("fact_transactions", "location_sk", "relationships")] == 0  # NULL keys are not orphans
    assert got[("fact_transactions", "txn_sk", "unique")] == 0
    assert got[("dim_date", "date_sk", "unique")] == 0


def test_duplicate_and_orphan_keys(spark):
    _, fact = _fact(spark, [dict(txn_id="A"), dict(txn_id="B")])
    dup = fact.unionByName(fact.filter("txn_id = 'A'"))
    assert _failures(quality.run_tests(dup, "f", ["txn_id"]))[("f", "txn_id", "unique")] == 1
    orphan = fact.withColumn("merchant_sk", fact.txn_sk)  # keys no dimension has
    rel = _failures(quality.dq_relationships(orphan, _dims(spark, fact)))
    assert rel[("fact_transactions", "merchant_sk", "relationships")] == 2


def test_success_rate_floor(spark):
    def rate_rows(n_ok, n_bad):
        rows = [dict(txn_id=f"S{i}") for i in range(n_ok)] + \
               [dict(txn_id=f"F{i}", status="FAILED", failure_reason="x") for i in range(n_bad)]
        return _fact(spark, rows)[1]
    assert quality.dq_success_rate_floor(rate_rows(8499, 1501)).count() == 1   # 84.99 %
    assert quality.dq_success_rate_floor(rate_rows(85, 15)).count() == 0       # exactly 85 %
    empty = rate_rows(1, 0).limit(0)
    assert quality.dq_success_rate_floor(empty).count() == 0                 # NULL rate passes


def test_ingest_of_an_empty_lake_folder(spark, tmp):
    import os
    os.makedirs(f"{tmp}/lake")
    ingest.ingest_batch(spark, f"{tmp}/lake", f"{tmp}/raw", f"{tmp}/log")
    assert not os.path.exists(f"{tmp}/raw")


def test_duplicates_are_found_without_shuffling_the_values(spark):
    """Only hashes meet in an exchange while nothing is repeated; repeated and hot values are counted exactly."""
    from pyspark.sql import functions as F

    from paylake.operators.duplicates import duplicate_values
    df = spark.range(5000).select(F.concat(F.lit("key-"), F.col("id")).alias("a"), (F.col("id") % 4000).alias("b"),
                                  F.when(F.col("id") < 3000, F.lit("hot")).alias("c"))
    assert sorted(map(tuple, duplicate_values(df, ["a", "c"]).collect())) == [("c", "hot", 3000)]
    got = duplicate_values(df, ["b"])
    assert got.count() == 1000 and {(r.column_name, r.n) for r in got.collect()} == {("b", 2)}
    assert duplicate_values(df, ["a"]).collect() == []
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    joins = [ln for ln in plan.splitlines() if "Join" in ln]
    assert joins and all("BroadcastHashJoin" in ln for ln in joins), plan


def test_colliding_hashes_are_no_duplicates(spark, monkeypatch):
    """With a hash of two values only, different values share one; they are told apart."""
    from pyspark.sql import functions as F

    from paylake.operators import duplicates
    monkeypatch.setattr(duplicates.F, "xxhash64", lambda c: F.length(F.col(c)).cast("long"))
    df = spark.createDataFrame([("aa",), ("bb",), ("cc",), ("bb",), (None,), (None,)], "k string")
    assert [tuple(r) for r in duplicates.duplicate_values(df, ["k"]).collect()] == [("k", "bb", 2)]
