"""The end-to-end run over a lake written from the sf0.001 tables."""

from paylake import refresh
from paylake.plans import models
from paylake.sources import adapter, lake


def test_refresh_end_to_end_and_rerun(spark, tmp):
    root = f"{tmp}/lake"
    lake.write_lake(adapter.lake_rows(spark, "/root/testdata/sf0.001"), root)
    out = refresh.run(spark, root, f"{tmp}/wh", stream=True)
    assert out["tests"] == 46
    failed = {(t["table_name"], t["column_name"], t["check_name"]) for t in out["tests_failed"]}
    # the stand-in data has cities without a dimension row, on purpose
    assert ("fact_transactions", "location_sk", "not_null") in failed
    fact = spark.read.parquet(out["tables"]["fact_transactions"])
    n = fact.count()
    assert n > 0
    board = spark.read.parquet(f"{tmp}/wh/dashboard/panel_total_txns").first()[0]
    assert board == n
    again = refresh.run(spark, root, f"{tmp}/wh", stream=True)  # nothing new: same tables
    assert spark.read.parquet(again["tables"]["fact_transactions"]).count() == n
    assert again["files_loaded"] == out["files_loaded"]
