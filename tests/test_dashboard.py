"""The one-pass dashboard equals the single-panel queries."""

from paylake.plans import models, panels
from paylake.sources import adapter


def test_dashboard_matches_single_panels(spark, tmp):
    raw = adapter.raw_rows(spark, "/root/testdata/sf0.01")
    fact_path = f"{tmp}/fact"
    models.fact_from_raw(raw).write.parquet(fact_path)
    fact = spark.read.parquet(fact_path)
    dims = models.Dims(models.dim_date(spark), models.dim_location_from_fact(fact), models.dim_merchant(spark),
                       models.dim_upi_app(spark), models.dim_payment_type(spark))
    board = panels.refresh_dashboard(fact, dims, f"{tmp}/board")
    assert sorted(board) == panels.PANEL_NAMES
    for name in panels.PANEL_NAMES:
        one = panels.run_panel(name, fact, dims)
        assert board[name].columns == one.columns, name
        assert sorted(map(tuple, board[name].collect())) == sorted(map(tuple, one.collect())), name
    scans = panels.dashboard_base(fact)._jdf.queryExecution().executedPlan().toString().count("FileScan")
    assert scans == 1


def test_a_second_refresh_scans_touched_months_only(spark, tmp, monkeypatch):
    """After an upsert of a few rows, only their months are scanned again, and
    the panels equal the seventeen single queries."""
    from paylake.plans import models, panels
    from paylake.sources import adapter
    raw_path, path, base = f"{tmp}/raw", f"{tmp}/fact", f"{tmp}/base"
    adapter.raw_rows(spark, "/root/testdata/sf0.001").write.parquet(raw_path)
    raw = spark.read.parquet(raw_path)
    dims = models.dims(spark, models.stg_transactions(raw))
    scanned, scan = [], panels.scan_months
    monkeypatch.setattr(panels, "scan_months", lambda fact, months: scanned.append(months) or scan(fact, months))

    def check():
        fact = spark.read.parquet(path)
        board = panels.maintain_dashboard(spark, path, dims, base)
        assert sorted(board) == panels.PANEL_NAMES
        for name, df in board.items():
            want = panels.run_panel(name, fact, dims)
            assert df.columns == want.columns
            assert sorted(map(str, df.collect())) == sorted(map(str, want.collect())), name
        return fact
    models.fact_incremental(spark, raw.filter("created_at < '2024-06-15'"), path)
    fact = check()
    months = fact.select("txn_year", "txn_month").distinct().count()
    assert len(scanned.pop()) == months
    panels.maintain_dashboard(spark, path, dims, base)
    assert scanned == []  # nothing changed
    from paylake.operators.upsert import upsert
    few = fact.filter("txn_year = 2023 and txn_month = 5").limit(3).select(*fact.columns)
    moved = few.withColumn("txn_month", few.txn_month * 0 + 9).withColumn("amount_inr", (few.amount_inr + 1).cast("decimal(12,2)"))
    upsert(spark, moved, path)
    check()
    assert scanned == [[(2023, 5), (2023, 9)]]
