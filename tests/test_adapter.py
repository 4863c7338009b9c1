"""The stand-in rows: every copy of a row, from tables that are read and joined once."""

import datetime as dt

from paylake.operators.dedup import latest_per_key
from paylake.sources import adapter


def _tables(spark, folder):
    at = dt.datetime(1995, 1, 2)
    keys = [None, 1, 2, 50, 500, 501, 1050, 1501]
    spark.createDataFrame([(k, 7, 1234.56, at, "2-HIGH") for k in keys],
                          "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp_ntz, "
                          "o_orderpriority string").coalesce(1).write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame([(7, "MACHINERY"), (8, "BUILDING")], "c_custkey long, c_mktsegment string").coalesce(
        1).write.parquet(f"{folder}/customer.parquet")


def test_copies_come_from_one_join(spark, tmp):
    _tables(spark, tmp)
    rows = adapter.lake_rows(spark, tmp)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2 and "Union" not in plan
    name = lambda k, end="": f"TXN{k:016d}{end}"
    got = rows.collect()
    assert sorted(r.txn_id for r in got if r.txn_id) == sorted(
        [name(k) for k in (1, 2, 50, 500, 501, 1050, 1501)] + [name(k) for k in (50, 500, 1050)] + [name(500, "Z")])
    assert sum(r.txn_id is None for r in got) == 4  # of 1, 501 and 1501, and of the order without a key
    first, second = sorted((r for r in got if r.txn_id == name(50)), key=lambda r: r.created_at)
    assert second.created_at - first.created_at == dt.timedelta(hours=1)
    assert (second.amount_inr, second.city, second.merchant_category, second.status) == (
        first.amount_inr + 1, f" {first.city.lower()} ", first.merchant_category.upper(), first.status.lower())
    assert [(r.amount_inr, r.city) for r in got if r.txn_id == name(500, "Z")] == [(0.0, first.city)]


def test_dedup_compares_hashes_before_keys(spark):
    rows = spark.createDataFrame([(f"TXN{k % 5:016d}", k) for k in range(20)] + [(None, 99)], "id string, n long")
    last = latest_per_key(rows, "id", [rows.n.desc()])
    assert sorted((r.id, r.n) for r in last.collect()) == [(f"TXN{k:016d}", 15 + k) for k in range(5)]
    assert "xxhash64" in last._jdf.queryExecution().executedPlan().toString()
