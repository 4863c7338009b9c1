"""Keyed upsert on the partitioned fact: lookback, moves, empty months, schema sync."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from paylake.operators import publish
from paylake.operators.upsert import read_target, upsert
from paylake.plans.models import lookback_cutoff

COLS = "txn_sk string, amount_inr decimal(12,2), created_at timestamp, txn_year int, txn_month int"


def _rows(spark, rows, cols=COLS):
    return spark.createDataFrame(rows, cols)


def test_first_run_then_replace_insert_and_move(spark, tmp):
    path = f"{tmp}/fact"
    t = dt.datetime(2024, 1, 31, 23)
    assert upsert(spark, _rows(spark, [("a", Decimal("1"), t, 2024, 1), ("b", Decimal("2"), t, 2024, 1),
                                       ("c", Decimal("3"), t, 2023, 12)]), path) == "full"
    # 'a' changes, 'c' moves from 2023-12 to 2024-02 (its old month becomes empty), 'd' is new
    new = _rows(spark, [("a", Decimal("10"), t, 2024, 1), ("c", Decimal("30"), t, 2024, 2),
                        ("d", Decimal("4"), t, 2024, 2)])
    assert upsert(spark, new, path) == "incremental"
    got = {r.txn_sk: (r.amount_inr, r.txn_year, r.txn_month) for r in spark.read.parquet(path).collect()}
    assert got == {"a": (Decimal("10.00"), 2024, 1), "b": (Decimal("2.00"), 2024, 1),
                   "c": (Decimal("30.00"), 2024, 2), "d": (Decimal("4.00"), 2024, 2)}
    import os
    assert not os.path.exists(f"{path}/txn_year=2023/txn_month=12")


def test_lookback_is_strict(spark, tmp):
    path = f"{tmp}/fact"
    t = dt.datetime(2024, 1, 31, 23)
    upsert(spark, _rows(spark, [("a", Decimal("1"), t, 2024, 1)]), path)
    cutoff = lookback_cutoff(spark.read.parquet(path))
    cand = _rows(spark, [("x", Decimal("1"), t - dt.timedelta(hours=1), 2024, 1),
                         ("y", Decimal("1"), t - dt.timedelta(minutes=59), 2024, 1)])
    assert [r.txn_sk for r in cand.filter(F.col("created_at") > cutoff).collect()] == ["y"]


def test_columns_follow_the_model(spark, tmp):
    path = f"{tmp}/fact"
    t = dt.datetime(2024, 1, 31, 23)
    upsert(spark, _rows(spark, [("a", Decimal("1"), t, 2024, 1), ("b", Decimal("2"), t, 2024, 3)]), path)
    v2 = "txn_sk string, note string, created_at timestamp, txn_year int, txn_month int"
    upsert(spark, _rows(spark, [("b", "new", t, 2024, 3)], v2), path)
    df = spark.read.parquet(path)
    assert "amount_inr" not in df.columns and "note" in df.columns
    assert {r.txn_sk: r.note for r in df.collect()} == {"a": None, "b": "new"}


def test_incremental_fact_is_idempotent(spark, tmp):
    """Running the incremental build again on the same raw leaves the same table."""
    from paylake.plans import models
    from paylake.plans.scenarios import first_run_rows
    from paylake.sources import adapter
    raw_path = f"{tmp}/raw"
    adapter.raw_rows(spark, "/root/testdata/sf0.001").write.parquet(raw_path)
    raw = spark.read.parquet(raw_path)
    path = f"{tmp}/fact"
    assert models.fact_incremental(spark, first_run_rows(raw), path) == "full"
    assert models.fact_incremental(spark, raw, path) == "incremental"
    once = sorted(map(tuple, spark.read.parquet(path).collect()))
    assert models.fact_incremental(spark, raw, path) == "incremental"
    twice = sorted(map(tuple, spark.read.parquet(path).collect()))
    assert once == twice and len(once) > 0


def test_empty_target_counts_as_first_run(spark, tmp):
    from paylake import schema
    from paylake.plans import models
    from paylake.sources import adapter
    raw = adapter.raw_rows(spark, "/root/testdata/sf0.001")
    path = f"{tmp}/fact"
    models.fact_from_raw(raw).limit(0).write.partitionBy(*schema.FACT_PARTITION_COLUMNS).parquet(path)
    models.fact_incremental(spark, raw, path)
    assert spark.read.parquet(path).count() == models.fact_from_raw(raw).count()


def test_null_partition_rows_survive_an_upsert(spark, tmp):
    path = f"{tmp}/fact"
    t = dt.datetime(2024, 1, 31, 23)
    upsert(spark, _rows(spark, [("a", Decimal("1"), t, None, None), ("b", Decimal("2"), t, None, None),
                                ("c", Decimal("3"), t, 2024, 1)]), path)
    upsert(spark, _rows(spark, [("a", Decimal("10"), t, None, None)]), path)
    got = {r.txn_sk: r.amount_inr for r in spark.read.parquet(path).collect()}
    assert got == {"a": Decimal("10.00"), "b": Decimal("2.00"), "c": Decimal("3.00")}


class Crash(Exception):
    pass


def _crash(*args):
    raise Crash


def _two_versions(spark):
    t = dt.datetime(2024, 1, 31, 23)
    old = _rows(spark, [("a", Decimal("1"), t, 2024, 1), ("b", Decimal("2"), t, 2024, 1), ("c", Decimal("3"), t, 2023, 12),
                        ("e", Decimal("5"), t, 2024, 2)])
    new = _rows(spark, [("a", Decimal("10"), t, 2024, 1), ("c", Decimal("30"), t, 2024, 2), ("d", Decimal("4"), t, 2024, 2)])
    return old, new


def _table(spark, path):
    return sorted(map(str, read_target(spark, path).collect()))


def _leftovers(tmp):
    import os
    return [n for n in os.listdir(tmp) if "__" in n and not n.endswith(".crc")]


@pytest.mark.parametrize("where", ["before the manifest", "before the swap", "in the swap", "before dropping emptied"])
def test_crash_is_repaired_by_the_next_run(spark, tmp, monkeypatch, where):
    old, new = _two_versions(spark)
    plain, path = f"{tmp}/plain", f"{tmp}/fact"
    for p in (plain, path):
        upsert(spark, old, p)
    upsert(spark, new, plain)
    with monkeypatch.context() as m:
        if where == "before the manifest":
            m.setattr(publish, "_write_text", _crash)
        elif where == "before the swap":
            m.setattr(publish, "_perform", _crash)
        elif where == "in the swap":
            add_files = publish.add_files

            def half(spark, moves):
                add_files(spark, moves[:1])
                raise Crash
            m.setattr(publish, "add_files", half)
        else:
            m.setattr(publish, "drop_files", _crash)
        with pytest.raises(Crash):
            upsert(spark, new, path)
    upsert(spark, new, path)  # the rerun
    assert _table(spark, path) == _table(spark, plain)
    assert where == "before the manifest" or not _leftovers(tmp)


@pytest.mark.parametrize("where", ["before the swap", "between the renames"])
def test_crash_of_a_full_rewrite_is_repaired(spark, tmp, monkeypatch, where):
    import os
    old, new = _two_versions(spark)
    path = f"{tmp}/dim"
    publish.rebuild_table(old, path)
    with monkeypatch.context() as m:
        if where == "before the swap":
            m.setattr(publish, "_perform", _crash)
        else:
            def half(spark, staging, path):
                os.rename(path, f"{path}__old")  # the reader sees no table until this is repaired
                raise Crash
            m.setattr(publish, "swap_table", half)
        with pytest.raises(Crash):
            publish.rebuild_table(new, path)
    assert _table(spark, path) == sorted(map(str, new.collect()))
    assert not _leftovers(tmp)


def test_a_rename_that_fails_raises(spark, tmp, monkeypatch):
    """Some stores answer a failed rename with false: nothing is deleted, and the next run finishes."""
    path = f"{tmp}/table"
    publish.rebuild_table(spark.range(3), path)
    hadoop_path = publish.hadoop_path

    class Store:
        def __init__(self, fs):
            self.fs = fs

        def rename(self, old, new):
            return "__staging" not in old.getName() and self.fs.rename(old, new)

        def __getattr__(self, name):
            return getattr(self.fs, name)
    with monkeypatch.context() as m:
        m.setattr(publish, "hadoop_path", lambda spark, p: (Store(hadoop_path(spark, p)[0]), hadoop_path(spark, p)[1]))
        with pytest.raises(OSError, match="could not rename"):
            publish.rebuild_table(spark.range(5), path)
    assert read_target(spark, path).count() == 5 and not _leftovers(tmp)


def _file_names(path):
    import os
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet"))


def test_only_files_that_hold_a_key_are_written_again(spark, tmp, monkeypatch):
    """Two months of daily files: an upsert of one old row and a new one rewrites that row's file alone,
    whether its keys are looked up by Bloom filters or by a join."""
    import os

    from paylake.operators import upsert as module
    t = dt.datetime(2024, 1, 1)
    for few in (1_000, 0):
        monkeypatch.setattr(module, "FEW_KEYS", few)
        path = f"{tmp}/fact{few}"
        for day in range(20):
            at = t + dt.timedelta(days=3 * day)
            upsert(spark, _rows(spark, [(f"k{day}-{i}", Decimal(i), at, at.year, at.month) for i in range(50)]).coalesce(1), path)
        before = _file_names(path)
        size = sum(map(os.path.getsize, before))
        late = t + dt.timedelta(days=59)
        done = upsert(spark, _rows(spark, [("k4-7", Decimal(900), late, late.year, late.month),
                                           ("new", Decimal(1), late, late.year, late.month)]), path)
        assert done == "incremental" and done.files_rewritten == 1 and 0 < done.bytes_rewritten < size / 10
        assert len(set(before) - set(_file_names(path))) == 1
        got = {r.txn_sk: r for r in spark.read.parquet(path).collect()}
        assert len(got) == 1001 and got["k4-7"].txn_month == 2 and float(got["k4-7"].amount_inr) == 900


def test_keys_that_no_file_holds_read_no_key_pages(spark, tmp):
    from test_plans import _rows_scanned

    from paylake.session import pushed_in
    path, t = f"{tmp}/fact", dt.datetime(2024, 1, 1)
    upsert(spark, _rows(spark, [(f"k{i:04d}", Decimal(i), t, 2024, 1 + i % 3) for i in range(600)]), path)
    with pushed_in(spark, 20):
        found = spark.read.parquet(path).select("txn_sk").filter(F.col("txn_sk").isin([f"k{i:04d}x" for i in range(20)]))
        assert found.collect() == [] and _rows_scanned(found) < 300


def test_column_changes_leave_other_files_alone(spark, tmp):
    """A column is added, one dropped, and one comes back: NULL in rows written without it."""
    path, t = f"{tmp}/fact", dt.datetime(2024, 1, 31, 23)
    upsert(spark, _rows(spark, [("a", Decimal("1"), t, 2024, 1), ("b", Decimal("2"), t, 2024, 3)]), path)
    old = [f for f in _file_names(path) if "txn_month=1" in f]
    v2 = "txn_sk string, note string, created_at timestamp, txn_year int, txn_month int"
    assert upsert(spark, _rows(spark, [("b", "new", t, 2024, 3)], v2), path) == "incremental"
    assert [f for f in _file_names(path) if "txn_month=1" in f] == old
    assert {r.txn_sk: r.note for r in spark.read.parquet(path).collect()} == {"a": None, "b": "new"}
    assert publish.dropped_columns(spark, path) == ["amount_inr"]
    v3 = "txn_sk string, note string, amount_inr decimal(12,2), created_at timestamp, txn_year int, txn_month int"
    assert upsert(spark, _rows(spark, [("c", "x", Decimal("3"), t, 2024, 4)], v3), path) == "full"
    got = {r.txn_sk: (r.note, r.amount_inr) for r in spark.read.parquet(path).collect()}
    assert got == {"a": (None, None), "b": ("new", None), "c": ("x", Decimal("3.00"))}
    assert publish.dropped_columns(spark, path) == []


def test_small_files_of_a_partition_are_written_as_one(spark, tmp, monkeypatch):
    from paylake.operators import upsert as module
    monkeypatch.setattr(module, "COMPACT_FILES", 4)
    path, t = f"{tmp}/fact", dt.datetime(2024, 1, 1)
    for i in range(9):
        upsert(spark, _rows(spark, [(f"k{i}", Decimal(i), t, 2024, 1)]).coalesce(1), path)
        assert len(_file_names(path)) <= 5
    assert sorted(r.txn_sk for r in spark.read.parquet(path).collect()) == [f"k{i}" for i in range(9)]
