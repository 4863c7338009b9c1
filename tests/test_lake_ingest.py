"""Lake sink/scan, incremental ingest, failed-file isolation and retry."""

import datetime as dt
import os

from pyspark.sql import functions as F

from paylake import schema
from paylake.sources import ingest, lake


def _lake_rows(spark, rows):
    base = dict(txn_id="TXN0", amount_inr=10.0, city="Mumbai", merchant_category="retail", upi_app="PhonePe",
                payment_type="p2m", status="SUCCESS", failure_reason=None, txn_date=dt.date(2024, 1, 15),
                txn_hour=10, is_weekend=False, is_festival=False, sender_upi="a@ok", receiver_upi="b@ok",
                device_type="Android", created_at=dt.datetime(2024, 1, 15, 10))
    full = [{**base, **r} for r in rows]
    return spark.createDataFrame([tuple(r[c] for c in schema.LAKE_COLUMNS) for r in full], schema.LAKE_SCHEMA)


def test_write_and_scan_keep_true_city(spark, tmp):
    df = _lake_rows(spark, [dict(txn_id="TXN1", city="Navi Mumbai"), dict(txn_id="TXN2", city="Mira-Bhayandar"),
                            dict(txn_id="TXN3", txn_date=dt.date(2023, 3, 5))])
    root = f"{tmp}/lake"
    lake.write_lake(df, root)
    dirs = sorted(os.path.relpath(d, root) for d, _, fs in os.walk(root) if any(f.endswith(".parquet") for f in fs))
    assert "year=2024/month=01/city_part=Navi_Mumbai" in dirs
    assert "year=2023/month=03/city_part=Mumbai" in dirs
    assert sorted(r.city for r in lake.scan_lake(spark, root).collect()) == ["Mira-Bhayandar", "Mumbai", "Navi Mumbai"]
    pruned = lake.scan_pruned(spark, root, month="01", city="Navi Mumbai")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "city_part" in plan
    assert [r.txn_id for r in pruned.collect()] == ["TXN1"]


def test_rerun_replaces_only_touched_folders(spark, tmp):
    root = f"{tmp}/lake"
    lake.write_lake(_lake_rows(spark, [dict(txn_id="A"), dict(txn_id="B", city="Delhi")]), root)
    lake.write_lake(_lake_rows(spark, [dict(txn_id="A2")]), root)
    assert sorted(r.txn_id for r in lake.scan_lake(spark, root).collect()) == ["A2", "B"]


def test_max_rows_per_file_is_a_cap(spark, tmp):
    root = f"{tmp}/lake"
    lake.write_lake(_lake_rows(spark, [dict(txn_id=f"T{i}") for i in range(7)]), root, max_rows_per_file=3)
    rows = sorted(r.rows for r in lake.rows_per_file(spark, root).collect())
    assert max(rows) <= 3 and sum(rows) == 7


def test_capped_write_makes_one_file_on_disk_for_each_data_file(spark, tmp):
    """No .crc file beside each file of three rows (each cost two more processes);
    every row is kept, and folders of an earlier checksummed write are replaced whole."""
    root, key = f"{tmp}/lake", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    lake.write_lake(_lake_rows(spark, [dict(txn_id="old"), dict(txn_id="kept", city="Delhi")]), root)
    before = spark.conf.get(key)
    rows = [dict(txn_id=None if i == 5 else f"T{i:02d}", city=["Mumbai", "Navi Mumbai"][i % 5 == 0], amount_inr=i / 4)
            for i in range(40)] + [dict(txn_id="T01")]
    lake.write_lake(_lake_rows(spark, rows), root, max_rows_per_file=3)
    assert spark.conf.get(key) == before
    on_disk = {d: fs for d, _, fs in os.walk(root) if "city_part=" in d}
    capped = [f for d, fs in on_disk.items() if "Delhi" not in d for f in fs]
    assert capped and all(f.endswith(".parquet") for f in capped)
    files = lake.rows_per_file(spark, root).collect()
    assert max(r.rows for r in files) <= 3 and len([r for r in files if r.city_part != "Delhi"]) == len(capped)
    got = lake.scan_lake(spark, root).filter("city != 'Delhi'")
    want = _lake_rows(spark, rows)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert [r.txn_id for r in lake.scan_pruned(spark, root, city="Delhi").collect()] == ["kept"]


def test_ingest_is_incremental_idempotent_and_isolates_bad_files(spark, tmp):
    root, raw, log, ck = f"{tmp}/lake", f"{tmp}/raw", f"{tmp}/log", f"{tmp}/ck"
    lake.write_lake(_lake_rows(spark, [dict(txn_id="A"), dict(txn_id="B", city="Delhi"),
                                       dict(txn_id=None, city="Pune"), dict(txn_id="C", city="Pune")]), root)
    ingest.ingest_stream(spark, root, raw, log, ck)
    ingest.ingest_stream(spark, root, raw, log, ck)  # nothing new: no-op
    got = spark.read.parquet(raw)
    assert sorted(r.txn_id for r in got.collect()) == ["A", "B"]  # the Pune file holds a NULL id
    latest = {r.object_key.split("city_part=")[1].split("/")[0]: r
              for r in ingest.latest_log(ingest.read_log(spark, log)).collect()}
    assert latest["Pune"].status == "failed" and latest["Mumbai"].status == "success"
    assert latest["Mumbai"].row_count == 1
    assert dict(got.select("txn_id", "state").collect()) == {"A": "Maharashtra", "B": "Delhi"}

    # a new folder arrives: only it is loaded; an id already present is not inserted again
    lake.write_lake(_lake_rows(spark, [dict(txn_id="A", city="Agra", amount_inr=99.0),
                                       dict(txn_id="D", city="Agra")]), root)
    ingest.ingest_stream(spark, root, raw, log, ck)
    got = {r.txn_id: r.amount_inr for r in spark.read.parquet(raw).collect()}
    assert sorted(got) == ["A", "B", "D"] and float(got["A"]) == 10.0


def test_truncated_file_fails_alone_and_is_retried(spark, tmp):
    root, raw, log = f"{tmp}/lake", f"{tmp}/raw", f"{tmp}/log"
    lake.write_lake(_lake_rows(spark, [dict(txn_id="A"), dict(txn_id="B", city="Delhi")]), root)
    files = sorted(r.object_key for r in lake.file_listing(spark, root).collect())
    bad = [f for f in files if "Delhi" in f][0]
    path = bad.replace("file:", "")
    good_bytes = open(path, "rb").read()
    with open(path, "r+b") as f:
        f.truncate(len(good_bytes) // 2)
    ingest.ingest_batch(spark, root, raw, log)
    assert [r.txn_id for r in spark.read.parquet(raw).collect()] == ["A"]
    failed = ingest.latest_log(ingest.read_log(spark, log)).filter("status = 'failed'").collect()
    assert len(failed) == 1 and failed[0].error_message
    with open(path, "wb") as f:
        f.write(good_bytes)
    ingest.retry_failed(spark, root, raw, log)
    assert sorted(r.txn_id for r in spark.read.parquet(raw).collect()) == ["A", "B"]
    assert ingest.latest_log(ingest.read_log(spark, log)).filter("status = 'failed'").count() == 0


def test_first_copy_in_a_load_wins(spark):
    df = _lake_rows(spark, [dict(txn_id="A", amount_inr=1.0), dict(txn_id="A", amount_inr=2.0)])
    df = df.withColumn("object_key", F.when(F.col("amount_inr") == 2.0, "a/x").otherwise("b/y")) \
        .withColumn("row_index", F.lit(0))
    assert ingest.first_per_id(df).first().amount_inr == 2.0


def test_foreign_pandas_files_load(spark, tmp):
    """Files as pandas writes them: ns UTC timestamps, int8 hour, an all-NULL
    reason column of Parquet null type, folder ``city=Navi_Mumbai``."""
    import pandas as pd
    root, raw, log = f"{tmp}/lake", f"{tmp}/raw", f"{tmp}/log"

    def frame(city, reasons):
        n = len(reasons)
        return pd.DataFrame({
            "txn_id": [f"TXN{city[:3].upper()}{i:013d}" for i in range(n)],
            "amount_inr": [100.5 + i for i in range(n)], "city": city, "merchant_category": "retail",
            "upi_app": "PhonePe", "payment_type": "p2m",
            "status": ["FAILED" if r else "SUCCESS" for r in reasons], "failure_reason": reasons,
            "txn_date": dt.date(2024, 1, 15), "txn_hour": pd.Series([10] * n, dtype="int8"),
            "is_weekend": False, "is_festival": False, "sender_upi": "a@ok", "receiver_upi": "b@ok",
            "device_type": "Android",
            "created_at": [dt.datetime(2024, 1, 15, 10, 5, i, 123456, tzinfo=dt.timezone.utc) for i in range(n)],
        })
    for city, reasons in [("Navi Mumbai", [None, None]), ("Delhi", [None, "Network error"])]:
        d = f"{root}/year=2024/month=01/city={city.replace(' ', '_')}"
        os.makedirs(d)
        frame(city, reasons).to_parquet(f"{d}/batch_0000.parquet", index=False, compression="snappy")
    # plus one native file
    lake.write_lake(_lake_rows(spark, [dict(txn_id="TXNNATIVE", city="Pune")]), f"{root}/native")
    ingest.ingest_batch(spark, root, raw, log)
    got = {r.txn_id: r for r in spark.read.parquet(raw).collect()}
    assert len(got) == 5
    assert got["TXNNAV0000000000001"].city == "Navi Mumbai"
    assert got["TXNNAV0000000000001"].state == "Maharashtra"
    assert got["TXNNAV0000000000001"].created_at == dt.datetime(2024, 1, 15, 10, 5, 1, 123456)
    assert got["TXNDEL0000000000001"].failure_reason == "Network error"
    assert got["TXNNATIVE"].city == "Pune"
    assert ingest.latest_log(ingest.read_log(spark, log)).filter("status = 'success'").count() == 3


def test_scan_foreign_lake(spark, tmp):
    import pandas as pd
    d = f"{tmp}/f/year=2024/month=01/city=Navi_Mumbai"
    os.makedirs(d)
    pd.DataFrame({
        "txn_id": ["TXN1"], "amount_inr": [5.0], "city": ["Navi Mumbai"], "merchant_category": ["retail"],
        "upi_app": ["PhonePe"], "payment_type": ["p2m"], "status": ["SUCCESS"], "failure_reason": [None],
        "txn_date": [dt.date(2024, 1, 1)], "txn_hour": pd.Series([3], dtype="int8"), "is_weekend": [False],
        "is_festival": [True], "sender_upi": ["a@x"], "receiver_upi": ["b@y"], "device_type": ["iOS"],
        "created_at": [dt.datetime(2024, 1, 1, 3, tzinfo=dt.timezone.utc)],
    }).to_parquet(f"{d}/batch_0000.parquet", index=False)
    rows = lake.scan_foreign_lake(spark, f"{tmp}/f").collect()
    assert [(r.city, r.created_at, r.txn_hour) for r in rows] == [("Navi Mumbai", dt.datetime(2024, 1, 1, 3), 3)]


def test_batch_ingest_in_chunks_keeps_first_copy_by_key_order(spark, tmp):
    root, raw, log = f"{tmp}/lake", f"{tmp}/raw", f"{tmp}/log"
    # the same id in three folders; Agra < Delhi < Mumbai in key order
    lake.write_lake(_lake_rows(spark, [dict(txn_id="X", city="Mumbai", amount_inr=3.0),
                                       dict(txn_id="X", city="Agra", amount_inr=1.0),
                                       dict(txn_id="X", city="Delhi", amount_inr=2.0),
                                       dict(txn_id="Y", city="Delhi")]), root)
    ingest.ingest_batch(spark, root, raw, log, max_files_per_batch=1)
    got = {r.txn_id: float(r.amount_inr) for r in spark.read.parquet(raw).collect()}
    assert got == {"X": 1.0, "Y": 10.0}
    assert ingest.latest_log(ingest.read_log(spark, log)).filter("status = 'success'").count() == 3


def test_replayed_batch_changes_nothing(spark, tmp):
    """A micro-batch replayed after a crash (raw appended, commit lost) adds no rows."""
    root, raw, log = f"{tmp}/lake", f"{tmp}/raw", f"{tmp}/log"
    lake.write_lake(_lake_rows(spark, [dict(txn_id="A"), dict(txn_id="B", city="Delhi")]), root)
    files = lake.file_listing(spark, root).select("object_key")
    ingest.load_files(spark, files, raw, log)
    first = sorted(map(tuple, spark.read.parquet(raw).collect()))
    ingest.load_files(spark, files, raw, log)  # the replay
    assert sorted(map(tuple, spark.read.parquet(raw).collect())) == first
    assert ingest.latest_log(ingest.read_log(spark, log)).filter("status = 'success'").count() == 2


def test_footer_probe_schemes():
    import pytest
    assert ingest._arrow_uri("s3a://bucket/lake/x.parquet") == "s3://bucket/lake/x.parquet"
    assert ingest._arrow_uri("hdfs://nn/lake/x.parquet") == "hdfs://nn/lake/x.parquet"
    with pytest.raises(ingest.Unprobed):  # a store Python cannot open is left to Spark
        ingest._footer("nosuchscheme://bucket/lake/x.parquet")


def test_every_fault_fails_its_file_alone(spark, tmp):
    """Truncated, damaged, wrongly typed, NULL and overflowing files fail with a message and no row of
    theirs is loaded; the others load, an untyped column included; repaired files load on retry."""
    from paylake.plans.scenarios import FAULT_YEAR, add_faulty_files, rewrite_file, truncate_file
    root, raw, log = f"{tmp}/lake", f"{tmp}/raw", f"{tmp}/log"
    rows = _lake_rows(spark, [dict(txn_id="TXN1"), dict(txn_id="TXN2", city="Delhi"), dict(txn_id="TXN3", city="Pune")])
    lake.write_lake(rows, root)
    add_faulty_files(spark, rows, root)
    files = {r.object_key.split("city_part=")[1].split("/")[0]: r.object_key
             for r in lake.file_listing(spark, root).collect()}
    whole = open(files["Delhi"].replace("file:", ""), "rb").read()
    truncate_file(spark, files["Delhi"])
    ingest.ingest_batch(spark, root, raw, log)
    entries = {r.object_key.split("city_part=")[1].split("/")[0]: r
               for r in ingest.latest_log(ingest.read_log(spark, log)).collect()}
    assert {k for k, r in entries.items() if r.status == "success"} == {"Mumbai", "Pune", "good", "untyped"}
    assert all(r.error_message and r.row_count == 0 for r in entries.values() if r.status == "failed")
    for name in schema.LAKE_COLUMNS:
        if name not in ("failure_reason", "is_festival"):
            assert entries[f"null_{name}"].error_message == f'null value in column "{name}" violates not-null constraint'
    assert "overflow" in entries["overflow"].error_message
    assert "amount_inr" in entries["wrong_type"].error_message
    loaded = spark.read.parquet(raw)
    assert sorted(r.txn_id for r in loaded.collect()) == ["TXN1", "TXN1G", "TXN1U", "TXN3"]
    assert sum(r.row_count for r in entries.values()) == loaded.count()
    rewrite_file(spark, files["Delhi"], lambda data: bytearray(whole))
    ingest.retry_failed(spark, root, raw, log, max_files_per_batch=3)
    assert sorted(r.txn_id for r in spark.read.parquet(raw).collect()) == ["TXN1", "TXN1G", "TXN1U", "TXN2", "TXN3"]
    assert ingest.latest_log(ingest.read_log(spark, log)).filter("status = 'failed'").count() == 17
    assert FAULT_YEAR == 2099


def test_loads_are_cut_by_bytes_too(spark, tmp):
    root, raw, log = f"{tmp}/lake", f"{tmp}/raw", f"{tmp}/log"
    lake.write_lake(_lake_rows(spark, [dict(txn_id="A"), dict(txn_id="B", city="Delhi"), dict(txn_id="A", city="Pune")]), root)
    ingest.load_in_order(spark, ingest.pending_files(spark, root, log), raw, log, max_bytes_per_batch=1)
    assert {r.txn_id: r.city for r in spark.read.parquet(raw).collect()} == {"A": "Mumbai", "B": "Delhi"}
    assert ingest.read_log(spark, log).count() == 3


def _lake_of(spark, root, files, rows_each=20):
    """A lake of ``files`` files in one folder each."""
    for k in range(files):
        lake.write_lake(_lake_rows(spark, [dict(txn_id=f"T{k:03d}-{i:02d}", city=f"City {k:03d}") for i in range(rows_each)]), root)
    return sorted(r.object_key for r in lake.file_listing(spark, root).collect())


def test_damaged_files_are_found_in_one_read(spark, tmp, monkeypatch):
    """Three damaged files among others: one staged read of the load, only those three decoded again."""
    from paylake.plans.scenarios import damaged_pages, rewrite_file
    root, raw, log = f"{tmp}/lake", f"{tmp}/raw", f"{tmp}/log"
    files = _lake_of(spark, root, 12)
    for k in (1, 5, 9):
        rewrite_file(spark, files[k], damaged_pages)
    reads, again = [], []
    stage, damage = ingest._stage_rows, ingest.damage
    monkeypatch.setattr(ingest, "_stage_rows", lambda spark, files, made: reads.append(len(files)) or stage(spark, files, made))
    monkeypatch.setattr(ingest, "damage", lambda names: again.append(names.count()) or damage(names))
    ingest.ingest_batch(spark, root, raw, log)
    assert reads == [12] and again == [3]
    entries = {r.object_key: r for r in ingest.read_log(spark, log).collect()}
    assert len(entries) == 12 and {k for k, r in entries.items() if r.status == "failed"} == {files[1], files[5], files[9]}
    assert all("of 20 rows could be read" in entries[files[k]].error_message for k in (1, 5, 9))
    assert spark.read.parquet(raw).count() == 9 * 20


def test_an_engine_error_fails_the_run_and_no_file(spark, tmp, monkeypatch):
    """A whole file read in part, and an error while writing: nothing is logged, staged copies are gone."""
    import pytest

    from paylake import session
    root, raw, log = f"{tmp}/lake", f"{tmp}/raw", f"{tmp}/log"
    _lake_of(spark, root, 2)
    shared = session.shared_dir(spark).removeprefix("file:")
    staged = lambda: sorted(n for n in os.listdir(shared) if n.startswith(("load-rows", "insert-batch", "foreign-")))
    before = staged()
    stage = ingest._stage_rows

    def lossy(spark, files, made):
        return stage(spark, files[:1], made)  # the engine lost the second file's rows
    with monkeypatch.context() as m:
        m.setattr(ingest, "_stage_rows", lossy)
        with pytest.raises(ingest.LoadError, match="files are whole"):
            ingest.ingest_batch(spark, root, raw, log)
    with monkeypatch.context() as m:
        m.setattr(ingest, "absent_rows", lambda *a: (_ for _ in ()).throw(OSError("No space left on device")))
        with pytest.raises(OSError):
            ingest.ingest_batch(spark, root, raw, log)
    assert not os.path.exists(log) and staged() == before
    ingest.ingest_batch(spark, root, raw, log)
    assert spark.read.parquet(raw).count() == 40 and ingest.read_log(spark, log).filter("status = 'success'").count() == 2


def test_bucket_counts_follow_the_size():
    gb = 1024 ** 3
    assert [ingest.buckets_for(x) for x in (0, gb, 10 * gb, 2048 * gb)] == [16, 16, 64, 8192]
    assert ingest.buckets_for(10 ** 18) == ingest.MAX_BUCKETS
