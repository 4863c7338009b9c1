"""Streaming jobs: the same result however the input is cut into micro-batches."""

import datetime as dt
import time
from decimal import Decimal

from paylake import schema
from paylake.streaming import jobs
from paylake.streaming.jobs import read_deduplicated, stream_dedup, stream_fact


def _row(txn_id, created_at):
    base = dict(txn_id=txn_id, amount_inr=Decimal("1.00"), city="Pune", state="Maharashtra",
                merchant_category="retail", upi_app="PhonePe", payment_type="p2m", status="SUCCESS",
                failure_reason=None, txn_date=created_at.date(), txn_hour=created_at.hour, is_weekend=False,
                is_festival=False, sender_upi="a@x", receiver_upi="b@y", device_type="iOS",
                created_at=created_at, loaded_at=created_at)
    return tuple(base[c] for c in schema.RAW_COLUMNS)


def test_redelivery_in_a_later_batch_is_dropped(spark, tmp):
    src, out, ck = f"{tmp}/raw", f"{tmp}/out", f"{tmp}/ck"
    t = dt.datetime(2024, 1, 1, 10)
    batches = [[_row("A", t)], [_row("A", t + dt.timedelta(minutes=30)), _row("B", t + dt.timedelta(minutes=40))],
               [_row("C", t + dt.timedelta(hours=3))]]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema.RAW_SCHEMA).coalesce(1).write.mode("append").parquet(src)
        time.sleep(0.05)
    stream_dedup(spark, src, out, ck, max_files_per_batch=1)
    got = sorted(r.txn_id for r in spark.read.parquet(out).collect())
    assert got == ["A", "B", "C"]
    # a second run sees no new files and adds nothing
    stream_dedup(spark, src, out, ck, max_files_per_batch=1)
    assert sorted(r.txn_id for r in spark.read.parquet(out).collect()) == ["A", "B", "C"]


def test_dedup_does_not_depend_on_batches_or_order(spark, tmp):
    """Copies and corrections of 40 ids in 24 files written in a shuffled order, with late and new ids."""
    import random
    rng = random.Random(5)
    t = dt.datetime(2024, 1, 1)
    rows = [_row(f"T{i % 40:02d}", t + dt.timedelta(minutes=rng.randrange(60 * 24 * 20))) for i in range(120)]
    rows += rows[:20]
    rng.shuffle(rows)
    src = f"{tmp}/raw"
    for k in range(24):
        spark.createDataFrame(rows[k::24], schema.RAW_SCHEMA).coalesce(1).write.mode("append").parquet(src)
    want = {}
    for r in rows:
        at = r[schema.RAW_COLUMNS.index("created_at")]
        want[r[0]] = min(want.get(r[0], at), at)
    tables = []
    for limit in (1, 7, 10_000):
        stream_dedup(spark, src, f"{tmp}/out{limit}", f"{tmp}/ck{limit}", max_files_per_batch=limit)
        tables.append(sorted(map(str, read_deduplicated(spark, f"{tmp}/out{limit}").collect())))
        got = {r.txn_id: r.created_at for r in read_deduplicated(spark, f"{tmp}/out{limit}").collect()}
        assert got == want
    assert tables[0] == tables[1] == tables[2]


def test_ingest_and_fact_do_not_depend_on_batches(spark, tmp):
    """The same ids in files of several cities and months, written in an order unlike their keys."""
    from paylake.sources import ingest, lake
    from test_lake_ingest import _lake_rows
    root, t = f"{tmp}/lake", dt.datetime(2024, 1, 15, 10)
    parts = []
    for k, city in enumerate(["Pune", "Agra", "Mumbai", "Delhi", "Kanpur"]):
        rows = []
        for i in range(12):
            day = t + dt.timedelta(days=31 * ((i + k) % 3), hours=k)
            rows.append(dict(txn_id=f"TXN{(i * 5 + k) % 17}", city=city, amount_inr=float(10 * k + i + 1), txn_date=day.date(),
                             created_at=day))
        parts.append(rows)
    for rows in parts:
        lake.write_lake(_lake_rows(spark, rows), root)
    raws, facts = [], []
    for limit in (1, 7, 10_000):
        raw, log, fact = (f"{tmp}/{n}{limit}" for n in ("raw", "log", "fact"))
        stream_fact(spark, root, raw, log, fact, f"{tmp}/ck{limit}", max_files_per_batch=limit)
        raws.append(sorted(map(str, spark.read.parquet(raw).drop("loaded_at").collect())))
        facts.append(sorted(map(str, spark.read.parquet(fact).select(*schema.FACT_COLUMNS).collect())))
        log_rows = ingest.latest_log(ingest.read_log(spark, log))
        assert log_rows.filter("status <> 'success'").count() == 0
    assert raws[0] == raws[1] == raws[2] and len(raws[0]) == 17
    assert facts[0] == facts[1] == facts[2] and len(facts[0]) == 17
    first = {}
    for r in lake.scan_lake(spark, root).select("txn_id", "amount_inr", "_metadata.file_path").collect():
        first[r.txn_id] = min(first.get(r.txn_id, (r.file_path, r.amount_inr)), (r.file_path, r.amount_inr))
    got = {r.txn_id: float(r.amount_inr) for r in spark.read.parquet(f"{tmp}/raw1").collect()}
    assert got == {k: v[1] for k, v in first.items()}


def _files(spark, src, batches):
    for rows in batches:
        spark.createDataFrame(rows, schema.RAW_SCHEMA).coalesce(1).write.mode("append").parquet(src)
        time.sleep(0.05)


def test_the_sink_is_read_for_late_rows_only(spark, tmp, monkeypatch):
    """In-order batches never read the sink; a late copy of a known id is settled against it, and a late
    row of an id never seen is kept."""
    src, out, ck, t = f"{tmp}/raw", f"{tmp}/out", f"{tmp}/ck", dt.datetime(2024, 1, 1, 10)
    reads, read_sink = [], jobs.read_sink
    monkeypatch.setattr(jobs, "read_sink", lambda spark, path: reads.append(path) or read_sink(spark, path))
    minutes = lambda n: t + dt.timedelta(minutes=n)
    _files(spark, src, [[_row("A", minutes(0))], [_row("A", minutes(20)), _row("B", minutes(30))], [_row("C", minutes(300))]])
    stream_dedup(spark, src, out, ck, max_files_per_batch=1)
    assert reads == [] and sorted(r.txn_id for r in read_sink(spark, out).collect()) == ["A", "B", "C"]
    _files(spark, src, [[_row("B", minutes(30)), _row("L", minutes(5))]])  # behind the watermark: B again, L new
    stream_dedup(spark, src, out, ck, max_files_per_batch=1)
    assert len(reads) == 1
    assert sorted((r.txn_id, r.created_at) for r in read_sink(spark, out).collect()) == [
        ("A", minutes(0)), ("B", minutes(30)), ("C", minutes(300)), ("L", minutes(5))]


def test_an_earlier_copy_within_the_hour_is_not_lost(spark, tmp):
    """The later copy came first: the state store knows the id, but the earlier copy has to win."""
    src, out, t = f"{tmp}/raw", f"{tmp}/out", dt.datetime(2024, 1, 1, 10)
    _files(spark, src, [[_row("A", t + dt.timedelta(minutes=30))], [_row("A", t)], [_row("A", t + dt.timedelta(minutes=10))]])
    stream_dedup(spark, src, out, f"{tmp}/ck", max_files_per_batch=1)
    assert [(r.txn_id, r.created_at) for r in read_deduplicated(spark, out).collect()] == [("A", t)]


def test_a_batch_run_again_writes_its_own_rows_again(spark, tmp):
    """A crash after the sink was written: the micro-batch is repeated and nothing is doubled."""
    src, out, ck, t = f"{tmp}/raw", f"{tmp}/out", f"{tmp}/ck", dt.datetime(2024, 1, 1, 10)
    _files(spark, src, [[_row("A", t), _row("B", t)]])
    append = jobs.append_new_copies

    def crash(*args):
        append(*args)
        raise RuntimeError("lost")
    jobs.append_new_copies = crash
    try:
        stream_dedup(spark, src, out, ck)
        raise AssertionError
    except Exception as e:  # noqa: BLE001
        assert "lost" in str(e)
    finally:
        jobs.append_new_copies = append
    stream_dedup(spark, src, out, ck)
    assert sorted(r.txn_id for r in jobs.read_sink(spark, out).collect()) == ["A", "B"]


def test_a_replayed_fact_batch_is_recognised(spark, tmp, monkeypatch):
    """A kill between the upsert and the checkpoint: the batch comes again and is passed over."""
    from paylake.operators import publish, upsert
    raw, fact, ck, t = f"{tmp}/raw", f"{tmp}/fact", f"{tmp}/ck", dt.datetime(2024, 1, 1, 10)
    _files(spark, raw, [[_row("TXNA", t)], [_row("TXNB", t + dt.timedelta(days=40))]])
    done, run = [], jobs.apply_batch

    def killed(*args):
        done.append(run(*args))
        if len(done) == 2:
            raise RuntimeError("killed")
        return done[-1]
    with monkeypatch.context() as m:
        m.setattr(jobs, "apply_batch", killed)
        try:
            jobs.maintain_fact(spark, raw, fact, ck, 1)
            raise AssertionError
        except Exception as e:  # noqa: BLE001
            assert "killed" in str(e)
    assert done == [True, True] and list(publish.applied(spark, fact).values()) == [1]
    again, before = [], sorted(map(str, spark.read.parquet(fact).collect()))
    monkeypatch.setattr(jobs, "apply_batch", lambda *a: again.append(run(*a)))
    monkeypatch.setattr(upsert, "upsert", None)  # a repeated batch must not get as far
    jobs.maintain_fact(spark, raw, fact, ck, 1)
    assert again == [False] and sorted(map(str, spark.read.parquet(fact).collect())) == before and len(before) == 2


def test_late_rows_reach_the_fact(spark, tmp):
    """An id that arrives hours late is upserted by its batch, not left out by a time cutoff."""
    raw, fact, ck, t = f"{tmp}/raw", f"{tmp}/fact", f"{tmp}/ck", dt.datetime(2024, 3, 1, 10)
    _files(spark, raw, [[_row("TXNA", t)]])
    jobs.maintain_fact(spark, raw, fact, ck)
    _files(spark, raw, [[_row("TXNB", t - dt.timedelta(days=60))]])
    jobs.maintain_fact(spark, raw, fact, ck)
    assert sorted(r.txn_id for r in spark.read.parquet(fact).collect()) == ["TXNA", "TXNB"]


def test_a_batch_of_many_months_is_a_few_files(spark, tmp):
    """A file for each month that a micro-batch brings, not one for each month and shuffle partition."""
    src, out, t = f"{tmp}/raw", f"{tmp}/out", dt.datetime(2024, 1, 1)
    spark.createDataFrame([_row(f"T{i:03d}", t + dt.timedelta(days=i % 360)) for i in range(720)],
                          schema.RAW_SCHEMA).repartition(4).write.parquet(src)
    stream_dedup(spark, src, out, f"{tmp}/ck", max_files_per_batch=2)
    sink = jobs.read_sink(spark, out)
    files = sink.select("run", "event_month", "_metadata.file_path").distinct().groupBy("run", "event_month").count()
    assert [r["count"] for r in files.collect()] == [1] * 24
    assert sink.count() == 720 == read_deduplicated(spark, out).count()


def test_settling_reads_whole_sink_rows_of_known_ids_only(spark, tmp):
    """New ids pass, a known id only with an earlier copy; no wide shuffle of the sink."""
    t = dt.datetime(2024, 1, 1, 10)
    minutes = lambda n: t + dt.timedelta(minutes=n)
    sink = spark.createDataFrame([(*_row(f"S{i}", minutes(30)), "r0", dt.date(2024, 1, 1)) for i in range(50)],
                                 jobs.SINK_SCHEMA)
    sink.write.partitionBy("run", "event_month").parquet(f"{tmp}/out")
    rows = spark.createDataFrame([_row("N", minutes(31)), _row("S1", minutes(20)), _row("S2", minutes(40)),
                                  _row("S3", minutes(30))], schema.RAW_SCHEMA)
    got = jobs.settled(rows, f"{tmp}/out", "r1", "1 hour", f"{tmp}/known")
    assert sorted((r.txn_id, r.created_at) for r in got.collect()) == [("N", minutes(31)), ("S1", minutes(20))]
    assert sorted(r.txn_id for r in spark.read.parquet(f"{tmp}/known").collect()) == ["S1", "S2", "S3"]
