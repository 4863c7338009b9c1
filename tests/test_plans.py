"""Physical plan shape: broadcasts, partial dedup before the shuffle, pruning."""

from paylake.plans import models, panels
from paylake.sources import adapter

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_dimension_lookups_are_broadcast(spark):
    fact = models.fact_from_raw(adapter.raw_rows(spark, SF))
    plan = _plan(fact)
    assert plan.count("BroadcastHashJoin") >= 5
    assert "SortMergeJoin" not in plan


def test_dedup_limits_rows_before_the_shuffle(spark):
    stg = models.stg_transactions(adapter.raw_rows(spark, SF))
    stg.collect()
    plan = stg._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_panel_reads_only_needed_columns(spark, tmp):
    fact = models.fact_from_raw(adapter.raw_rows(spark, SF))
    fact.write.parquet(f"{tmp}/fact")
    stored = spark.read.parquet(f"{tmp}/fact")
    dims = models.Dims(models.dim_date(spark), None, models.dim_merchant(spark), models.dim_upi_app(spark),
                       models.dim_payment_type(spark))
    df = panels.merchant_split(stored, dims)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    scan = [ln for ln in _plan(df).splitlines() if "FileScan parquet" in ln or "Scan parquet" in ln]
    assert scan and all("amount_inr" in s and "merchant_sk" in s and "txn_hour" not in s for s in scan), scan
    assert "Aggregate" in plan


def _raw_side_is_streamed(plan):
    """The scan of raw's buckets reaches the join without an exchange or a sort."""
    lines = plan.splitlines()
    at = next(i for i, ln in enumerate(lines) if "Bucketed: true" in ln)
    join = max(i for i in range(at) if "ShuffledHashJoin" in lines[i])
    return not any("Exchange" in ln or "Sort" in ln for ln in lines[join + 1:at])


def test_insert_if_absent_never_shuffles_raw(spark, tmp, monkeypatch):
    """raw streams its id column bucket by bucket, also when nothing may be broadcast."""
    from paylake.sources import ingest
    monkeypatch.setattr(ingest, "SMALL_LOAD", 0)
    raw_path = f"{tmp}/raw"
    batch = adapter.raw_rows(spark, SF).filter("txn_id is not null").dropDuplicates(["txn_id"])
    ingest.insert_if_absent(spark, batch, raw_path)
    n = spark.read.parquet(raw_path).count()
    batch.write.parquet(f"{tmp}/batch")
    rows = spark.read.parquet(f"{tmp}/batch")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
        absent = ingest.absent_rows(spark, rows, raw_path)
        assert absent.count() == 0
        plan = _plan(absent)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert _raw_side_is_streamed(plan), plan
    ingest.insert_if_absent(spark, batch, raw_path)  # every id is present: nothing is appended
    assert spark.read.parquet(raw_path).count() == n


def test_raw_gets_more_buckets_as_it_grows(spark, tmp, monkeypatch):
    """Past the limit the table is dealt out anew: ids stay exact, and raw is streamed before and after."""
    from paylake.operators import publish
    from paylake.sources import ingest
    monkeypatch.setattr(ingest, "SMALL_LOAD", 0)
    raw_path, batch = f"{tmp}/raw", adapter.raw_rows(spark, SF).filter("txn_id is not null").dropDuplicates(["txn_id"])
    batch.write.parquet(f"{tmp}/batch")
    rows = spark.read.parquet(f"{tmp}/batch")
    first = rows.filter("txn_hour < 8")
    ingest.insert_if_absent(spark, first, raw_path)
    assert ingest.raw_buckets(spark, raw_path) == 16
    monkeypatch.setattr(ingest, "MAX_BUCKETS", 64)
    monkeypatch.setattr(ingest, "BUCKET_BYTES", ingest.folder_bytes(spark, raw_path) // 100)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        for crash in (True, False):
            with monkeypatch.context() as m:
                if crash:  # the table is left as it was, and the next load finishes the rewrite
                    m.setattr(publish, "_perform", lambda *a: (_ for _ in ()).throw(OSError("lost")))
                    try:
                        ingest.insert_if_absent(spark, rows, raw_path)
                        raise AssertionError
                    except OSError:
                        pass
                    assert spark.read.parquet(raw_path).count() == first.count()
                else:
                    ingest.insert_if_absent(spark, rows, raw_path)
        n = ingest.raw_buckets(spark, raw_path)
        assert n == 64 and spark.read.parquet(raw_path).count() == rows.count()
        absent = ingest.absent_rows(spark, rows, raw_path)
        assert absent.count() == 0
        plan = _plan(absent)
        assert _raw_side_is_streamed(plan) and f"SelectedBucketsCount: {n} out of {n}" in plan, plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    want = sorted(r.txn_id for r in rows.collect())
    assert sorted(r.txn_id for r in spark.read.parquet(raw_path).collect()) == want


def _rows_scanned(df):
    """Rows that the file scans of an executed plan gave."""
    plan, found = df._jdf.queryExecution().executedPlan(), []

    def walk(node):
        name = node.nodeName()
        if name.startswith("Scan parquet"):
            found.append(node.metrics().apply("numOutputRows").value())
        kids = node.finalPhysicalPlan() if name.startswith("AdaptiveSparkPlan") else None
        kids = kids or (node.plan() if "QueryStage" in name else None)
        if kids is not None:
            walk(kids)
        else:
            for i in range(node.children().size()):
                walk(node.children().apply(i))
    walk(plan)
    return sum(found)


def test_a_small_load_looks_ids_up_by_bloom_filters(spark, tmp):
    """Ids that raw does not have, between its least and largest: no row group is read for them."""
    from pyspark.sql import functions as F

    from paylake.sources import ingest
    raw_path = f"{tmp}/raw"
    batch = adapter.raw_rows(spark, SF).filter("txn_id is not null").dropDuplicates(["txn_id"])
    ingest.insert_if_absent(spark, batch, raw_path)
    ids = [r.txn_id for r in spark.read.parquet(raw_path).orderBy("txn_id").collect()]
    spark.conf.set("spark.sql.parquet.pushdown.inFilterThreshold", "50")
    try:
        scan = spark.read.schema("txn_id string").parquet(raw_path)
        missing = scan.filter(F.col("txn_id").isin([f"{x}!" for x in ids[100:120]]))
        assert missing.collect() == [] and _rows_scanned(missing) < 0.5 * len(ids)
    finally:
        spark.conf.unset("spark.sql.parquet.pushdown.inFilterThreshold")
    few = batch.limit(3).withColumn("txn_id", F.concat("txn_id", F.lit("!"))).unionByName(batch.filter(
        F.col("txn_id").isin(ids[:4])))
    ingest.insert_if_absent(spark, few, raw_path)
    assert spark.read.parquet(raw_path).count() == len(ids) + 3
    assert ingest._found(spark, [ids[0], "nothing"], raw_path) == [ids[0]]


def test_raw_made_by_another_writer_is_appended_to(spark, tmp):
    from paylake.sources import ingest
    raw_path = f"{tmp}/raw"
    batch = adapter.raw_rows(spark, SF).filter("txn_id is not null").dropDuplicates(["txn_id"])
    batch.filter("txn_hour < 12").write.parquet(raw_path)
    ingest.insert_if_absent(spark, batch, raw_path)
    assert spark.read.parquet(raw_path).count() == batch.count()


def test_incremental_cutoff_reaches_the_raw_scan(spark, tmp):
    """The lookback literal that production uses is pushed into the raw scan."""
    raw_path = f"{tmp}/raw"
    adapter.raw_rows(spark, SF).write.parquet(raw_path)
    raw = spark.read.parquet(raw_path)
    cutoff = models.lookback_cutoff(models.fact_from_raw(raw))
    df = models.fact_from_raw(raw.filter(raw.created_at > cutoff))
    scans = [ln for ln in _plan(df).splitlines() if "FileScan parquet" in ln]
    assert any("PushedFilters" in ln and "GreaterThan(created_at" in ln for ln in scans), scans


def _scans(df, marker):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "2000")  # whole paths in the plan
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum("Scan parquet" in ln and marker in ln for ln in plan.split("== Initial Plan ==")[0].splitlines())


def test_reports_scan_each_table_once(spark, tmp):
    from paylake.plans import inventory, quality
    from paylake.plans.inputs import Inputs
    i = Inputs(spark, SF)
    i.stg.write.parquet(f"{tmp}/stgtable")
    models.fact_rows(models.int_enriched(i.stg)).write.parquet(f"{tmp}/facttable")
    stg, fact = spark.read.parquet(f"{tmp}/stgtable"), spark.read.parquet(f"{tmp}/facttable")
    dims = models.Dims(models.dim_date(spark), models.location_mapping(spark), models.dim_merchant(spark),
                       models.dim_upi_app(spark), models.dim_payment_type(spark))
    for df in (quality.dq_report(stg, fact, dims), quality.dq_unique(stg, fact, dims)):
        assert (_scans(df, "stgtable"), _scans(df, "facttable")) == (1, 1)
    i.fact, i.stg = fact, stg
    assert _scans(inventory.filter_boolean(i), "facttable") == 1
    assert _scans(inventory.src_values_dims(i), "stgtable") == 1
    i.raw.write.parquet(f"{tmp}/rawtable")
    i.raw = spark.read.parquet(f"{tmp}/rawtable")
    assert _scans(inventory.stg_filter_valid(i), "rawtable") == 1


def test_shuffle_is_sized_to_the_input(spark, monkeypatch, tmp):
    import paylake.session as S
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        adapter.raw_rows(spark, SF).write.parquet(f"{tmp}/raw")
        raw = spark.read.parquet(f"{tmp}/raw")
        assert 0 < S.estimated_bytes(raw) < 2 ** 62            # file statistics are known
        assert S.size_shuffle_for(spark, raw) == int(before)   # small input: never lowered
        unknown = spark.createDataFrame([(1,)], "x int")
        assert S.size_shuffle_for(spark, unknown) == int(before)
        monkeypatch.setattr(S, "estimated_bytes", lambda df: 1000 * S.TARGET_PARTITION_BYTES)
        assert S.size_shuffle_for(spark, raw) == max(int(before), 1000)
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(max(int(before), 1000))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_sized_shuffle_restores_the_setting(spark, monkeypatch):
    import paylake.session as S
    before = spark.conf.get("spark.sql.shuffle.partitions")
    monkeypatch.setattr(S, "estimated_bytes", lambda df: 5000 * S.TARGET_PARTITION_BYTES)
    with S.sized_shuffle(spark, spark.range(1)) as n:
        assert n == max(int(before), 5000)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
