"""Write-side queries: each runs a sink / ingest / upsert step on the
stand-in rows under a fresh folder of the shared area and returns what a
reader then sees. The steps are the library's own; only the input is staged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake import schema
from paylake.plans import models
from paylake.session import scratch_path
from paylake.sources import adapter, ingest, lake

def rule_loaded_at():
    """Load time of the stand-in rows: a fixed rule, never now()."""
    return F.col("created_at") + F.expr("INTERVAL 1 DAY")
FIRST_RUN_BEFORE = "2024-07-01 00:00:00"
LATE_ID_SUFFIX = "3"  # ids ending in this digit reach raw only after the first run


def first_run_rows(raw: DataFrame) -> DataFrame:
    """Raw rows present at the first fact build: older than the cut, minus
    the late-arriving ids."""
    return raw.filter((F.col("created_at") < F.lit(FIRST_RUN_BEFORE).cast("timestamp"))
                      & ~F.col("txn_id").endswith(LATE_ID_SUFFIX))
MAX_ROWS_PER_FILE = 3


def folder_of(col: str = "object_key") -> list:
    """(year, month, city_part) parsed back from a lake object key."""
    return [F.regexp_extract(col, r"year=(\d+)/", 1).cast("int").alias("year"),
            F.regexp_extract(col, r"month=([^/]+)/", 1).alias("month"),
            F.regexp_extract(col, r"city_part=([^/]+)/", 1).alias("city_part")]


def staged_lake(spark: SparkSession, sf_dir: str, max_rows_per_file: int | None = None) -> str:
    root = scratch_path(spark, "lake")
    lake.write_lake(adapter.lake_rows(spark, sf_dir), root, max_rows_per_file)
    return root


_SHARED_LAKES: dict = {}


def shared_lake(spark: SparkSession, sf_dir: str) -> str:
    """One staged lake per session and scale factor for queries that only
    read it (scans, listings, ingests); writers and file-damaging queries
    stage their own."""
    key = (spark.sparkContext.applicationId, sf_dir)
    root = _SHARED_LAKES.get(key)
    if root is None or not ingest.path_exists(spark, root):
        root = staged_lake(spark, sf_dir)
        _SHARED_LAKES[key] = root
    return root


def scan_lake(spark, sf_dir) -> DataFrame:
    """Every Parquet file of a staged lake, read recursively with the lake-file schema."""
    return lake.scan_lake(spark, shared_lake(spark, sf_dir))


def sink_lake_partitioned(spark, sf_dir) -> DataFrame:
    """Write the lake under year=/month=/city_part= folders, read it back with its folder columns."""
    return lake.scan_partitioned(spark, staged_lake(spark, sf_dir))


def scan_partition_pruned(spark, sf_dir) -> DataFrame:
    """Rows of the January folders of Mumbai only, selected by partition filters."""
    return lake.scan_pruned(spark, shared_lake(spark, sf_dir), month="01", city="Mumbai")


def sink_max_rows_per_file(spark, sf_dir) -> DataFrame:
    """Write with a cap of rows per file; per folder: rows, and whether a file is over the cap."""
    root = staged_lake(spark, sf_dir, MAX_ROWS_PER_FILE)
    files = lake.rows_per_file(spark, root)
    return files.groupBy(*lake.PARTITION_COLUMNS).agg(
        (F.max("rows") > MAX_ROWS_PER_FILE).alias("over_cap"), F.sum("rows").alias("rows"))


def ordered_file_listing(spark, sf_dir) -> DataFrame:
    """The folders of the lake's files in the order of the sorted listing, with their place in it."""
    from pyspark.sql import Window
    files = lake.file_listing(spark, shared_lake(spark, sf_dir)).select("object_key").orderBy("object_key")
    folders = files.select(*folder_of()).distinct()
    # one row per folder, ranked by its key as the listing sorts it
    key = F.concat_ws("/", F.concat(F.lit("year="), F.col("year").cast("string")),
                      F.concat(F.lit("month="), F.col("month")), F.concat(F.lit("city_part="), F.col("city_part")))
    return folders.select("*", F.row_number().over(Window.orderBy(key)).cast("long").alias("place"))


MICRO_BATCH_FILES = 250  # cuts the lake of any scale factor into four micro-batches or more


def _ingested(spark, sf_dir, runs: int = 2, stream: bool = False):
    root = shared_lake(spark, sf_dir)
    raw_path, log_path = scratch_path(spark, "raw"), scratch_path(spark, "load-log")
    ckpt = scratch_path(spark, "ingest-ckpt")
    for _ in range(runs):
        if stream:
            ingest.ingest_stream(spark, root, raw_path, log_path, ckpt, rule_loaded_at(), MICRO_BATCH_FILES)
        else:
            ingest.ingest_batch(spark, root, raw_path, log_path, rule_loaded_at())
    return root, raw_path, log_path


def ingest_incremental_files(spark, sf_dir) -> DataFrame:
    """Batch-ingest a staged lake into a raw table twice (the second run loads nothing new)."""
    _, raw_path, _ = _ingested(spark, sf_dir)
    return spark.read.schema(schema.RAW_SCHEMA).parquet(raw_path)


def stream_ingest(spark, sf_dir) -> DataFrame:
    """Streaming (availableNow) ingest of a staged lake in several micro-batches, run twice; the raw table."""
    _, raw_path, _ = _ingested(spark, sf_dir, stream=True)
    return spark.read.schema(schema.RAW_SCHEMA).parquet(raw_path)


def load_log_upsert(spark, sf_dir) -> DataFrame:
    """The load log after two ingest runs, newest attempt per file, by folder."""
    _, _, log_path = _ingested(spark, sf_dir)
    latest = ingest.latest_log(ingest.read_log(spark, log_path))
    return latest.select(*folder_of(), "row_count", "status")


def truncate_file(spark: SparkSession, path: str) -> None:
    """Cut a file to half its length (a stand-in for an upload that broke off)."""
    rewrite_file(spark, path, lambda data: data[:max(8, len(data) // 2)])


def rewrite_file(spark: SparkSession, path: str, change) -> None:
    """Replace a file's bytes by ``change(bytes)`` through the cluster's file system."""
    from paylake.session import hadoop_path
    fs, p = hadoop_path(spark, path)
    content = spark.read.format("binaryFile").load(path).select("content").first()[0]
    out = fs.create(p, True)
    try:
        out.write(change(bytearray(content)))
    finally:
        out.close()


def damaged_pages(data: bytearray) -> bytearray:
    """Zeros over the first half of the column data; the footer stays readable."""
    footer = int.from_bytes(data[-8:-4], "little")
    end = len(data) - 8 - footer
    data[4:4 + end // 2] = bytes(end // 2)
    return data


FAULT_YEAR = 2099  # folder of the added files, outside the stand-in rows' dates


def add_faulty_files(spark: SparkSession, rows: DataFrame, root: str) -> None:
    """Beside the lake's files, one file per fault under ``year=2099``, named by
    its folder: a NULL in each NOT NULL column, an overflowing amount, an amount
    stored as text, damaged pages; and two good ones, one with an untyped column."""
    row = rows.filter("txn_id IS NOT NULL AND failure_reason IS NULL").orderBy("txn_id").limit(1)

    def folder(df, name):
        (df.coalesce(1).write.mode("append").parquet(f"{root}/year={FAULT_YEAR}/month=01/city_part={name}"))
    for name, kind in schema.LAKE_FIELDS:
        if name not in (*schema.RAW_NULLABLE, "is_festival"):  # is_festival has a default
            folder(row.withColumn(name, F.lit(None).cast(kind)), f"null_{name}")
    folder(row.withColumn("amount_inr", F.lit(1e12)), "overflow")
    folder(row.withColumn("amount_inr", F.lit("12.5")), "wrong_type")
    folder(row.withColumn("txn_id", F.concat("txn_id", F.lit("D"))), "damaged_pages")
    folder(row.withColumn("txn_id", F.concat("txn_id", F.lit("G"))), "good")
    folder(row.withColumn("txn_id", F.concat("txn_id", F.lit("U"))).withColumn("failure_reason", F.lit(None)),
           "untyped")
    files = lake.file_listing(spark, root).filter(F.col("object_key").contains("city_part=damaged_pages/"))
    rewrite_file(spark, files.first().object_key, damaged_pages)


def ingest_failed_files(spark, sf_dir) -> DataFrame:
    """Truncate the first file of the lake, add a file of every other fault,
    ingest, and report failed files."""
    root = staged_lake(spark, sf_dir)
    first = lake.file_listing(spark, root).select("object_key").orderBy("object_key").first()[0]
    truncate_file(spark, first)
    add_faulty_files(spark, adapter.lake_rows(spark, sf_dir), root)
    raw_path, log_path = scratch_path(spark, "raw"), scratch_path(spark, "load-log")
    ingest.ingest_batch(spark, root, raw_path, log_path, rule_loaded_at())
    latest = ingest.latest_log(ingest.read_log(spark, log_path))
    return latest.filter(F.col("status") == "failed").select(*folder_of(), "status")


def sink_insert_if_absent(spark, sf_dir) -> DataFrame:
    """Two loads into one raw table: 2023 rows first, then all rows."""
    rows = adapter.lake_rows(spark, sf_dir)
    raw_path = scratch_path(spark, "raw")
    for part in (rows.filter(F.year("txn_date") == 2023), rows):
        keyed = lake.with_lake_keys(part)
        staged = keyed.withColumn(
            "object_key", F.concat_ws("/", F.concat(F.lit("year="), F.col("year").cast("string")),
                                      F.concat(F.lit("month="), F.col("month")),
                                      F.concat(F.lit("city_part="), F.col("city_part")))
        ).withColumn("row_index", F.monotonically_increasing_id()).drop(*lake.PARTITION_COLUMNS)
        first = ingest.first_per_id(staged.filter(F.col("txn_id").isNotNull()))
        ingest.insert_if_absent(spark, ingest.to_raw(first.drop("object_key", "row_index"),
                                                     rule_loaded_at()), raw_path)
    return spark.read.schema(schema.RAW_SCHEMA).parquet(raw_path).select("txn_id", "city", "amount_inr")


def anti_loaded_keys(spark, sf_dir) -> DataFrame:
    """Load the 2023 part of the lake, then add 2024: which files are pending?"""
    rows = adapter.lake_rows(spark, sf_dir)
    root = scratch_path(spark, "lake")
    lake.write_lake(rows.filter(F.year("txn_date") == 2023), root)
    raw_path, log_path = scratch_path(spark, "raw"), scratch_path(spark, "load-log")
    ingest.ingest_batch(spark, root, raw_path, log_path, rule_loaded_at())
    lake.write_lake(rows.filter(F.year("txn_date") == 2024), root)
    return ingest.pending_files(spark, root, log_path).select(*folder_of())


def materialize_table(spark, sf_dir) -> DataFrame:
    """dim_location written as a full-rebuild table and read back."""
    from paylake.plans.registry import Inputs
    from paylake.operators.publish import rebuild_table
    path = scratch_path(spark, "dim_location")
    for _ in range(2):  # the second rebuild swaps the first one out
        rebuild_table(Inputs(spark, sf_dir).dims.location, path)
    return spark.read.parquet(path)


def _two_runs(spark, sf_dir, second_model=None):
    raw = adapter.raw_rows(spark, sf_dir)
    path = scratch_path(spark, "fact")
    models.fact_incremental(spark, first_run_rows(raw), path)
    target = spark.read.parquet(path)
    cutoff = models.lookback_cutoff(target)
    if second_model is None:
        models.fact_incremental(spark, raw, path)
    else:
        from paylake.operators.upsert import upsert
        upsert(spark, second_model(raw, cutoff), path)
    return raw, path, cutoff


def fact_incremental_upsert(spark, sf_dir) -> DataFrame:
    """First fact build on early rows, then an incremental upsert over all raw rows."""
    _, path, _ = _two_runs(spark, sf_dir)
    return spark.read.parquet(path).select(*schema.FACT_COLUMNS)


def _model_v2(raw, cutoff):
    """Changed model: drops time_of_day, adds day_name."""
    enr = models.int_enriched(models.stg_transactions(raw.filter(F.col("created_at") > cutoff)))
    f = models.fact_rows(enr).drop("time_of_day")
    names = enr.select("txn_id", "day_name")
    return f.join(names, "txn_id").select(*[c for c in schema.FACT_COLUMNS if c != "time_of_day"], "day_name")


def sync_all_columns(spark, sf_dir) -> DataFrame:
    """Incremental upsert with a changed model (time_of_day dropped, day_name added)."""
    _, path, _ = _two_runs(spark, sf_dir, _model_v2)
    return spark.read.parquet(path).select("txn_sk", "day_name", "txn_year", "txn_month", "amount_inr")


def late_rows_audit(spark, sf_dir) -> DataFrame:
    """Staged rows at or before the lookback cutoff that the upserted fact lacks."""
    raw = adapter.raw_rows(spark, sf_dir)
    path = scratch_path(spark, "fact")
    models.fact_incremental(spark, first_run_rows(raw), path)
    target = spark.read.parquet(path)
    cutoff = models.lookback_cutoff(target)
    models.fact_incremental(spark, raw, path)
    fact = spark.read.parquet(path)
    return models.late_rows(raw, fact, cutoff).select("txn_id", "created_at", "amount_inr")


DEDUP_BATCHES = 8


def stream_dedup_1h(spark, sf_dir) -> DataFrame:
    """Raw rows streamed in eight micro-batches through the redelivery dedup; the ids kept."""
    from paylake.streaming.jobs import read_deduplicated, stream_dedup
    raw_dir, out = scratch_path(spark, "raw"), scratch_path(spark, "dedup")
    files = spark.sparkContext.defaultParallelism  # of a micro-batch: one for each core
    adapter.raw_rows(spark, sf_dir).repartition(DEDUP_BATCHES * files).write.parquet(raw_dir)
    stream_dedup(spark, raw_dir, out, scratch_path(spark, "dedup-ckpt"), max_files_per_batch=files)
    return read_deduplicated(spark, out).select("txn_id")


def stream_fact_upsert(spark, sf_dir) -> DataFrame:
    """Lake files streamed in several micro-batches into raw, then the fact brought up to date; the fact."""
    from paylake.streaming.jobs import stream_fact
    root = shared_lake(spark, sf_dir)
    raw_path, log_path = scratch_path(spark, "raw"), scratch_path(spark, "load-log")
    fact_path = scratch_path(spark, "fact")
    stream_fact(spark, root, raw_path, log_path, fact_path, scratch_path(spark, "fact-ckpt"), rule_loaded_at(),
                MICRO_BATCH_FILES)
    return spark.read.parquet(fact_path).select(*schema.FACT_COLUMNS)


SCENARIOS = {
    "scan_lake": scan_lake,
    "sink_lake_partitioned": sink_lake_partitioned,
    "scan_partition_pruned": scan_partition_pruned,
    "sink_max_rows_per_file": sink_max_rows_per_file,
    "ordered_file_listing": ordered_file_listing,
    "ingest_incremental_files": ingest_incremental_files,
    "ingest_failed_files": ingest_failed_files,
    "sink_insert_if_absent": sink_insert_if_absent,
    "load_log_upsert": load_log_upsert,
    "anti_loaded_keys": anti_loaded_keys,
    "materialize_table": materialize_table,
    "fact_incremental_upsert": fact_incremental_upsert,
    "sync_all_columns": sync_all_columns,
    "late_rows_audit": late_rows_audit,
    "stream_ingest": stream_ingest,
    "stream_dedup_1h": stream_dedup_1h,
    "stream_fact_upsert": stream_fact_upsert,
}
