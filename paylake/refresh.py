"""End-to-end run: lake -> raw -> star schema -> data tests -> dashboard.

    python -m paylake.refresh --lake <lake root> --warehouse <folder> [--stream]

Each step is a Spark job over the shared storage; reruns are incremental
(only new lake files are loaded, only new raw files update the latest-version
table, the fact is upserted) and idempotent. Exits
with status 1 when any data test fails, like a failed test run.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import SparkSession

if __name__ == "__main__":  # started by file path: the package is the folder above
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def run(spark: SparkSession, lake_root: str, warehouse: str, stream: bool = False,
        max_files_per_batch: int | None = None) -> dict:
    from paylake.plans import models, panels, quality
    from paylake.plans.staging_store import maintain_latest, read_latest
    from paylake.session import configure
    from paylake.sources import ingest

    configure(spark)
    root = warehouse.rstrip("/")
    raw_path, log_path = f"{root}/raw/transactions", f"{root}/raw/load_log"
    limit = max_files_per_batch or ingest.DEFAULT_MAX_FILES_PER_BATCH
    if stream:
        ingest.ingest_stream(spark, lake_root, raw_path, log_path, f"{root}/_checkpoints/ingest",
                             max_files_per_batch=limit)
    else:
        ingest.ingest_batch(spark, lake_root, raw_path, log_path, max_files_per_batch=limit)
    if not ingest.path_exists(spark, raw_path):
        return {"loaded": 0}
    # staging = latest version per id, maintained from the raw files appended
    # since the last run (no full dedup of raw per refresh)
    latest_path = f"{root}/staging/latest_versions"
    maintain_latest(spark, raw_path, latest_path, f"{root}/_checkpoints/latest", limit)
    latest = read_latest(spark, latest_path)
    paths = models.build_star(spark, latest, f"{root}/marts", deduped=True)
    fact = spark.read.parquet(paths["fact_transactions"])
    dims = models.Dims(*(spark.read.parquet(paths[n]) for n in
                         ["dim_date", "dim_location", "dim_merchant", "dim_upi_app", "dim_payment_type"]))
    report = quality.dq_report(models.stg_from_latest(latest), fact, dims)
    report.write.mode("overwrite").parquet(f"{root}/tests/dq_report")
    report = spark.read.parquet(f"{root}/tests/dq_report")
    failed = [r.asDict() for r in report.filter("failures > 0").collect()]  # at most 46 rows
    # rows that break a rule of the source, with the rules' names (a side output)
    quality.quarantine(latest).write.mode("overwrite").parquet(f"{root}/tests/quarantine")
    board = panels.maintain_dashboard(spark, paths["fact_transactions"], dims, f"{root}/dashboard/base")
    for name, df in board.items():
        df.coalesce(1).write.mode("overwrite").parquet(f"{root}/dashboard/{name}")
    log = ingest.latest_log(ingest.read_log(spark, log_path))
    return {
        "files_loaded": log.filter("status = 'success'").count(),
        "files_failed": log.filter("status = 'failed'").count(),
        "tests": report.count(), "tests_failed": failed,
        "rows_quarantined": spark.read.parquet(f"{root}/tests/quarantine").count(),
        "tables": paths,
    }


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--lake", required=True)
    ap.add_argument("--warehouse", required=True)
    ap.add_argument("--stream", action="store_true", help="ingest with Structured Streaming (availableNow)")
    ap.add_argument("--max-files-per-batch", type=int, default=None)
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("paylake-refresh").getOrCreate()
    out = run(spark, args.lake, args.warehouse, args.stream, args.max_files_per_batch)
    print(json.dumps(out, default=str))
    return 1 if out.get("tests_failed") else 0


if __name__ == "__main__":
    sys.exit(main())
