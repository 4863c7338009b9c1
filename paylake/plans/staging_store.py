"""The latest version of every transaction, kept as a table.

Staging is "latest version per txn_id" over the whole raw table. Recomputing
it means a full shuffle of raw on every refresh; instead this table is
maintained from the raw files as they are appended (a Structured Streaming
query over the raw folder, ``availableNow``): for each micro-batch of new
raw rows, ``latest := latest(latest ∪ new)`` for the ids in the batch. That
is exact — the top row of a union is the top of the tops — and a replayed
batch changes nothing. The table keeps rows with non-positive amounts (a
newest version with amount 0 must hide older versions); staging filters them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake import schema
from paylake.operators.dedup import latest_per_key
from paylake.plans.models import latest_order
from paylake.session import remove_path, scratch_path, sized_shuffle
from paylake.sources.ingest import DEFAULT_MAX_FILES_PER_BATCH

LATEST_PARTITIONS = ["txn_year", "txn_month"]


def merge_latest(spark: SparkSession, new_raw: DataFrame, latest_path: str) -> str:
    """Fold new raw rows into the latest-version table at ``latest_path``.

    The batch is staged first (its size is then known, and its lineage runs
    once); the existing versions of its ids are found by a semi join in which
    the batch ids are the build side; the winners replace their ids through
    the keyed upsert, which rewrites only the months they touch.
    """
    from paylake.operators.upsert import read_target, upsert
    staged = scratch_path(spark, "latest-batch")
    new_raw.filter(F.col("txn_id").isNotNull()).select(*schema.RAW_COLUMNS).write.parquet(staged)
    new = spark.read.schema(schema.RAW_SCHEMA).parquet(staged)
    target = read_target(spark, latest_path)
    # the semi join shuffles the target's ids, the dedup the batch (all of raw on a first build)
    with sized_shuffle(spark, *([new] if target is None else [new, target])):
        candidates = new
        if target is not None:
            # distinct: an id repeated across the batch must not meet on one reducer
            ids = new.select("txn_id").distinct()
            existing = target.join(ids, "txn_id", "left_semi").select(*schema.RAW_COLUMNS)
            candidates = new.unionByName(existing)
        top = latest_per_key(candidates, "txn_id", latest_order())
        top = top.withColumn("txn_year", F.year("txn_date")).withColumn("txn_month", F.month("txn_date"))
        done = upsert(spark, top, latest_path, key="txn_id", parts=LATEST_PARTITIONS)
    remove_path(spark, staged)
    return done


def maintain_latest(spark: SparkSession, raw_path: str, latest_path: str, checkpoint: str,
                    max_files_per_batch: int = DEFAULT_MAX_FILES_PER_BATCH) -> None:
    """Bring the latest-version table up to date with the raw files appended
    since the last run (the stream's checkpoint remembers which)."""
    src = (spark.readStream.schema(schema.RAW_SCHEMA)
           .option("maxFilesPerTrigger", int(max_files_per_batch)).parquet(raw_path))

    def each(batch: DataFrame, batch_id: int) -> None:
        merge_latest(batch.sparkSession, batch, latest_path)

    q = (src.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint)
         .foreachBatch(each).start())
    q.awaitTermination()


def read_latest(spark: SparkSession, latest_path: str) -> DataFrame:
    return spark.read.parquet(latest_path).select(*schema.RAW_COLUMNS)
