"""Streaming ingest, redelivery dedup and the streamed fact upsert.

All run with ``trigger(availableNow=True)``: each start processes what has
arrived since the checkpoint and stops, which is how the batch schedule of
the modelled pipeline maps onto Structured Streaming. What a run leaves does
not depend on how the stream cut its input into micro-batches.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake import schema
from paylake.operators import publish
from paylake.operators.dedup import first_per_key
from paylake.session import remove_path, scratch_path
from paylake.sources import ingest

# The sink of the dedup: a folder for each micro-batch, and in it one for each month, in order of time.
SINK_SCHEMA = T.StructType([*schema.RAW_SCHEMA.fields, T.StructField("run", T.StringType()),
                            T.StructField("event_month", T.DateType())])


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a streaming query keeps as long as its checkpoint."""
    return json.loads(publish.read_text(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]


def batch_watermark(spark: SparkSession, checkpoint: str, batch_id: int) -> int:
    """Milliseconds of the watermark that a micro-batch runs with, as its
    checkpoint has it (0: none yet)."""
    log = publish.read_text(spark, f"{checkpoint.rstrip('/')}/offsets/{batch_id}")
    return json.loads(log.splitlines()[1])["batchWatermarkMs"]


def redelivery_order() -> list[Column]:
    """Which copy of an id is kept: the earliest event, then the other columns."""
    rest = [c for c in schema.RAW_COLUMNS if c not in ("txn_id", "created_at")]
    return [F.col(c).asc_nulls_first() for c in ("created_at", *rest)]


def read_sink(spark: SparkSession, out_path: str) -> DataFrame:
    return spark.read.schema(SINK_SCHEMA).parquet(out_path)


def settled(rows: DataFrame, out_path: str, run: str, delay: str, scratch: str) -> DataFrame:
    """``rows`` (one per id) without those of which the sink has a copy that
    comes before them. Only rows within ``delay`` of their event times are read
    (months by folder, times by row group); a copy that this misses is hidden
    by :func:`read_deduplicated`. ``scratch`` is a new folder that the caller
    deletes when the result is written."""
    spark = rows.sparkSession
    if not ingest.path_exists(spark, out_path):
        return rows
    reach = F.expr(f"INTERVAL {delay}")
    span = rows.agg(F.unix_micros(F.min("created_at") - reach).alias("a"),
                    F.unix_micros(F.max("created_at") + reach).alias("b")).first()
    sink = read_sink(spark, out_path).filter(F.col("run") != run)  # not this batch's own, when it is run again
    if span.a is not None:
        a, b = (F.timestamp_micros(F.lit(x)) for x in span)
        sink = sink.filter(F.col("event_month").isNull() | F.col("event_month").between(
            F.trunc(a, "month"), F.trunc(b, "month"))).filter(F.col("created_at").isNull() | F.col("created_at").between(a, b))
    # The ids first, by one narrow column; the sink's whole rows are then read
    # for the ids that it has, and the rows of the other ids pass as they are.
    rows.select("txn_id").join(sink.select("txn_id"), "txn_id", "left_semi").write.parquet(scratch)
    known = spark.read.schema("txn_id string").parquet(scratch)
    stored = sink.select(*schema.RAW_COLUMNS).join(known, "txn_id", "left_semi")
    both = (rows.join(known, "txn_id", "left_semi").withColumn("stored", F.lit(False))
            .unionByName(stored.withColumn("stored", F.lit(True))))
    order = [*redelivery_order(), F.col("stored").desc()]  # of equal copies the stored one
    first = first_per_key(both, "txn_id", order).filter(~F.col("stored")).drop("stored")
    return rows.join(known, "txn_id", "left_anti").unionByName(first)


def append_new_copies(arrived: DataFrame, fresh_ids: DataFrame, watermark: int, delay: str, out_path: str,
                      run: str) -> None:
    """Append what a micro-batch brings: of each id the first copy in it.

    ``fresh_ids`` are the ids that the state store had not seen. The others are
    redeliveries and dropped, but for copies that may come before the one kept:
    rows behind the watermark, which the state store passes over, and copies
    that are older than the newest event before this batch. Those few are
    settled against the sink; a batch without any does not read it.
    """
    spark = arrived.sparkSession
    late = F.col("created_at").isNull() | (F.col("created_at") <= F.timestamp_millis(F.lit(watermark)))
    newest = F.timestamp_millis(F.lit(watermark + 1)) + F.expr(f"INTERVAL {delay}")
    known = arrived.join(fresh_ids.withColumn("fresh", F.lit(True)), "txn_id", "left")
    rows = known.withColumn("sure", F.col("fresh").isNotNull() & ~late).filter(
        F.col("sure") | late | (F.col("created_at") < newest)).drop("fresh")
    rows = first_per_key(rows, "txn_id", redelivery_order())
    path = scratch_path(spark, "dedup-rows")
    try:
        rows.write.parquet(f"{path}/rows")
        rows = spark.read.schema(rows.schema).parquet(f"{path}/rows")
        sure, open_rows = rows.filter("sure").drop("sure"), rows.filter("not sure").drop("sure")
        if not open_rows.isEmpty():
            sure = sure.unionByName(settled(open_rows, out_path, run, delay, f"{path}/known"))
        (sure.select(*schema.RAW_COLUMNS, F.trunc("created_at", "month").alias("event_month"))
         .hint("REBALANCE", "event_month").sortWithinPartitions("event_month", "created_at")
         .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("event_month")
         .parquet(f"{out_path.rstrip('/')}/run={run}"))
    finally:
        remove_path(spark, path)


def stream_dedup(spark: SparkSession, raw_dir: str, out_path: str, checkpoint: str,
                 delay: str = "1 hour", max_files_per_batch: int | None = None) -> None:
    """Raw files as they arrive -> redelivered copies dropped -> Parquet sink.

    Ids seen within ``delay`` are in Spark's state store
    (``dropDuplicatesWithinWatermark``). Beside them the arrived rows go
    through, so that late ones are not lost: see :func:`append_new_copies`. A
    micro-batch that is run again writes its own folder again."""
    reader = spark.readStream.schema(schema.RAW_SCHEMA)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_batch))
    rows = reader.parquet(raw_dir).filter(F.col("txn_id").isNotNull())
    fresh = (rows.filter(F.col("created_at").isNotNull()).select("txn_id", "created_at")
             .withWatermark("created_at", delay).dropDuplicatesWithinWatermark(["txn_id"]))
    # the state store's rows are marked; a watermark is no property of the others
    both = rows.withColumn("fresh", F.lit(False)).unionByName(
        fresh.withColumn("fresh", F.lit(True)), allowMissingColumns=True)

    def each(batch: DataFrame, batch_id: int) -> None:
        own = spark  # the stream's session plans without AQE: all shuffle partitions times all months would be files
        path = scratch_path(own, "dedup-batch")
        try:
            # run once: a second run would change the state again. In two folders, as the many small files
            # of the state store's partitions would have the few large ones of the arrived rows read by one task
            batch.write.partitionBy("fresh").parquet(path)
            staged = own.read.schema(batch.schema).parquet(path)
            append_new_copies(staged.filter("not fresh").drop("fresh"),
                              staged.filter("fresh").select("txn_id"), batch_watermark(own, checkpoint, batch_id),
                              delay, out_path, f"{query_id(own, checkpoint)}-{batch_id}")
        finally:
            remove_path(own, path)

    q = (both.writeStream.foreachBatch(each)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def read_deduplicated(spark: SparkSession, out_path: str) -> DataFrame:
    """The sink's earliest copy of every id: the same rows whatever the order
    and grouping of arrival. Ids that came back after ``delay`` have several."""
    return first_per_key(read_sink(spark, out_path).select(*schema.RAW_COLUMNS), "txn_id", redelivery_order())


def apply_batch(spark: SparkSession, rows: DataFrame, fact_path: str, query: str, batch_id: int) -> bool:
    """Upsert the fact rows of a micro-batch of raw rows, whatever their event
    time; the batch is recorded with the table in one publication, and a batch
    that the table has already is recognised (False)."""
    from paylake.operators.upsert import upsert
    from paylake.plans.models import fact_from_raw
    publish.recover(spark, fact_path)
    if publish.applied(spark, fact_path).get(query, -1) >= batch_id:
        return False
    upsert(spark, fact_from_raw(rows), fact_path, batch=[query, batch_id])
    return True


def maintain_fact(spark: SparkSession, raw_path: str, fact_path: str, checkpoint: str,
                  max_files_per_batch: int = ingest.DEFAULT_MAX_FILES_PER_BATCH) -> None:
    """Bring the fact up to date with the raw files appended since the last
    run, a keyed upsert for each micro-batch. Raw has an id once
    (``insert_if_absent``), so the rows of a batch are their ids' versions.
    When raw has been dealt out to more buckets its rows come once more and
    change nothing."""
    source = (spark.readStream.schema(schema.RAW_SCHEMA)
              .option("maxFilesPerTrigger", int(max_files_per_batch)).parquet(raw_path))

    def each(batch: DataFrame, batch_id: int) -> None:
        apply_batch(batch.sparkSession, batch, fact_path, query_id(batch.sparkSession, checkpoint), batch_id)

    q = (source.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint)
         .foreachBatch(each).start())
    q.awaitTermination()


def stream_fact(spark: SparkSession, lake_root: str, raw_path: str, log_path: str, fact_path: str,
                checkpoint: str, loaded_at: Column | None = None,
                max_files_per_batch: int = ingest.DEFAULT_MAX_FILES_PER_BATCH) -> None:
    """Lake files -> raw -> fact: everything that has arrived is loaded, then
    the raw rows that are new go into the fact in micro-batches, by their ids."""
    ingest.ingest_stream(spark, lake_root, raw_path, log_path, checkpoint, loaded_at, max_files_per_batch)
    if ingest.path_exists(spark, raw_path):
        maintain_fact(spark, raw_path, fact_path, f"{checkpoint.rstrip('/')}-fact", max_files_per_batch)
