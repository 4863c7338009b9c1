"""Lake -> raw: cleaning on load, state lookup, insert-if-absent, load log."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake import schema
from paylake.operators.joins import lookup_left
from paylake.sources import fixed, relations


def clean_on_load(lake: DataFrame) -> DataFrame:
    """Make lake rows safe for the raw schema.

    NaN amounts become NULL; the date, hour and flags are cast; the amount is
    cast to decimal(12,2) with ``try_cast`` so an overflowing value cannot
    fail a whole job. A load checks :func:`violation` first, so a file with such
    a row fails and nothing of it is lost unseen.
    """
    amt = F.col("amount_inr").cast("double")
    return lake.select(
        "txn_id",
        F.when(F.isnan(amt), F.lit(None)).otherwise(amt).try_cast(schema.AMOUNT).alias("amount_inr"),
        "city", "merchant_category", "upi_app", "payment_type", "status",
        F.when(F.col("failure_reason").isin("NaN", "nan"), F.lit(None))
         .otherwise(F.col("failure_reason")).alias("failure_reason"),
        F.col("txn_date").cast("date").alias("txn_date"),
        F.col("txn_hour").cast("smallint").alias("txn_hour"),
        F.col("is_weekend").cast("boolean").alias("is_weekend"),
        F.coalesce(F.col("is_festival").cast("boolean"), F.lit(False)).alias("is_festival"),
        "sender_upi", "receiver_upi", "device_type",
        F.col("created_at").cast("timestamp").alias("created_at"),
    )


def with_state(df: DataFrame) -> DataFrame:
    """Add ``state`` by exact city name; unknown cities get 'Unknown'."""
    lookup = relations.source_city_state(df.sparkSession)
    out = lookup_left(df, lookup.withColumnRenamed("state", "__state"),
                      relations.ROW_BOUND["source_city_state"], "city", "city", ["__state"])
    return out.withColumn("state", F.coalesce(F.col("__state"), F.lit(fixed.UNKNOWN_STATE))).drop("__state")


def to_raw(lake: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Lake rows -> raw transaction rows (18 columns)."""
    out = with_state(clean_on_load(lake))
    out = out.withColumn("loaded_at", loaded_at if loaded_at is not None else F.current_timestamp())
    return out.select(*[F.col(n).cast(t).alias(n) for n, t in schema.RAW_FIELDS])


# --------------------------------------------------------------------------
# incremental file ingest
# --------------------------------------------------------------------------
BINARY_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
# One load holds at most so many files and bytes; neither changes a result.
DEFAULT_MAX_FILES_PER_BATCH = 10_000
DEFAULT_MAX_BYTES_PER_BATCH = 2 * 1024 ** 4
# Files of one bucket of the raw table, in bytes, and the bounds of a bucket
# count. A table that has outgrown twice that is dealt out to more buckets.
BUCKET_BYTES = 512 * 1024 ** 2
MIN_BUCKETS, MAX_BUCKETS = 16, 65_536
# A load of at most so many rows looks its ids up by Bloom filters.
SMALL_LOAD = 1_000


def path_exists(spark, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


class Unprobed(Exception):
    """The file's scheme cannot be opened from Python (left to Spark's reader)."""


# Hadoop's S3 schemes as pyarrow names them
_ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def _arrow_uri(path: str) -> str:
    """A Hadoop-style URI in the form pyarrow's file systems expect."""
    scheme, sep, rest = path.partition("://")
    return f"{_ARROW_SCHEMES.get(scheme, scheme)}{sep}{rest}"


def _footer(path: str):
    """Parquet footer of a file (reads the file tail only)."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    from paylake.session import local_path
    if path.startswith("file:") or path.startswith("/"):
        return pq.read_metadata(local_path(path))
    try:
        filesystem, inner = fs.FileSystem.from_uri(_arrow_uri(path))
    except Exception as e:  # noqa: BLE001 - e.g. a scheme pyarrow has no driver for
        raise Unprobed(str(e)) from e
    with filesystem.open_input_file(inner) as f:
        return pq.ParquetFile(f).metadata


# Parquet storage each lake column may have: physical types, and for numbers
# stored as INT32/INT64 the logical type they need.
_STORED = {T.StringType: {"BYTE_ARRAY"}, T.DoubleType: {"DOUBLE", "FLOAT"}, T.ByteType: {"INT32"},
           T.BooleanType: {"BOOLEAN"}, T.DateType: {"INT32"}, T.TimestampType: {"INT64", "INT96"}}
_LOGICAL = {T.DateType: "date", T.TimestampType: "timestamp"}


def check_footer(md) -> tuple[str | None, str | None]:
    """(how to read, error) of a footer: ``native``, ``ns`` (created_at in
    nanoseconds) or ``untyped`` (an all-NULL column of Parquet's null type),
    and the first column whose stored type is not the lake's."""
    stored = {}
    for i in range(len(md.schema)):
        col = md.schema.column(i)
        stored[col.name] = (col.physical_type, str(col.logical_type).lower())
    how = "native"
    for name, kind in schema.LAKE_FIELDS:
        if name not in stored:
            continue  # read as NULL: the NOT NULL check decides
        physical, logical = stored[name]
        if logical == "null":
            how = "ns" if how == "ns" else "untyped"
            continue
        wanted = _LOGICAL.get(type(kind))
        if physical not in _STORED[type(kind)] or (wanted and physical != "INT96" and wanted not in logical):
            return None, (f'column "{name}" is of type {kind.simpleString()} but the file stores '
                          f"{physical} ({logical})")
        if name == "created_at" and "nano" in logical:
            how = "ns"
    return how, None


def probe_files(files: DataFrame) -> DataFrame:
    """(object_key, how, error, rows): can each file be read, by which reader,
    and how many rows does its footer promise?

    Runs as Arrow batches on the executors, one footer read per file, so a
    truncated file or one of another type is found without failing the load
    of the rest.
    """
    def probe(batches):
        import pandas as pd
        for pdf in batches:
            found = []
            for key in pdf["object_key"]:
                how = error = rows = None
                try:
                    footer = _footer(key)
                    rows = footer.num_rows
                    how, error = check_footer(footer)
                except Unprobed:
                    # no Python access to this store: Spark's reader decides
                    how = "native"
                except Exception as e:  # noqa: BLE001 - any unreadable file is a failed load
                    error = f"{type(e).__name__}: {e}"
                found.append((key, how, error, rows))
            yield pd.DataFrame(found, columns=["object_key", "how", "error", "rows"]).astype({"rows": "Int64"})
    return files.select("object_key").mapInPandas(probe, "object_key string, how string, error string, rows long")


def damage(files: DataFrame) -> DataFrame:
    """(object_key, error) of files that were read in part: every page is
    decoded once more, by another reader, for what is wrong with it. NULL: the
    file is whole."""
    def decode(batches):
        import pandas as pd
        import pyarrow.parquet as pq
        from pyarrow import fs

        from paylake.session import local_path
        for pdf in batches:
            errors = []
            for key in pdf["object_key"]:
                error = None
                try:
                    if key.startswith(("file:", "/")):
                        store, inner = fs.LocalFileSystem(), local_path(key)
                    else:
                        store, inner = fs.FileSystem.from_uri(_arrow_uri(key))
                    with store.open_input_file(inner) as f:
                        for _ in pq.ParquetFile(f).iter_batches():
                            pass
                except Exception as e:  # noqa: BLE001 - what is wrong with the file
                    error = f"{type(e).__name__}: {e}"
                errors.append(error)
            yield pd.DataFrame({"object_key": pdf["object_key"], "error": errors})
    return files.select("object_key").mapInPandas(decode, "object_key string, error string")


FOREIGN_READ_CONF = {
    # nanosecond timestamps: read as the raw long (Spark has no ns type)
    "spark.sql.legacy.parquet.nanosAsLong": "true",
    # the row-based reader also reads all-NULL columns stored with Parquet's null type
    "spark.sql.parquet.enableVectorizedReader": "false",
}


def _with_file_columns(df: DataFrame) -> DataFrame:
    return df.select(*schema.LAKE_COLUMNS, F.col("_metadata.file_path").alias("object_key"),
                     F.col("_metadata.row_index").alias("row_index"))


def normalize_foreign(spark, paths: list[str], staging: str, recursive: bool = False,
                      nanos: bool = True, skip_damage: bool = False) -> DataFrame:
    """Rewrite lake files that the native reader refuses into the native schema.

    With ``nanos``, ``created_at`` is read as nanoseconds since the epoch and
    converted with integer division to microseconds; without, it is in a unit
    the reader knows and only untyped columns are at issue. File path and row
    position are kept so first-copy-wins still sees the original files. The
    foreign-read settings are those of a session of its own; the result is
    staged in the shared folder and read back under the normal ones.
    """
    fields = [f if not nanos or f.name != "created_at" else T.StructField("created_at", T.LongType())
              for f in schema.LAKE_SCHEMA.fields]
    own = spark.newSession()
    for k, v in {"spark.sql.session.timeZone": "UTC", **FOREIGN_READ_CONF}.items():
        own.conf.set(k, v)
    reader = own.read.schema(T.StructType(fields)).option("ignoreCorruptFiles", str(skip_damage).lower())
    if recursive:
        reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    df = _with_file_columns(reader.parquet(*paths))
    if nanos:
        df = df.withColumn("created_at", F.expr("timestamp_micros(created_at div 1000)"))
    df.write.parquet(staging)
    return spark.read.schema(df.schema).parquet(staging)


def first_per_id(rows: DataFrame) -> DataFrame:
    """Within one load, the first copy of each txn_id wins: lowest object key,
    then lowest row position in the file (the order a serial loader inserts)."""
    from paylake.operators.dedup import first_per_key
    return first_per_key(rows, "txn_id", [F.col("object_key").asc(), F.col("row_index").asc()])


def raw_buckets(spark, raw_path: str) -> int | None:
    """Buckets of the raw table's files, as recorded when it was created; None
    for a folder that another writer made."""
    from paylake.session import hadoop_path
    fs, p = hadoop_path(spark, f"{raw_path.rstrip('/')}/_buckets")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return stream.readInt()
    finally:
        stream.close()


def folder_bytes(spark, path: str) -> int:
    from paylake.session import hadoop_path
    fs, p = hadoop_path(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def buckets_for(size: int) -> int:
    """Buckets of a raw table of ``size`` bytes: a power of two, so that the
    table may double before a bucket is over :data:`BUCKET_BYTES`."""
    n = MIN_BUCKETS
    while n < MAX_BUCKETS and n * BUCKET_BYTES < 2 * size:
        n *= 2
    return n


def raw_table(spark, raw_path: str, buckets: int | None = None) -> str | None:
    """The catalog's name for the raw folder as a table bucketed and sorted by
    txn_id, with a Bloom filter of the ids in every row group (its files stay
    plain Parquet for every other reader). Creates the folder with ``buckets``
    if there is none."""
    from paylake.session import bloom_options, hadoop_path
    n = raw_buckets(spark, raw_path)
    if n is None:
        if path_exists(spark, raw_path):
            return None
        n = buckets or MIN_BUCKETS
        fs, p = hadoop_path(spark, f"{raw_path.rstrip('/')}/_buckets")
        out = fs.create(p, True)
        try:
            out.writeInt(n)
        finally:
            out.close()
    name = f"paylake_raw_{hashlib.md5(raw_path.rstrip('/').encode()).hexdigest()}_{n}"
    if not spark.catalog.tableExists(name):
        cols = ", ".join(f"{c} {t.simpleString()}" for c, t in schema.RAW_FIELDS)
        bloom = ", ".join(f"'{k}' = '{v}'" for k, v in bloom_options("txn_id").items())
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet "
                  f"OPTIONS ({bloom}) CLUSTERED BY (txn_id) "
                  f"SORTED BY (txn_id) INTO {n} BUCKETS LOCATION '{raw_path.rstrip('/')}'")
    spark.catalog.refreshTable(name)
    return name


def grow_buckets(spark, raw_path: str) -> int | None:
    """Deals the raw table out to more buckets when those it has hold over
    twice :data:`BUCKET_BYTES`: rewritten beside it and published through the
    manifest, so a crash leaves the old table or the new one. One shuffle of
    raw each time it has grown fourfold, and its many small files become one a
    bucket. Returns the buckets it has now (None: another writer's folder)."""
    from paylake.operators import publish
    publish.recover(spark, raw_path)
    n, size = raw_buckets(spark, raw_path), folder_bytes(spark, raw_path)
    if n is None or n >= MAX_BUCKETS or size <= 2 * n * BUCKET_BYTES:
        return n
    more = buckets_for(size)
    staging = publish.staging_beside(raw_path)
    name = raw_table(spark, staging, more)
    (spark.read.schema(schema.RAW_SCHEMA).parquet(raw_path).repartition(more, "txn_id")
     .write.insertInto(name))
    spark.sql(f"DROP TABLE {name}")  # the catalog's entry; the files stay
    publish.publish_table(spark, staging, raw_path)
    return more


def _found(spark, ids: list[str], raw_path: str) -> list[str]:
    """Those of a few ids that raw has. The ids are pushed into the scan, where
    row groups whose Bloom filter has none of them are not read."""
    from paylake.session import pushed_in
    with pushed_in(spark, len(ids)):
        rows = spark.read.schema("txn_id string").parquet(raw_path).filter(F.col("txn_id").isin(ids)).distinct().collect()
    return [r.txn_id for r in rows]


def absent_rows(spark, rows: DataFrame, raw_path: str) -> DataFrame:
    """``rows`` (unique txn_id) whose id is not in raw. A few ids are looked up
    by Bloom filters. Else raw streams its id column bucket by bucket past the
    batch's ids of that bucket: it is neither shuffled nor sorted, whatever the
    size of either side; only the batch is dealt out to raw's buckets."""
    name = raw_table(spark, raw_path)
    few = [r.txn_id for r in rows.select("txn_id").limit(SMALL_LOAD + 1).collect()]
    n = raw_buckets(spark, raw_path)
    if len(few) <= SMALL_LOAD:
        present = _found(spark, few, raw_path) if few else []
        absent = rows.filter(~F.col("txn_id").isin(present)) if present else rows
        return absent.repartition(n, "txn_id") if n else absent
    if name is None:
        from paylake.session import partitions_for
        raw = spark.read.schema(schema.RAW_SCHEMA).parquet(raw_path).select("txn_id")
        m = partitions_for(spark, raw, rows)
        return rows.repartition(m, "txn_id").join(raw.repartition(m, "txn_id"), "txn_id", "left_anti")
    ids = rows.select("txn_id").repartition(n, "txn_id").hint("shuffle_hash")
    present = spark.table(name).select("txn_id").join(ids, "txn_id", "left_semi")
    return rows.repartition(n, "txn_id").join(present, "txn_id", "left_anti")


def insert_if_absent(spark, new_raw: DataFrame, raw_path: str) -> None:
    """Append rows whose txn_id is not yet in the raw table (NULL ids never
    enter: the key is NOT NULL). Writes are appends of absent ids only, so a
    replayed batch inserts nothing twice. The batch is first written to the
    shared folder: its lineage (file reads, first-copy dedup) runs once, and a
    new table takes its bucket count from the batch's size.
    """
    from paylake.session import remove_path, scratch_path
    staged = scratch_path(spark, "insert-batch")
    try:
        new_raw.filter(F.col("txn_id").isNotNull()).select(*schema.RAW_COLUMNS).write.parquet(staged)
        rows = spark.read.schema(schema.RAW_SCHEMA).parquet(staged)
        if path_exists(spark, raw_path):
            grow_buckets(spark, raw_path)
        name = raw_table(spark, raw_path, buckets_for(folder_bytes(spark, staged)))
        absent = absent_rows(spark, rows, raw_path).select(*schema.RAW_COLUMNS)
        if name is None:
            absent.write.mode("append").parquet(raw_path)
        else:
            absent.write.insertInto(name)
    finally:
        remove_path(spark, staged)


def violation(lake: DataFrame) -> Column:
    """The message of the first raw-table constraint a lake row breaks (NULL:
    none): every column but failure_reason is NOT NULL, and an amount must fit
    decimal(12,2)."""
    amount = F.col("amount_inr").cast("double")
    clean = {f.name: f for f in schema.RAW_SCHEMA.fields}
    out = F.when(amount.isNotNull() & ~F.isnan(amount) & amount.try_cast(schema.AMOUNT).isNull(),
                 F.lit("numeric field overflow: amount_inr does not fit decimal(12,2)"))
    for name in clean:
        if name in schema.RAW_NULLABLE or name not in lake.columns:
            continue
        missing = F.col(name).isNull() | (F.isnan(amount) if name == "amount_inr" else F.lit(False))
        out = out.when(missing, F.lit(f'null value in column "{name}" violates not-null constraint'))
    return out


class LoadError(RuntimeError):
    """A load that read a whole file in part: the engine or the store failed, not the file."""


def load_files(spark, new_files: DataFrame, raw_path: str, log_path: str,
               loaded_at: Column | None = None) -> None:
    """Load one batch of new lake files into the raw table and log each file.

    A file fails as a whole, alone, with the reason logged and none of its
    rows inserted, when its footer cannot be read or has another type, when a
    row breaks a constraint of the raw table, or when its pages turn out to be
    damaged. The last is only seen while decoding: the scan leaves such a file
    where it breaks off, and it has fewer rows than its footer promises. All
    files are read once; only those are looked at again. Other files are logged
    ``success`` with their row count. An error of the engine fails the run and
    logs nothing.
    """
    # one row per file of this batch (bounded by the batch's caps)
    files = probe_files(new_files).collect()
    bad = [(r.object_key, r.error) for r in files if r.error is not None]
    if bad:
        _log_failed(spark, bad, log_path)
    readable = sorted((r.object_key, r.how, r.rows) for r in files if r.error is None)
    if readable:
        _load_readable(spark, readable, raw_path, log_path, loaded_at)


def _log_failed(spark, bad: list[tuple[str, str]], log_path: str) -> None:
    rows = spark.createDataFrame([(k, 0, "failed", e) for k, e in bad],
                                 "object_key string, row_count long, status string, error_message string")
    _append_log(rows, log_path)


def _append_log(rows: DataFrame, log_path: str) -> None:
    rows.withColumn("loaded_at", F.current_timestamp()).select(*schema.LOAD_LOG_SCHEMA.fieldNames()) \
        .write.mode("append").parquet(log_path)


def _stage_rows(spark, files: list[tuple[str, str, int]], made: list[str]) -> str:
    """All rows of the files in one staged folder (every page is decoded here),
    with file, position and the constraint broken. ``made`` gets the folders."""
    from paylake.session import scratch_path
    parts = []
    for how in ("native", "ns", "untyped"):
        keys = [k for k, h, _ in files if h == how]
        if keys and how == "native":
            parts.append(_with_file_columns(spark.read.schema(schema.LAKE_SCHEMA)
                                            .option("ignoreCorruptFiles", "true").parquet(*keys)))
        elif keys:
            made.append(scratch_path(spark, "foreign-normalized"))
            parts.append(normalize_foreign(spark, keys, made[-1], nanos=how == "ns", skip_damage=True))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    made.append(scratch_path(spark, "load-rows"))
    rows.withColumn("violation", violation(rows)).write.parquet(made[-1])
    return made[-1]


def _promised(spark, files: list[tuple[str, str, int]]) -> DataFrame:
    """(object_key, promised): rows by the footers. Where Python could not read
    them, Spark counts them (no column is read)."""
    known = spark.createDataFrame([(k, n) for k, _, n in files], "object_key string, promised long")
    blind = [k for k, _, n in files if n is None]
    if not blind:
        return known
    counted = (spark.read.schema(schema.LAKE_SCHEMA).option("ignoreCorruptFiles", "true").parquet(*blind)
               .groupBy(F.col("_metadata.file_path").alias("of")).agg(F.count(F.lit(1)).alias("n")))
    return known.join(counted, known.object_key == F.col("of"), "left").select(
        "object_key", F.coalesce("promised", "n", F.lit(-1)).alias("promised"))


def _damaged(spark, promised: DataFrame, stats: DataFrame) -> list[tuple[str, str]]:
    """(object_key, message) of the files that were read in part."""
    short = (promised.join(stats, "object_key", "left")
             .filter(F.coalesce("rows", F.lit(0)) != F.col("promised"))
             .select("object_key", F.coalesce("rows", F.lit(0)).alias("rows"), "promised").collect())
    if not short:
        return []
    names = spark.createDataFrame([(r.object_key,) for r in short], "object_key string")
    reasons = {r.object_key: r.error for r in damage(names.repartition(min(len(short), 1000))).collect()}
    whole = [k for k, e in reasons.items() if e is None]
    if whole:
        raise LoadError(f"read in part, though the files are whole: {', '.join(sorted(whole)[:5])}")
    return [(r.object_key, f"damaged: {r.rows} of {r.promised} rows could be read. {reasons[r.object_key]}") for r in short]


def _load_readable(spark, files: list[tuple[str, str, int]], raw_path: str, log_path: str,
                   loaded_at: Column | None) -> None:
    from paylake.operators.joins import bounded
    from paylake.session import remove_path
    made: list[str] = []
    try:
        data = spark.read.parquet(_stage_rows(spark, files, made))
        first_bad = F.min(F.when(F.col("violation").isNotNull(), F.struct("row_index", "violation")))
        stats = data.groupBy("object_key").agg(F.count(F.lit(1)).alias("rows"), first_bad.alias("bad"))
        broken = _damaged(spark, _promised(spark, files), stats)
        if broken:
            _log_failed(spark, broken, log_path)
        out = {k for k, _ in broken}
        # an empty file has no row; one read in part is logged already
        names = spark.createDataFrame([(k,) for k, _, _ in files if k not in out], "object_key string")
        ok = names.join(stats.where("bad IS NOT NULL"), "object_key", "left_anti")
        rows = data.join(bounded(ok, len(files)), "object_key", "left_semi").drop("violation")
        insert_if_absent(spark, to_raw(first_per_id(rows).drop("object_key", "row_index"), loaded_at), raw_path)
        good = F.col("bad").isNull()
        _append_log(names.join(stats, "object_key", "left").select(
            "object_key", F.when(good, F.coalesce("rows", F.lit(0))).otherwise(0).cast("long").alias("row_count"),
            F.when(good, F.lit("success")).otherwise(F.lit("failed")).alias("status"),
            F.col("bad.violation").alias("error_message")), log_path)
    finally:
        for path in made:
            remove_path(spark, path)


def read_log(spark, log_path: str) -> DataFrame:
    return spark.read.schema(schema.LOAD_LOG_SCHEMA).parquet(log_path)


def latest_log(log: DataFrame) -> DataFrame:
    """The log as a keyed table: per object_key the newest attempt replaces
    older ones (insert, or on conflict update status, count, message, time)."""
    newest = F.max(F.struct("loaded_at", "status", "row_count", "error_message")).alias("s")
    return log.groupBy("object_key").agg(newest).select(
        "object_key", "s.row_count", "s.status", "s.error_message", "s.loaded_at")


def pending_files(spark, lake_root: str, log_path: str | None) -> DataFrame:
    """Lake files not yet logged as loaded successfully (anti join on the key)."""
    from paylake.sources.lake import file_listing
    files = file_listing(spark, lake_root).select("object_key", "length")
    if log_path and path_exists(spark, log_path):
        done = latest_log(read_log(spark, log_path)).filter(F.col("status") == "success").select("object_key")
        files = files.join(done, "object_key", "left_anti")
    return files


def ingest_batch(spark, lake_root: str, raw_path: str, log_path: str,
                 loaded_at: Column | None = None,
                 max_files_per_batch: int = DEFAULT_MAX_FILES_PER_BATCH) -> None:
    """One batch run of the loader: every file not yet loaded successfully
    (failed files included, so a rerun retries them), in object-key order."""
    load_in_order(spark, pending_files(spark, lake_root, log_path), raw_path, log_path, loaded_at,
                  max_files_per_batch)


def load_in_order(spark, files: DataFrame, raw_path: str, log_path: str, loaded_at: Column | None = None,
                  max_files_per_batch: int = DEFAULT_MAX_FILES_PER_BATCH,
                  max_bytes_per_batch: int = DEFAULT_MAX_BYTES_PER_BATCH) -> None:
    """Load ``files`` (object_key, length) in key order, as many per load as
    the caps on files and bytes allow (one file at least). The keys are
    streamed to the driver a partition at a time; at most one chunk is held."""
    chunk: list[str] = []
    size = 0
    for row in files.select("object_key", "length").orderBy("object_key").toLocalIterator():
        if chunk and (len(chunk) >= max_files_per_batch or size + row.length > max_bytes_per_batch):
            _load_keys(spark, chunk, raw_path, log_path, loaded_at)
            chunk, size = [], 0
        chunk.append(row.object_key)
        size += row.length
    if chunk:
        _load_keys(spark, chunk, raw_path, log_path, loaded_at)


def _load_keys(spark, keys: list[str], raw_path: str, log_path: str, loaded_at: Column | None) -> None:
    files = spark.createDataFrame([(k,) for k in keys], "object_key string")
    load_files(spark, files, raw_path, log_path, loaded_at)


def arrivals_path(log_path: str) -> str:
    return f"{log_path.rstrip('/')}-arrivals"


def register_arrivals(spark, lake_root: str, log_path: str, checkpoint: str,
                      max_files_per_batch: int = DEFAULT_MAX_FILES_PER_BATCH) -> None:
    """The streaming half of the ingest: a Structured Streaming query over the
    file listing (contents unread) that records every file once it is seen.
    The file source remembers offered files in its checkpoint; a replayed
    micro-batch records keys twice, which changes nothing."""
    listing = (spark.readStream.format("binaryFile").schema(BINARY_SCHEMA)
               .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
               .option("maxFilesPerTrigger", int(max_files_per_batch))
               .load(lake_root).select(F.col("path").alias("object_key"), "length"))

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("append").parquet(arrivals_path(log_path))

    q = (listing.writeStream.trigger(availableNow=True)
         .option("checkpointLocation", checkpoint).foreachBatch(each).start())
    q.awaitTermination()


def arrived_files(spark, log_path: str) -> DataFrame:
    """Recorded files that have no log entry yet (failed ones have: see :func:`retry_failed`)."""
    files = spark.read.schema("object_key string, length long").parquet(arrivals_path(log_path)) \
        .groupBy("object_key").agg(F.max("length").alias("length"))
    if path_exists(spark, log_path):
        files = files.join(read_log(spark, log_path).select("object_key").distinct(), "object_key", "left_anti")
    return files


def ingest_stream(spark, lake_root: str, raw_path: str, log_path: str, checkpoint: str,
                  loaded_at: Column | None = None,
                  max_files_per_batch: int = DEFAULT_MAX_FILES_PER_BATCH) -> None:
    """Incremental ingest: the stream records what arrived since the last run
    (``availableNow``), then all recorded files without a log entry are loaded
    in key order. Which copy of an id wins is thus decided by file key among
    everything that has arrived, not by how the stream cut it into
    micro-batches. A run that broke off anywhere is resumed by the next one:
    recorded files stay pending until logged, and insert-if-absent makes a
    repeated load harmless.
    """
    register_arrivals(spark, lake_root, log_path, checkpoint, max_files_per_batch)
    if path_exists(spark, arrivals_path(log_path)):
        load_in_order(spark, arrived_files(spark, log_path), raw_path, log_path, loaded_at)


def retry_failed(spark, lake_root: str, raw_path: str, log_path: str,
                 loaded_at: Column | None = None,
                 max_files_per_batch: int = DEFAULT_MAX_FILES_PER_BATCH) -> None:
    """Load again, in capped chunks, the files whose newest log entry is ``failed``."""
    from paylake.sources.lake import file_listing
    failed = latest_log(read_log(spark, log_path)).filter(F.col("status") == "failed").select("object_key")
    files = file_listing(spark, lake_root).select("object_key", "length").join(failed, "object_key", "left_semi")
    load_in_order(spark, files, raw_path, log_path, loaded_at, max_files_per_batch)
