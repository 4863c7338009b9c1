"""Keyed upsert of the fact on plain Parquet (no MERGE available).

The fact is partitioned by (txn_year, txn_month). An upsert finds the files
that hold a key of the new rows, wherever these rows lie now, writes those
files anew without the replaced rows and the new rows beside them, and leaves
every other file alone. Few keys are looked up by the Bloom filters that the
files carry, many by a join of the key column. The result is staged beside the
table and published through a manifest (see :mod:`paylake.operators.publish`):
a run that crashed between staging and the end of the publication is finished
by the next run before it reads the table, and staged copies are removed after
success.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.operators import publish
from paylake.schema import FACT_PARTITION_COLUMNS
from paylake.session import bloom_options, pushed_in, remove_path, scratch_path, sized_shuffle
from paylake.sources.ingest import path_exists

# Keys up to which files are found by Bloom filters.
FEW_KEYS = 1_000
# When a partition that is written to has so many files below SMALL_BYTES, they are written as one.
COMPACT_FILES, SMALL_BYTES = 32, 32 * 1024 ** 2


class Outcome(str):
    """``"full"`` or ``"incremental"``, with the old files and bytes that were written anew."""

    files_rewritten: int = 0
    bytes_rewritten: int = 0


def read_target(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path`` after finishing a publication that was cut short;
    None when it does not exist or holds no data file yet (an empty table has
    no schema to read)."""
    from pyspark.errors import AnalysisException
    publish.recover(spark, path)
    if not path_exists(spark, path):
        return None
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


def files_with_keys(target: DataFrame, new: DataFrame, key: str) -> list[str]:
    """The target's files that hold a key of ``new``."""
    spark = target.sparkSession
    held = target.select(key, F.col("_metadata.file_path").alias("__file"))
    few = [r[0] for r in new.select(key).limit(FEW_KEYS + 1).collect()]
    if len(few) <= FEW_KEYS:
        with pushed_in(spark, len(few)):
            found = held.filter(F.col(key).isin(few)).select("__file").distinct().collect()
    else:
        with sized_shuffle(spark, target.select(key), new.select(key)):
            found = held.join(new.select(key), key, "left_semi").select("__file").distinct().collect()
    return [r[0] for r in found]


def small_files(spark: SparkSession, path: str, new: DataFrame, parts: list[str]) -> list[str]:
    """Files to be written as one with the new rows of their partition."""
    out = []
    for values in new.select(*parts).distinct().collect():  # partition values only
        folder = "/".join([path.rstrip("/"), *[
            f"{c}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for c, v in zip(parts, values)]])
        if path_exists(spark, folder):
            small = [f for f, size in publish.files_below(spark, folder) if size < SMALL_BYTES]
            out += small if len(small) >= COMPACT_FILES else []
    return out


def upsert(spark: SparkSession, new: DataFrame, path: str, key: str = "txn_sk",
           parts: list[str] = FACT_PARTITION_COLUMNS, batch: list | None = None) -> Outcome:
    """Replace-or-insert ``new`` (unique on ``key``) into the table at ``path``.

    Columns follow ``new``: an added column is NULL in old rows, a dropped one
    disappears; files that no new row touches are not written again, the
    table's columns are recorded beside them. Only a column that changes its
    type, or comes back after it was dropped, has the whole table rewritten.
    ``batch`` is (query id, batch id) of a streaming query, recorded with the
    publication. Returns ``"full"`` or ``"incremental"``.
    """
    columns = new.columns
    target = read_target(spark, path)
    options = bloom_options(key)
    if target is None:
        publish.rebuild_table(new.select(*columns), path, parts, batch, options)
        return Outcome("full")
    # the new rows feed the steps below: compute them once, into the shared
    # folder, instead of re-running their lineage (raw scan + dedup) each time
    new_path = scratch_path(spark, "upsert-new")
    try:
        new.select(*columns).write.parquet(new_path)
        new = spark.read.schema(new.schema).parquet(new_path).select(*columns)
        if new.isEmpty():
            return Outcome("incremental")
        return _merged(spark, target, new, path, key, parts, batch, options)
    finally:
        remove_path(spark, new_path)


def _merged(spark, target, new, path, key, parts, batch, options) -> Outcome:
    kinds = {f.name: f.dataType for f in target.schema if f.name not in parts}
    own = {f.name: f.dataType for f in new.schema if f.name not in parts}
    dropped = publish.dropped_columns(spark, path)
    whole = any(kinds.get(c, t) != t for c, t in own.items()) or any(c in dropped for c in own if c not in kinds)
    staging = publish.staging_beside(path)
    if whole:
        replaced = [f for f, _ in publish.files_below(spark, path)]
        scope = target
    else:
        replaced = sorted({*files_with_keys(target, new, key), *small_files(spark, path, new, parts)})
        scope = spark.read.schema(target.schema).option("basePath", path).parquet(*replaced) if replaced else None
    result = new
    if scope is not None:
        same = [c for c in new.columns if c in scope.columns]
        result = scope.join(new.select(key), key, "left_anti").select(*same).unionByName(new, allowMissingColumns=True)
    with sized_shuffle(spark, *([new] if scope is None else [scope, new])):
        result.select(*new.columns).hint("REBALANCE", *parts).write.partitionBy(*parts).options(**options).parquet(staging)
    out = Outcome("full" if whole else "incremental")
    sizes = dict(publish.files_below(spark, path))
    out.files_rewritten = len(replaced)
    out.bytes_rewritten = sum(sizes.get(f, 0) for f in replaced)
    if whole:
        publish.publish_table(spark, staging, path, batch)
    elif kinds.keys() == own.keys():
        publish.publish_files(spark, staging, path, replaced, batch=batch)
    else:
        from pyspark.sql.types import StructType
        gone = sorted({*dropped, *[c for c in kinds if c not in own]})
        publish.publish_files(spark, staging, path, replaced, StructType([f for f in new.schema if f.name not in parts]),
                              gone, batch)
    return out
