"""The Parquet lake: Hive-style ``year=/month=/city_part=`` folders, Snappy files.

The folder column is ``city_part`` (blanks and hyphens replaced by ``_``),
not ``city``: Spark stores partition values only in the path, so a folder
column named ``city`` would replace the true city name (``Navi Mumbai``)
with its path form (``Navi_Mumbai``) on read. The true name stays in the file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake import schema
from paylake.functions.text import lake_city_key
from paylake.session import session_conf

PARTITION_COLUMNS = ["year", "month", "city_part"]
PARTITIONED_SCHEMA = T.StructType(
    list(schema.LAKE_SCHEMA.fields)
    + [T.StructField("year", T.IntegerType()), T.StructField("month", T.StringType()),
       T.StructField("city_part", T.StringType())])

# A capped write makes a file of every few rows, so its time is that of creating
# files. On a local disk Hadoop's checksummed file system starts four chmod
# processes for a file and its .crc file; the raw one starts one and writes the
# same Parquet file without a .crc file. Other stores ignore the setting. A
# dictionary page does not pay for so few values.
SMALL_FILE_OPTIONS = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true",
                      "parquet.enable.dictionary": "false"}
# Writer tasks of about 1 MB, not 64: their work is files, thousands in each MB.
SMALL_FILE_CONF = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m",
                   "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k"}


def with_lake_keys(df: DataFrame) -> DataFrame:
    """Add the folder columns: year, zero-padded month, sanitised city."""
    return df.select(
        *schema.LAKE_COLUMNS,
        F.year("txn_date").alias("year"),
        F.lpad(F.month("txn_date").cast("string"), 2, "0").alias("month"),
        lake_city_key("city").alias("city_part"),
    )


def write_lake(df: DataFrame, root: str, max_rows_per_file: int | None = None) -> None:
    """Write lake rows under ``root``; reruns replace only the folders they touch.

    ``REBALANCE`` on the folder columns sends each folder to few writer tasks,
    and lets AQE split a hot folder (a metro city) into several evenly sized
    tasks and merge small ones, so neither tiny files nor one giant task
    result. ``maxRecordsPerFile`` is a hard cap on rows per file; a capped
    write is dealt to more, smaller tasks and has no local ``.crc`` files.
    """
    keyed = with_lake_keys(df).hint("REBALANCE", *PARTITION_COLUMNS)
    w = (keyed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .option("compression", "snappy").partitionBy(*PARTITION_COLUMNS))
    if not max_rows_per_file:
        w.parquet(root)
        return
    with session_conf(df.sparkSession, SMALL_FILE_CONF):
        w.options(**SMALL_FILE_OPTIONS).option("maxRecordsPerFile", int(max_rows_per_file)).parquet(root)


def scan_lake(spark: SparkSession, root: str) -> DataFrame:
    """Every ``*.parquet`` below ``root``, at any depth, with the file schema.

    Recursive lookup turns partition discovery off, so the columns come from
    the files only (a foreign lake whose folder is ``city=Navi_Mumbai`` still
    yields the file's ``Navi Mumbai``)."""
    return (spark.read.schema(schema.LAKE_SCHEMA)
            .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
            .parquet(root))


def scan_foreign_lake(spark: SparkSession, root: str) -> DataFrame:
    """A lake written by pandas (nanosecond timestamps, untyped all-NULL
    columns): normalised once into the shared folder, then read natively."""
    from paylake.session import scratch_path
    from paylake.sources.ingest import normalize_foreign
    staged = normalize_foreign(spark, [root], scratch_path(spark, "foreign-lake"), recursive=True)
    return staged.select(*schema.LAKE_COLUMNS)


def scan_partitioned(spark: SparkSession, root: str) -> DataFrame:
    """The lake with its folder columns; filters on them prune folders."""
    return spark.read.schema(PARTITIONED_SCHEMA).parquet(root)


def scan_pruned(spark: SparkSession, root: str, month: str | None = None,
                city: str | None = None, year: int | None = None) -> DataFrame:
    """Rows of the selected folders only (``PartitionFilters`` in the plan)."""
    df = scan_partitioned(spark, root)
    if year is not None:
        df = df.filter(F.col("year") == F.lit(year))
    if month is not None:
        df = df.filter(F.col("month") == F.lit(month))
    if city is not None:
        df = df.filter(F.col("city_part") == lake_city_key(F.lit(city)))
    return df


def file_listing(spark: SparkSession, root: str) -> DataFrame:
    """Path, size and time of every Parquet file under ``root`` (contents unread)."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.parquet").load(root)
            .select(F.col("path").alias("object_key"), F.col("length"), F.col("modificationTime")))


def rows_per_file(spark: SparkSession, root: str) -> DataFrame:
    """Rows of every file with its folder (check of a rows-per-file cap)."""
    df = scan_partitioned(spark, root).select(*PARTITION_COLUMNS, F.col("_metadata.file_path").alias("file"))
    return df.groupBy(*PARTITION_COLUMNS, "file").agg(F.count(F.lit(1)).alias("rows"))
