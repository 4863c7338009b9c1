"""Session settings and the shared scratch area."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of the engine should carry. AQE re-plans joins and
# shuffles at run time (coalescing small partitions, splitting skewed ones);
# all timestamps are UTC, as the source writes them.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "paylake") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in ENGINE_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable engine settings to an existing session."""
    for key, value in ENGINE_CONF.items():
        if key.startswith("spark.ui."):
            continue
        spark.conf.set(key, value)
    # file listing (lakes have one folder per year/month/city): one listing
    # task per folder wastes scheduling on small folders; a few tasks per core
    # of the cluster keep listing parallel without thousands of tiny tasks
    cores = spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism",
                   str(min(10000, max(64, 4 * cores))))
    shared_dir(spark)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package (once per application), so that code in
    Python tasks imports it wherever the driver was started from."""
    sc = spark.sparkContext
    here = os.path.dirname(os.path.abspath(__file__))
    if getattr(sc, "_paylake_shipped", False) or not os.path.isdir(here):
        return  # sent before, or the package itself came in an archive
    import zipfile
    archive = os.path.join(tempfile.mkdtemp(prefix="paylake-py-"), "paylake.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(here):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(here)))
    sc.addPyFile(archive)
    sc._paylake_shipped = True


def is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master or ""
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for lineage cuts and staged writes.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir). When
    neither is set, a local session gets a fresh folder; a cluster session is
    an error, since no folder of the driver's machine is shared.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        conf_dir = tempfile.mkdtemp(prefix="paylake-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below the shared folder (never reused)."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of the cluster's store."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a staged folder of this library's own once nothing reads it."""
    fs, p = hadoop_path(spark, path)
    fs.delete(p, True)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python-side helpers can open a local path."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.normpath(path) if path.startswith("/") else path


# Shuffle input per partition when sizing a large shuffle, and the most
# partitions one shuffle may start with (AQE coalesces from there).
TARGET_PARTITION_BYTES = 256 * 1024 * 1024
MAX_SHUFFLE_PARTITIONS = 200_000


def estimated_bytes(df) -> int:
    """Catalyst's size estimate of a DataFrame (metadata only: file sizes
    scaled by the projected columns; no job runs)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def partitions_for(spark: SparkSession, *dfs) -> int:
    """Shuffle partitions that put about ``TARGET_PARTITION_BYTES`` of ``dfs``
    into each (spill-free reducers at any scale); never below the session's
    setting. For plans that run later, as ``repartition(n, key)``."""
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = sum(estimated_bytes(df) for df in dfs)
    if size >= 2 ** 62:  # no statistics (e.g. an in-memory relation): leave as is
        return current
    return max(current, min(MAX_SHUFFLE_PARTITIONS, -(-size // TARGET_PARTITION_BYTES)))


def size_shuffle_for(spark: SparkSession, *dfs) -> int:
    """Raise the session's shuffle partition count to :func:`partitions_for`. Returns the count in force."""
    n = partitions_for(spark, *dfs)
    if n != int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n


class sized_shuffle:  # noqa: N801 - used as a context manager
    """``with sized_shuffle(spark, df, ...): ...`` — :func:`size_shuffle_for`
    for the block only; the session's previous setting is restored after."""

    def __init__(self, spark: SparkSession, *dfs):
        self.spark, self.dfs = spark, dfs

    def __enter__(self):
        self.before = self.spark.conf.get("spark.sql.shuffle.partitions")
        return size_shuffle_for(self.spark, *self.dfs)

    def __exit__(self, *exc):
        self.spark.conf.set("spark.sql.shuffle.partitions", self.before)
        return False


class session_conf:  # noqa: N801 - used as a context manager
    """``with session_conf(spark, {key: value}): ...`` — settings for the block
    only; the session's previous ones are restored after."""

    def __init__(self, spark: SparkSession, conf: dict[str, str]):
        self.spark, self.conf = spark, conf

    def __enter__(self):
        self.before = {key: self.spark.conf.get(key, None) for key in self.conf}
        for key, value in self.conf.items():
            self.spark.conf.set(key, value)

    def __exit__(self, *exc):
        for key, value in self.before.items():
            if value is None:
                self.spark.conf.unset(key)
            else:
                self.spark.conf.set(key, value)
        return False


class pushed_in:  # noqa: N801 - used as a context manager
    """``with pushed_in(spark, n): ...`` — an IN list of up to ``n`` values is
    pushed into Parquet scans as it is, where row groups whose Bloom filter has
    none of them are not read."""

    KEY = "spark.sql.parquet.pushdown.inFilterThreshold"

    def __init__(self, spark: SparkSession, n: int):
        self.spark, self.n = spark, n

    def __enter__(self):
        self.before = self.spark.conf.get(self.KEY)
        self.spark.conf.set(self.KEY, str(max(int(self.before), self.n)))

    def __exit__(self, *exc):
        self.spark.conf.set(self.KEY, self.before)
        return False


def bloom_options(column: str) -> dict[str, str]:
    """Writer options for a Bloom filter of a column, sized to its values."""
    return {f"parquet.bloom.filter.enabled#{column}": "true", "parquet.bloom.filter.adaptive.enabled": "true"}
