"""Spark session and shared-storage helpers.

Library code never creates its own scratch space on a local disk: tables
that cut lineage are written below the folder the cluster names in
``spark.checkpoint.dir``, or where it names none, in its warehouse. Only tests
and local runs use a folder of their own, and only when that value is unset.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Session settings this library relies on (fixed values).
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "sitelens") -> SparkSession:
    """Return the active session or build one for local runs and tests."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder, setting one only where it is unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return _shared(spark, current)
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if sc.master.startswith("local"):
            configured = fallback or os.environ.get("SITELENS_CHECKPOINT_DIR", "/tmp/sitelens-checkpoints")
        else:
            # A cluster's machines share its warehouse, too.
            configured = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_sitelens"
    sc.setCheckpointDir(configured)
    return _shared(spark, sc.getCheckpointDir())


_SEEN: set[tuple[str, str]] = set()


def _shared(spark: SparkSession, folder: str) -> str:
    """The folder, unless it is local to each machine of a cluster (a master that
    starts with ``local`` has all its executors on this machine). A ``file:`` folder
    may be a mount that all machines have, so it is tried, once per application."""
    sc = spark.sparkContext
    if not folder.startswith("file:") or sc.master.startswith("local") or (sc.applicationId, folder) in _SEEN:
        return folder
    if not _seen_by_all(spark, folder):
        raise RuntimeError(f"spark.checkpoint.dir is {folder}; executors on other machines do not see it: "
                           "set it to a shared folder (e.g. on the cluster's distributed file system)")
    _SEEN.add((sc.applicationId, folder))
    return folder


def _seen_by_all(spark: SparkSession, folder: str) -> bool:
    """Whether the driver and the executors find what all the executors write there:
    a task for each core writes a row, and the rows are read again."""
    tasks = max(2, spark.sparkContext.defaultParallelism)
    path = f"{folder.rstrip('/')}/seen-{uuid.uuid4().hex[:12]}"
    spark.range(0, tasks, 1, tasks).write.parquet(path)
    return spark.read.schema("id long").parquet(path).count() == tasks


def shared_root(spark: SparkSession) -> str:
    """The configured shared folder itself (``checkpoint()`` data goes to a
    per-application subfolder of it); used for data several applications reuse."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    return ensure_checkpoint_dir(spark).rstrip("/").rsplit("/", 1)[0]


def shared_table_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location for a materialized table in the shared folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"


_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is planned and run inside leaves no shuffle files: Spark drops them when
    the query ends instead of when the driver next collects garbage."""
    before = spark.conf.get(_CLEAN_UP, None)
    spark.conf.set(_CLEAN_UP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEAN_UP)
        else:
            spark.conf.set(_CLEAN_UP, before)


def write_table(df: DataFrame, name: str, partition_by: list[str] | None = None, add_to: str | None = None) -> str:
    """Write ``df`` as parquet to a new folder in shared storage, or add it to the
    table at ``add_to``; return the path."""
    path = add_to or shared_table_path(df.sparkSession, name)
    writer = df.write.mode("append" if add_to else "overwrite").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with dropping_shuffles(df.sparkSession):
        writer.parquet(path)
    return path


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as parquet to shared storage and read it back.

    This is how the library cuts lineage between pipeline layers: the
    written table survives executor loss (unlike a cache or a local
    checkpoint) and the read-back plan starts from a plain file scan.
    """
    return df.sparkSession.read.parquet(write_table(df, name, partition_by))


def scale_conf(spark: SparkSession, input_bytes: int, target_partition_bytes: int = 128 * 1024 * 1024) -> int:
    """Size shuffles for an input of ``input_bytes``: start with one shuffle
    partition per ``target_partition_bytes`` of input (AQE coalesces the
    small ones and splits skewed ones), and read files in splits of the same
    size, so every task's share fits executor memory and spills stay rare."""
    n = max(int(spark.sparkContext.defaultParallelism), -(-input_bytes // target_partition_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_partition_bytes))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(target_partition_bytes))
    return n
