"""Spark session construction and shared-folder helpers.

Every job in the package runs on a plain ``SparkSession``.  The settings
below are the ones the transforms rely on for correct results (UTC session
time zone, dynamic partition overwrite for idempotent re-runs) plus the
adaptive-execution switches that let Spark re-plan joins, coalesce small
shuffle partitions and split skewed ones at run time.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the package depends on.  Anything already set by the cluster
# (spark-defaults, spark-submit --conf) wins over these defaults.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # remove checkpoint files of lineage cuts once their DataFrames are gone
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Streaming state off the JVM heap with incremental checkpoints.  The window
# state of this package is bounded by (open windows x locations), so the
# default in-memory store is used unless keys are high-cardinality.
ROCKSDB_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def get_session(master: str | None = None, app_name: str = "squall",
                shuffle_partitions: int | None = None,
                extra_conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    ``master`` is left to the launcher when ``None`` (spark-submit decides);
    tests pass ``local[*]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Timestamps are interpreted in UTC everywhere (windows, months, years)."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    On a cluster the folder must be configured (HDFS / object store), because
    files written there have to survive executor loss and be visible to every
    node.  Only a local-mode session without the setting (tests, laptops)
    gets a fresh private folder under the system temp dir.
    """
    sc = spark.sparkContext
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not conf_dir:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; a shared folder is required on a cluster")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="squall-ckpt-"))
        conf_dir = sc.getCheckpointDir()
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(conf_dir)
    return conf_dir.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique sub-folder of the shared folder for one job's output."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def snapshot(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``df`` written once as Parquet in the shared folder and read back
    (filters and columns still reach the scan); the folder is deleted at the
    end of the block."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def local_file_uri(path: str) -> str:
    return path if "://" in path else "file://" + os.path.abspath(path)


def scale_conf(input_bytes: int, target_partition_bytes: int = 128 * 1024 ** 2,
               min_partitions: int = 200) -> dict[str, str]:
    """Shuffle and scan sizing for a job reading ``input_bytes``.

    The initial shuffle partition count is chosen so that each partition
    holds about ``target_partition_bytes`` before adaptive execution
    coalesces small ones and splits skewed ones; scans are cut into splits
    of the same size so a task's input fits comfortably in executor memory.
    At 100 TB this gives ~800k initial partitions, coalesced at run time.
    """
    parts = max(min_partitions, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes":
            str(4 * target_partition_bytes),
    }
