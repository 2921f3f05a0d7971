"""Spark session and the shared working folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

STATE_STORE = "spark.sql.streaming.stateStore."
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of rows that a Python worker gets at once.
BATCH = "4m"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "curbside", large_state: bool = False, **conf: str) -> SparkSession:
    """UTC session with adaptive execution.

    Leave ``shuffle_partitions`` unset on a cluster and size
    ``spark.sql.adaptive.coalescePartitions.initialPartitionNum`` instead: adaptive
    execution merges small shuffle partitions but cannot add any. Streaming state is
    not adaptive; there ``spark.sql.shuffle.partitions`` is fixed by the first start.
    ``large_state`` keeps streaming state in RocksDB instead of the executors' heap and
    checkpoints only what changed. Further settings: dots in their names as two underscores.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if large_state:
        builder = builder.config(STATE_STORE + "providerClass", ROCKSDB).config(
            STATE_STORE + "rocksdb.changelogCheckpointing.enabled", "true")
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder that every executor can reach.

    It lies below ``spark.checkpoint.dir``; where that is unset, below the warehouse, which
    executors share as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or (
        spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Removes a folder that nothing reads any more; one that is missing is no error."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def small_batches(spark: SparkSession) -> None:
    """Batches for Python are cut by bytes, unless the session's owner has set a number of their own.

    Else a batch is 10,000 rows or 64 MB, whatever the texts; executor and worker hold it several times.
    """
    if spark.conf.get(ARROW_BYTES, None) is None:
        spark.conf.set(ARROW_BYTES, BATCH)


def reach_workers(spark: SparkSession) -> None:
    """Lets Python workers that share the driver's files import this package.

    On a cluster it is installed on the workers or sent along by ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))
