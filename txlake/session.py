"""Session settings and the shared scratch folder.

Cluster jobs never write to a machine-local temporary folder: intermediate
tables and streaming checkpoints go under the shared folder the cluster names
in ``spark.checkpoint.dir``. Only a local-mode session without that setting
(tests) gets a private folder under the system temp directory.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

#: Settings every txlake batch job wants. AQE coalesces small shuffles and
#: splits skewed sort-merge joins at run time; UTC keeps event time stable.
BATCH_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # RocksDB keeps large dedup state off the JVM heap
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state."
        "RocksDBStateStoreProvider"
    ),
}


#: Streaming-only settings. With changelog checkpointing each micro-batch
#: uploads only the state rows it changed, instead of a RocksDB snapshot of
#: the whole dedup state; snapshots are taken in the background.
STREAM_CONF = {
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # a batch without new data still runs when the watermark moved: it
    # evicts expired dedup state and emits finalized messages (Spark's
    # default, pinned because both depend on it)
    "spark.sql.streaming.noDataMicroBatches.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "txlake") -> SparkSession:
    """A local-mode session for tests and the bench (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("TXLAKE_DRIVER_MEMORY", "16g"))
    )
    for k, v in BATCH_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_batch_conf(spark: SparkSession) -> None:
    """Apply the session-level batch settings that may change at run time."""
    for k in (
        "spark.sql.adaptive.enabled",
        "spark.sql.adaptive.coalescePartitions.enabled",
        "spark.sql.adaptive.skewJoin.enabled",
        "spark.sql.session.timeZone",
    ):
        spark.conf.set(k, BATCH_CONF[k])


def shared_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from the session (``spark.checkpoint.dir``, or the SparkContext's
    checkpoint dir). Only a local-mode session may fall back to a private
    temporary folder, which is then set as the checkpoint dir.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(
            "set spark.checkpoint.dir to a folder every executor can reach"
        )
    root = tempfile.mkdtemp(prefix="txlake-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared root for one run of a job."""
    return f"{shared_root(spark)}/txlake/{name}-{uuid.uuid4().hex[:12]}"


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A session for starting streaming queries, sharing ``spark``'s context.

    A stateful query fixes its number of state partitions (the session's
    ``spark.sql.shuffle.partitions``) in its checkpoint at first start; every
    micro-batch then runs that many state tasks. This session sets it on
    purpose -- by default to the cluster's parallelism -- instead of
    inheriting whatever the batch session uses (200 by default, far too many
    for a small stream, possibly too few for a large one). It also selects
    the RocksDB state store with changelog checkpointing, and UTC. The
    caller's session is not changed.
    """
    ss = spark.newSession()
    n = state_partitions or spark.sparkContext.defaultParallelism
    ss.conf.set("spark.sql.shuffle.partitions", str(n))
    for k, v in BATCH_CONF.items():
        ss.conf.set(k, v)
    for k, v in STREAM_CONF.items():
        ss.conf.set(k, v)
    return ss
