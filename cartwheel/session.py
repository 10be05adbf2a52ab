"""Session construction and the shared working folder.

Everything the library writes (tables, stream checkpoints, lineage cuts)
goes under one shared folder. On a cluster that folder is the one the
deployment names in ``spark.checkpoint.dir``; we only invent one when the
setting is absent (tests, local runs).
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session defaults that every job in this library assumes.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


# Settings for a large cluster (hundreds of executors, tens of TB per job).
# Shuffle partition count is only the starting point: adaptive execution
# coalesces to ~advisoryPartitionSize per task and splits skewed partitions.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "16384",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    # broadcast only what runtime statistics show to be small
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.parquet.compression.codec": "zstd",
    # executor loss: move shuffle and cached blocks off a leaving executor,
    # and keep shuffle files servable after an executor dies
    "spark.decommission.enabled": "true",
    "spark.storage.decommission.enabled": "true",
    "spark.storage.decommission.shuffleBlocks.enabled": "true",
    "spark.shuffle.service.enabled": "true",
    "spark.task.maxFailures": "8",
    "spark.stage.maxConsecutiveAttempts": "8",
    # large streaming state lives in RocksDB, not on the JVM heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str | None = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "cartwheel", extra: dict | None = None,
                  cluster: bool = False) -> SparkSession:
    """Create (or reuse) a session with the library defaults. ``cluster=True``
    applies CLUSTER_CONF and leaves the master to the launcher."""
    b = SparkSession.builder.appName(app_name)
    if cluster:
        conf = {**DEFAULT_CONF, **CLUSTER_CONF, **(extra or {})}
    else:
        b = (b.master(master).config("spark.sql.shuffle.partitions", str(shuffle_partitions))
             .config("spark.driver.memory", "16g"))
        conf = {**DEFAULT_CONF, **(extra or {})}
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written tables.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir). A local
    session without either gets a fresh folder, removed when the process
    ends; on a cluster a folder only the driver sees would lose data, so
    there the missing setting is an error.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(d)
        return d.rstrip("/")
    d = sc.getCheckpointDir()
    if d:
        return d.rstrip("/")
    master = sc.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError(f"master {master}: set spark.checkpoint.dir to a folder that the driver and all executors share")
    d = tempfile.mkdtemp(prefix="cartwheel-", dir=os.environ.get("TMPDIR", "/tmp"))
    atexit.register(shutil.rmtree, d, ignore_errors=True)
    sc.setCheckpointDir(d)
    # The context nests the checkpoint dir in a random child folder.
    return (sc.getCheckpointDir() or d).rstrip("/")


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/cartwheel-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the session's own folder in the shared one."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def release_scratch(spark: SparkSession) -> None:
    """Delete what this session wrote under ``scratch_path``; call it when its
    results are no longer read (``stop_session`` does)."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(root, True)


def stop_session(spark: SparkSession) -> None:
    """Release the scratch tables, then stop the session."""
    release_scratch(spark)
    spark.stop()


def cut_lineage(df, name: str = "cut"):
    """Materialise ``df`` as a parquet table in the shared folder and continue
    from the written copy. Used where a result is read by several later
    passes. A written table survives executor loss and is computed exactly
    once (``checkpoint()`` would run the plan a second time to save it unless
    cached), and later scans of it get column pruning and filter pushdown."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
