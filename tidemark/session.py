"""Session factory and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_spark(app: str = "tidemark", cpus: str | int = "*", shuffle_partitions: int | None = None,
              driver_memory: str = "4g") -> SparkSession:
    """Session with the settings the operators rely on.

    UTC keeps TIMESTAMP_NTZ <-> TIMESTAMP casts exact, AQE handles skewed joins
    and small shuffle partitions, RocksDB keeps streaming state off the heap.
    On a cluster the same settings belong in spark-defaults / spark-submit.
    """
    builder = (
        SparkSession.builder.appName(app)
        .master(os.environ.get("TIDEMARK_MASTER", f"local[{cpus}]"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .config("spark.driver.memory", driver_memory)
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for DataFrame.checkpoint().

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may
    fall back to a folder of its own, since a lost executor takes a
    machine-local folder with it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="tidemark-checkpoint-")
    sc.setCheckpointDir(configured)
    return configured
