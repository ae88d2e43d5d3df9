"""Session construction and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "loadlens", extra: dict | None = None) -> SparkSession:
    """A session with AQE (coalescing, skew-join splitting, runtime-checked broadcast) and UTC time.

    On a cluster pass ``master=None`` and let the launcher decide; size
    ``spark.sql.shuffle.partitions`` to the data (AQE coalesces small ones).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # broadcast only what AQE has measured at runtime, never on file-size estimates
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def single_machine(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for checkpoints and written intermediates.

    Read from ``spark.checkpoint.dir``; only when it is unset on a single-machine
    master (tests) a folder under the system temp directory is set for this session.
    On a cluster an unset folder is an error: no machine-local folder will do.
    """
    d = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not single_machine(spark.sparkContext.master):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        import tempfile

        d = os.path.join(tempfile.gettempdir(), f"loadlens-ckpt-{uuid.uuid4().hex[:8]}")
        spark.conf.set(CHECKPOINT_CONF, d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder (never a machine-local temp dir)."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def cluster_conf(input_bytes: int, cores: int, target_partition_bytes: int = 256 << 20,
                 max_shuffle_partitions: int = 60_000) -> dict[str, str]:
    """Settings sized for a large run (pass to ``get_spark(extra=...)`` or spark-submit).

    * Scan splits of ``target_partition_bytes`` (``files.maxPartitionBytes``),
      so one task reads a bounded slice of a file whatever the file size.
    * Initial shuffle partitions from the input size (at least 2 per core,
      at most ``max_shuffle_partitions`` so map-output tracking stays cheap);
      AQE then coalesces toward ``target_partition_bytes`` per reducer.
    * Skew join: a reducer partition over 4x the target and 5x the median is
      split and the other side replicated (hot houses on shuffled joins).
    * Broadcast only under a runtime-measured 64 MB (AQE checks the actual size
      of the built side before it broadcasts).
    """
    shuffle = max(2 * cores, min(max_shuffle_partitions, input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
