"""Session construction and the shared (cluster-visible) working folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "tidemark", extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench.

    On a cluster the session is created by the launcher; this helper only
    fixes what the library relies on: UTC (oracle comparisons), AQE with
    skew-join splitting, RocksDB state for the streaming jobs, no UI.
    """
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.streaming.stateStore.providerClass",
                 "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
         .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
         .config("spark.sql.streaming.join.stateFormatVersion", "3")   # one store for a join's two sides
         .config("spark.driver.memory", "16g"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(input_bytes: int, cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Settings sized to the data for a cluster launch (pass as ``extra``).

    Shuffle partitions start at about one per ``target_partition_bytes`` of
    input (at least 2 per core) and AQE coalesces small ones
    back; input splits are the same size, so a task reads ~256 MB and its
    shuffle output fits executor memory before spilling. Skewed partitions
    over 4x the median (and 1 GB) are split by AQE.

    Streaming queries are different: a stateful query fixes its partition
    count in its checkpoint at first start, so start those with the state
    parallelism (about the cluster's core count) instead of this batch size.
    """
    parts = max(2 * cores, -(-input_bytes // target_partition_bytes))
    size = str(target_partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1 << 30),
    }


def shared_dir(spark: SparkSession) -> str:
    """Folder visible to every executor, taken from ``spark.checkpoint.dir``.

    The cluster names this folder. Where the session has none, one is only
    made for a local master, whose executors are the driver itself (tests,
    bench); on a cluster a local folder would be the driver's alone.
    """
    path = spark.conf.get(_CKPT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not re.fullmatch(r"local(\[[^-]*\])?", spark.sparkContext.master):
            raise RuntimeError(f"set {_CKPT_KEY} to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.conf.set(_CKPT_KEY, path)
        spark.sparkContext.setCheckpointDir(path)
    return path


def run_dir(spark: SparkSession, name: str) -> str:
    """A new, never reused sub-folder of the shared folder for one job run."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/tidemark/{name}-{uuid.uuid4().hex[:12]}"
