"""Session settings the operators rely on, and the shared checkpoint location."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every airshed session should carry. Nothing here is tied to one machine: shuffle
# partition counts are left to AQE, which coalesces small partitions and splits skewed ones.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.ui.enabled": "false",
}


def cluster_conf(input_bytes: int, executor_cores_total: int, scan_split_bytes: int = 512 << 20,
                 shuffle_input_bytes_per_partition: int = 1 << 30) -> dict:
    """Sizing for a cluster run over `input_bytes` of parquet.

    Scan tasks read ~`scan_split_bytes` each. Shuffles start with one partition per
    ~`shuffle_input_bytes_per_partition` of input (at least 3x the cores); AQE then coalesces
    small post-shuffle partitions toward the advisory size and splits skewed ones.
    Example: 100 TB on 8,000 cores -> 200k scan tasks, 100k initial shuffle partitions.
    """
    parts = -(-input_bytes // shuffle_input_bytes_per_partition)
    parts = max(3 * executor_cores_total, parts)
    return {
        "spark.sql.files.maxPartitionBytes": str(scan_split_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1 << 30),
    }


def get_spark(app: str = "airshed", master: str | None = None, shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Builder with RECOMMENDED_CONF; `master`/`shuffle_partitions` only for local runs and tests."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in RECOMMENDED_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (`spark.checkpoint.dir` or the context's setting).

    Where it is unset, a session in one process (master `local`) gets a folder of its own; on a cluster
    that would be a machine-local folder, so it is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if not current:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
        if configured:
            sc.setCheckpointDir(configured)
            current = sc.getCheckpointDir() or configured
    if current:
        return current
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="airshed-ckpt-")  # one process: every task sees it
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local
