"""Session factory and the few settings every plan relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators assume. Timestamps in the source data are
# zone-less wall-clock values, so every date part is read in UTC.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # No broadcast from compile-time size estimates (file sizes understate
    # in-memory size, and a filtered fact can look small). Broadcasts come
    # only from explicit hints behind a bounded count (functions.joins) or
    # from AQE, which decides on sizes measured after the shuffle map stage.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    # A task of a partitioned write keeps a file open per partition value, and
    # sorts only what comes after so many values. Without this every write by
    # month sorts all its rows, whose wide rows do not fit the memory of a task.
    "spark.sql.maxConcurrentOutputFileWriters": "32",
}

# Input files' bytes for each shuffle partition at the start: about 330,000 of
# lineitem's rows, 70 MB as the rows of a sort. AQE merges small ones.
SHUFFLE_INPUT_BYTES = 4 * 1024 * 1024

CHECKPOINT_CONF = "spark.checkpoint.dir"


def get_session(master: str | None = None, app: str = "meterline",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or fetch) a session. ``master`` is only for local runs and tests;
    on a cluster leave it ``None`` so the submitter's master applies."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.ui.enabled", "false")
        builder = builder.config("spark.ui.showConsoleProgress", "false")
        builder = builder.config("spark.driver.memory",
                                 os.environ.get("METERLINE_DRIVER_MEMORY", "16g"))
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL settings on a session someone else built."""
    for key, value in SESSION_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Let the shuffles of the session start with as many partitions as the input
    needs, never fewer than ``spark.sql.shuffle.partitions``: with a fixed number
    the sorts of a partition grow with the input until they spill."""
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-input_bytes // SHUFFLE_INPUT_BYTES))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(parts))
    return parts


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``; we only pick our own
    folder when the setting is missing (local runs and tests)."""
    path = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            # a machine-local folder is not shared by a cluster's executors
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a shared folder (HDFS, object store)")
        path = tempfile.mkdtemp(prefix="meterline-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, path)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique folder under the shared checkpoint location. It is removed
    when the driver's JVM ends, so runs do not pile up scratch tables."""
    path = "/".join([checkpoint_dir(spark), "meterline", *parts, uuid.uuid4().hex])
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(at)  # only an existing path can be registered; writers then create it anew
    fs.deleteOnExit(at)
    fs.delete(at, True)
    return path


def sizing(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 * 1024 * 1024,
           expansion: float = 3.0) -> dict[str, str]:
    """Shuffle / scan sizing for a job reading ``input_bytes`` of compressed
    Parquet on ``total_cores`` executor cores.

    Shuffle partitions aim at ``target_partition_bytes`` of decompressed data
    each (``expansion`` = in-memory size / Parquet size) as if the whole
    input were shuffled, clamped to 3..50 waves of tasks: the plans here
    shuffle partial aggregates and keys, never the raw fact, and past ~50
    waves the map x reduce block count costs more than it saves. AQE then
    coalesces small partitions and splits skewed ones. Scan splits grow to
    256 MB for large inputs to keep the task count sane."""
    wanted = int(input_bytes * expansion // target_partition_bytes) + 1
    shuffle_parts = min(max(3 * total_cores, wanted), 50 * total_cores)
    split = 256 * 1024 * 1024 if input_bytes > 1 << 40 else 128 * 1024 * 1024
    return {
        "spark.sql.shuffle.partitions": str(shuffle_parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle_parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
    }


def apply_sizing(spark: SparkSession, input_bytes: int, total_cores: int | None = None) -> dict[str, str]:
    """Set ``sizing`` on a session (cores default to the default parallelism)."""
    cores = total_cores or spark.sparkContext.defaultParallelism
    conf = sizing(input_bytes, cores)
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf
