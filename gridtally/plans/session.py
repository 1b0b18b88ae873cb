"""Session settings and the shared staging folder.

Library code never picks a master; callers (spark-submit, tests, bench) do.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans at runtime: it coalesces small
# shuffle partitions, turns sort-merge joins into broadcast joins only when the
# materialised side is measured below the threshold, and splits skewed join
# partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

# For sessions that run nothing but this library's jobs. Neither rule ever
# applies to their plans, yet both trace every join key through the grid
# projection to the scan, about half of a coverage query's time on small data.
# Not a default: other joins in a session may need them.
JOB_ONLY_CONF = {
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "false",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "false",
}


def builder(app_name: str = "gridtally", shuffle_partitions: int | None = None,
            conf: dict | None = None) -> SparkSession.Builder:
    """A SparkSession builder with the job defaults; the caller adds a master."""
    b = SparkSession.builder.appName(app_name)
    # checkpoint files go when their DataFrame is no longer used
    b = b.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        b = b.config(k, v)
    return b


def sizing_conf(input_bytes: int, cores: int, shuffle_share: float = 1.0,
                target_partition_bytes: int = 256 << 20) -> dict:
    """Shuffle and scan sizes for ``input_bytes`` of raw text on ``cores`` cores.

    Scan splits are ``target_partition_bytes``, smaller where the input would
    otherwise give fewer than two splits per core. ``shuffle_share`` is the
    job's shuffled volume over its raw input: the caller's estimate, 1.0 (all
    of it) unless measured. The initial shuffle width is that volume over the
    target size, at least two waves of tasks; AQE coalesces from there, and
    splits partitions above twice the target in skewed joins. Map-output
    metadata on the driver grows with maps x reducers: beyond some 10^5
    partitions raise ``target_partition_bytes``.
    """
    split = max(1 << 20, min(target_partition_bytes, -(-input_bytes // (2 * cores))))
    width = max(2 * cores, -(-int(input_bytes * shuffle_share) // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(width),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_bytes),
    }


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set the runtime-settable defaults on an existing session."""
    for k, v in DEFAULT_CONF.items():
        spark.conf.set(k, v)
    return spark


def _check_shared(folder: str, scheme: str, master: str) -> None:
    """A local file system will do only where executors run on the driver's machine."""
    if scheme == "file" and not master.startswith("local"):
        raise ValueError(f"{folder} is a folder of the driver's machine, which the executors of "
                         f"{master} do not see; set spark.checkpoint.dir to a shared folder")


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for checkpoints and staged tables.

    It is ``spark.checkpoint.dir``, or a checkpoint folder set before; where
    neither is set, a folder in the session's warehouse. By default that is a folder
    of the driver's machine, which executors elsewhere do not see: on a cluster a
    warehouse on a local file system is refused, and ``spark.checkpoint.dir`` must be set.
    """
    sc = spark.sparkContext
    held = sc._jsc.sc().getCheckpointDir()
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d and held.isDefined():
        d = held.get()
    if not d:
        d = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_gridtally"
        path = sc._jvm.org.apache.hadoop.fs.Path(d)
        scheme = path.getFileSystem(sc._jsc.hadoopConfiguration()).getUri().getScheme()
        _check_shared(d, scheme, sc.master)
    if held.isEmpty():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder for one staged table."""
    return f"{shared_dir(spark)}/staged/{name}-{uuid.uuid4().hex[:12]}"


def drop_staged(spark: SparkSession, path: str) -> None:
    """Remove a folder that ``staging_path`` named, once nothing reads it any more."""
    if not path.startswith(f"{shared_dir(spark)}/staged/"):
        raise ValueError(f"not a staged folder: {path}")
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
