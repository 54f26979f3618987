"""Session helpers.

Library functions never create a session: they take one from the caller.
``local_session`` is for tests, the bench and the driver entry only.
``scratch_path`` gives a fresh folder under the shared checkpoint directory
the cluster names in ``spark.checkpoint.dir``; only when that is unset (tests,
local runs) does it create one and register it on the session.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Settings for a large cluster (hundreds of TB of trips), to be applied by
# whoever creates the session (spark-submit --conf or builder.config); the
# library itself never changes session settings.
SCALE_CONF = {
    # Adaptive execution: coalesces small shuffle partitions, splits skewed
    # ones (aggregation shuffles, joins, and the write-side rebalance).
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Target post-shuffle partition size; also the size of written files.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    # Start wide, let AQE coalesce: ~ shuffle bytes / 256 MB at peak.
    "spark.sql.shuffle.partitions": "20000",
    # Scan split size: one task per 256 MB of Parquet.
    "spark.sql.files.maxPartitionBytes": "256m",
    # Broadcasts only below this size (hints aside, which are size-checked).
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    # Trip timestamps are wall-clock text; pin the zone.
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tripflow") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint directory. Unset, a local session gets a folder
    of its own; on a cluster it must be named, as executors would not see one
    made here."""
    sc = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_CONF, None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tripflow-ckpt-")
    # DataFrame.checkpoint() writes under the context's directory.
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder name under the checkpoint root (not created)."""
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


_scratch: dict[str, list[str]] = {}


def clean_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders this application has made so far.

    For when the results read from them have been used; returns how many
    folders were deleted.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    paths = [jvm.org.apache.hadoop.fs.Path(p) for p in _scratch.pop(spark.sparkContext.applicationId, [])]
    return sum(bool(p.getFileSystem(conf).delete(p, True)) for p in paths)
