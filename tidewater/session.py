"""Session defaults and shared-storage locations.

Every persisted artefact (stream checkpoints, sink tables, lineage cuts) lives
under the folder the cluster names in ``spark.checkpoint.dir``.  Only when that
setting is absent (local tests) do we create one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a job of this package expects; the driver's own session may differ,
# so nothing here is required for correctness except the UTC zone (see below).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.streaming.noDataMicroBatches.enabled": "true",
    # lenient decode: a repeated object key keeps its last value (instead of
    # sending the whole message to the dead-letter table)
    "spark.sql.variant.allowDuplicateKeys": "true",
}


# Large-cluster profile (hundreds of executors, ~100 TB inputs).  Shuffles start
# wide and AQE coalesces them to ~256 MB partitions, so no reducer holds more
# than fits in executor memory; skewed join partitions (5x the median and
# > 512 MB) are split; scans read 256 MB splits.  Streaming jobs fix their state
# partition count at first start, so they take their own, smaller value.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.parquet.filterPushdown": "true",
}
STREAMING_STATE_PARTITIONS = "400"


def get_spark(master: str | None = None, shuffle_partitions: int | None = 8,
              app: str = "tidewater", extra: dict | None = None, profile: str = "local") -> SparkSession:
    """``profile="cluster"`` applies CLUSTER_CONF (no master: spark-submit sets it)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if profile == "cluster":
        conf.update(CLUSTER_CONF)
    elif shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared checkpoint folder.  A private one is made only for a local master (tests);
    elsewhere a missing setting is an error."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: no SparkContext, read the setting
        sc = None
    if sc is None:
        conf_dir = spark.conf.get("spark.checkpoint.dir", None)
        if not conf_dir:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        return conf_dir
    jsc = sc._jsc  # noqa: SLF001 - the getter lives on the Java context
    current = jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return jsc.sc().getCheckpointDir().get()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="tidewater-ckpt-")
    sc.setCheckpointDir(local)
    return jsc.sc().getCheckpointDir().get()


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder under the shared root for one run of one job."""
    return os.path.join(shared_root(spark), "runs", f"{label}-{uuid.uuid4().hex[:12]}")


def checkpointed(df):
    """``df`` written once below the shared root: what follows neither repeats the work nor
    loses it with an executor."""
    shared_root(df.sparkSession)
    return df.checkpoint()


def filesystem(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it knows it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001 - small driver-side steps: exists, rename, delete
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p  # noqa: SLF001
