"""Session construction and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC (the reference works in UTC), ANSI
# arithmetic, adaptive execution (runtime broadcast / coalesce / skew split)
# and Arrow for pandas hand-offs.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # streaming state (running counts, de-dup keys, open windows) off-heap in RocksDB
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # staged checkpoints are removed once their DataFrames are garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tidemark", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults.

    ``master`` is only applied when given: on a cluster the launcher decides.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Set the SQL options that can change at runtime on an existing session."""
    for k, v in DEFAULT_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)


def range_partitioned(df, *cols, partitions: int | None = None):
    """``df`` dealt by ranges of ``cols``. The number of pieces is ``partitions`` or the setting
    ``spark.tidemark.range.partitions`` if there is one; else adaptive execution merges the session's shuffle
    partitions up to its advisory size, so a small table is one piece (pieces keep their order).
    AQE adds none: at scale set shuffle partitions to about one per 256 MB of the largest table scanned per key."""
    n = partitions or df.sparkSession.conf.get("spark.tidemark.range.partitions", None)
    return df.repartitionByRange(int(n), *cols) if n else df.repartitionByRange(*cols)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The context's checkpoint dir; set from ``spark.checkpoint.dir`` or, only
    when the cluster names none (local runs, tests), a local temp folder."""
    sc = spark.sparkContext
    cur = sc.getCheckpointDir()
    if cur:
        return cur
    base = sc.getConf().get("spark.checkpoint.dir", None) or _local_folder(sc)
    sc.setCheckpointDir(base)
    return sc.getCheckpointDir() or base


def _local_folder(sc) -> str:
    """A folder of this machine, for a local master only."""
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="tidemark-")


def scratch_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh directory under the cluster's shared checkpoint folder.

    The folder is the session's ``spark.checkpoint.dir`` (or the context's
    checkpoint dir). Only when neither is set and the master is local a local
    directory is created and registered as the checkpoint dir; on a cluster
    that is an error. Writers create the directory.
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        base = _local_folder(sc)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
        base = sc.getCheckpointDir() or base
    sub = f"{name or 'run'}-{uuid.uuid4().hex[:10]}"
    return base.rstrip("/") + "/" + sub
