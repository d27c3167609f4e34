"""Session construction and shared-storage locations.

On a cluster the session is created by the launcher; this module only
fills in settings that are missing.  Durable intermediate data (stored
tables, checkpoints) goes under ``spark.checkpoint.dir``, the shared
folder the cluster names; a private folder is created only when that
setting is unset under a ``local[...]`` master, as in tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Runtime broadcast only from measured shuffle sizes (AQE), 64 MB cap.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "termlens") -> SparkSession:
    """Return the active session, or build one for local use."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", os.environ.get("TERMLENS_DRIVER_MEMORY", "16g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a private one only if unset."""
    cur = spark.conf.get("spark.checkpoint.dir", None)
    if not cur:
        cur = spark.sparkContext.getCheckpointDir()
    if not cur:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        cur = tempfile.mkdtemp(prefix="termlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", cur)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(cur)
    return cur


def scratch_root(spark: SparkSession, name: str | None = None, keep: bool = False) -> str:
    """A fresh folder under the shared checkpoint location for written tables.

    It is removed when the driver's JVM ends, unless ``keep`` is set.
    """
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/termlens/{name or 'run'}-{uuid.uuid4().hex[:12]}"
    if not keep:
        jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fs.mkdirs(jpath)
        fs.deleteOnExit(jpath)
    return path
