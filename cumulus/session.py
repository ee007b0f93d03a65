"""Session construction and shared-storage helpers.

Every operator in this package is a pure function of DataFrames; the only
state a job needs is a shared folder for checkpoints and written
intermediates. On a cluster that folder is the one named by
``spark.checkpoint.dir``; we never substitute a machine-local path there.
Only when the setting is absent (local tests) do we create one.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of this package wants. Shuffle partitions are left
# to the caller (cluster size); AQE coalesces and splits at run time.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Streaming state in RocksDB: off-heap, spills to local disk, snapshots
    # to the checkpoint; large keyed state does not pressure the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(master: str | None = None, app: str = "cumulus",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:
        pass
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder, set from the session when present.

    Order: ``spark.checkpoint.dir`` conf, then the SparkContext's current
    checkpoint dir; only if both are absent (a local test session) a fresh
    folder is made and registered.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a client session without a SparkContext (Spark Connect)
        sc = None
    path = spark.conf.get("spark.checkpoint.dir", None) or (sc.getCheckpointDir() if sc else None)
    if not path:
        if not re.match(r"local(\[.*\])?$", spark.conf.get("spark.master", "local")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="cumulus-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/cumulus-work/{name}-{uuid.uuid4().hex[:12]}"


def is_local_path(path: str) -> bool:
    return "://" not in path or path.startswith("file:")


def local_fs_path(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def ensure_parent(path: str) -> None:
    if is_local_path(path):
        os.makedirs(os.path.dirname(local_fs_path(path)), exist_ok=True)
