"""SparkSession construction and cluster-safe scratch locations."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in this package relies on. Hour/date derivation is pinned to
# UTC through explicit function arguments as well, so the session zone is a
# default, not a hidden dependency.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # Recording the Python call site of every Column function costs several
    # driver<->JVM round trips per expression (most of plan-building time);
    # it only adds context to error messages.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(master: str | None = None, app_name: str = "phonesense",
                shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    """Return the active session, or build one with the package defaults.

    On a cluster ``master`` is left unset so spark-submit decides; tests pass
    ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir``; only when it is unset (local runs, tests) pick a
    fresh private folder under the system temp dir."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no driver-side context
        sc = None
    if current:
        if sc is not None and sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
        return current
    existing = sc.getCheckpointDir() if sc is not None else None
    if existing:
        return existing
    if sc is None or not is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: on a cluster it must name a shared "
            "folder (HDFS/S3/ABFS) that every executor can reach")
    local = tempfile.mkdtemp(prefix="phonesense-ckpt-")
    sc.setCheckpointDir(local)
    try:
        spark.conf.set("spark.checkpoint.dir", local)
    except Exception:  # a session may refuse runtime changes of core settings
        pass
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique folder beneath the shared checkpoint location for a written
    intermediate table (lineage cut that survives executor loss)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def remove_at_exit(spark: SparkSession, path: str) -> str:
    """Have the application's JVM remove a written scratch folder when it ends;
    nothing is removed while lazy results may still read it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


__all__ = ["DEFAULT_CONF", "get_session", "ensure_checkpoint_dir", "scratch_path", "remove_at_exit", "is_local"]
