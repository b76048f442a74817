"""Session helpers: one place for the configuration every job relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a tidewater job wants on any cluster. They only touch planning
# (AQE, skew splitting, time zone), never correctness.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app_name: str = "tidewater",
                shuffle_partitions: int | None = None,
                conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    On a cluster ``master`` stays ``None`` and the cluster's own settings win;
    a checkpoint folder is only invented when none is configured (local runs).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only if it is unset.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that is used
    as is. Only a local-mode session (tests, laptops) gets a private folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a cluster job needs a shared folder")
    local = tempfile.mkdtemp(prefix="tidewater-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for derived files."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tidewater-scratch/{name}-{uuid.uuid4().hex[:12]}"


__all__ = ["get_session", "ensure_checkpoint_dir", "scratch_path", "DEFAULT_CONF"]
