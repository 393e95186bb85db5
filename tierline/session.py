"""Session helpers: defaults for a local test session and the shared scratch root."""

from __future__ import annotations

import os
import tempfile
import uuid
import warnings

from pyspark.sql import SparkSession

# Settings this library relies on.  AQE re-plans joins at runtime (broadcast when a
# side turns out small, splits skewed partitions) and coalesces small shuffle output.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tierline") -> SparkSession:
    """A local-mode session for tests and the bench (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("TIERLINE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is used as is; if it is
    unset there, this raises rather than fall back to a machine-local folder.  Only a
    local-mode session without the setting gets a private temporary folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a session without a local SparkContext (e.g. Spark Connect)
        sc = None
    if sc is not None:
        current = sc.getCheckpointDir()
        if current:
            if current.startswith("file:") and not (sc.master or "").startswith("local"):
                warnings.warn(f"spark.checkpoint.dir is {current}: that folder must be a mount that the driver and "
                              "every executor share", stacklevel=2)
            return current
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    else:
        configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = (sc.master if sc is not None else spark.conf.get("spark.master", "")) or ""
        if not master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: on a cluster it must name a folder on "
                             "shared storage (staged tables and streaming checkpoints live there)")
        configured = tempfile.mkdtemp(prefix="tierline-ckpt-")  # local mode: one machine
    if sc is None:
        spark.conf.set("spark.checkpoint.dir", configured)
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder (never machine-local
    on a cluster).  Used by sink queries that write a table and read it back."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/tierline-{label}-{uuid.uuid4().hex[:12]}"
