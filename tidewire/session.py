"""Session settings the operators are tuned for, and the shared folder for written state."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime (per-session) settings; safe to apply to a session somebody else built.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # a hot join key is split at run time ...
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # ... also when the join's partitioning would otherwise have been reused downstream
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # the last of repeated JSON keys counts
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "tidewire", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="tidewire-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_run_folder(spark: SparkSession, label: str) -> str:
    """A fresh, not yet existing folder below the shared one."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
