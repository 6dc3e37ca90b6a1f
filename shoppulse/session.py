"""Session settings the engine relies on.

Library functions never build a session; they take the caller's.  ``build_session``
is for tests, the bench and local runs.  ``configure`` applies the settings that
matter for correctness (UTC, ANSI-safe parsing is done in the expressions) and for
scale (AQE, skew joins, RocksDB state) to an existing session where they are
runtime-settable.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

# Runtime SQL settings: safe to set on any live session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    # Streaming stateful operators keep this number forever (it is frozen in
    # the checkpoint), so the default here is only for fresh local queries.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    master: str | None = None,
    app_name: str = "shoppulse",
    shuffle_partitions: int | None = None,
    checkpoint_dir: str | None = None,
    extra_conf: dict | None = None,
) -> SparkSession:
    """Local/test session.  On a cluster, use the cluster's session + ``configure``."""
    master = master or os.environ.get("SHOPPULSE_MASTER", "local[8]")
    cores = master[master.find("[") + 1 : master.find("]")] if "[" in master else "8"
    parts = shuffle_partitions or (int(cores) if cores.isdigit() else 8)
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.driver.memory", os.environ.get("SHOPPULSE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in {**RUNTIME_CONF, **(extra_conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    ensure_checkpoint_dir(spark, checkpoint_dir)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` is read from the session.  Only when it is unset
    is one chosen: ``fallback`` if given, else - in local mode only - a fresh
    folder under /tmp.  A cluster without the setting is an error: a
    machine-local folder would not survive the loss of that machine.  A folder that
    is named is taken as it is, with a scheme or without: a path of local disks may be
    a mount all machines share, and only who set it can tell.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or _context_checkpoint_dir(spark)
    if current:
        return current
    if not fallback and not is_local(spark):
        raise RuntimeError(
            "set spark.checkpoint.dir to a shared folder (stream checkpoints, "
            "ledgers and written intermediates go there)"
        )
    current = fallback or tempfile.mkdtemp(prefix="shoppulse-ckpt-")
    spark.conf.set("spark.checkpoint.dir", current)
    try:
        spark.sparkContext.setCheckpointDir(current)
    except Exception:  # no SparkContext in this client (Spark Connect)
        pass
    return current


def _context_checkpoint_dir(spark: SparkSession) -> str | None:
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # no SparkContext in this client (Spark Connect)
        return None


def _master(spark: SparkSession) -> str:
    try:
        return spark.sparkContext.master
    except Exception:
        return spark.conf.get("spark.master", "")


def is_local(spark: SparkSession) -> bool:
    """One JVM; ``local-cluster`` counts as a cluster, since its executors are processes of their own."""
    master = _master(spark)
    return master == "local" or master.startswith("local[")


def ship_package(spark: SparkSession) -> None:
    """Local mode: let Python workers import this package wherever the driver was started.

    On a cluster the package is installed or on ``PYTHONPATH`` as any library is.
    """
    if is_local(spark):
        spark.sparkContext.addFile(os.path.dirname(os.path.abspath(__file__)), recursive=True)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for stream checkpoints and ledgers (never machine-local on a cluster)."""
    current = spark.conf.get("spark.checkpoint.dir", None) or _context_checkpoint_dir(spark)
    if not current:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a shared folder is required for "
            "stream checkpoints and ledgers"
        )
    return current.rstrip("/")
