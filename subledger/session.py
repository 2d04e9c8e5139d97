"""Session defaults and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


#: Database of intermediate tables.
SCRATCH_DATABASE = "subledger_scratch"
# Shuffle data one task should take in.
_TASK_BYTES = 256 * 1024 * 1024


def build_session(
    app_name: str = "subledger", master: str | None = None, shuffle_bytes: int | None = None, **conf
) -> SparkSession:
    """Session with the settings the library relies on.

    ``shuffle_bytes`` is the size of the largest shuffle to expect; the number
    of shuffle partitions follows from it. Without it the cluster's setting
    stands. Adaptive execution merges partitions that turn out small and
    splits those of a join that turn out large.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Ranges and documents grow many times over after a shuffle, so small
        # shuffle partitions are worth a task of their own.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_bytes is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions(shuffle_bytes)))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_partitions(shuffle_bytes: int, least: int = 8) -> int:
    """Partitions that keep a shuffle of this size in task-sized pieces."""
    return max(least, -(-shuffle_bytes // _TASK_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    It is the one the cluster names in ``spark.checkpoint.dir``. Only a local
    session without that setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="run-")
    spark.conf.set("spark.checkpoint.dir", folder)
    context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing else writes there."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def scratch_table(spark: SparkSession, label: str) -> str:
    """A fresh name of a catalog table whose files lie below the shared folder."""
    folder = f"{shared_dir(spark).rstrip('/')}/tables"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {SCRATCH_DATABASE} LOCATION '{folder}'")
    return f"{SCRATCH_DATABASE}.{label}_{uuid.uuid4().hex}"
