"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app_name: str = "fleetlake", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the library relies on; `conf` overrides or adds.

    Timestamps are zone-less in batch, so the session zone is pinned to UTC: casts between the
    zone-less and the zoned type are then the identity. AQE coalesces small shuffle partitions
    and splits skewed join partitions, so the partition count only needs an upper bound.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update({key.replace("__", "."): str(value) for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str = "work") -> str:
    """A new folder name below `spark.checkpoint.dir`, the folder every executor can reach.

    A machine-local temporary folder is used only where that setting is absent and the whole
    session runs in one machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        root = os.path.join(tempfile.gettempdir(), "fleetlake")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give the context a checkpoint folder if it has none (iterative training cuts lineage there)."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(scratch_dir(spark, "checkpoint"))
