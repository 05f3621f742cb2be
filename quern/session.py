"""Session settings shared by jobs, tests and the benchmark."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def build_session(app: str = "quern", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; ``conf`` overrides any default below."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Directory for reliable checkpoints, shared by every executor.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session may fall back to a
    temporary folder, because there the driver and the executors share one disk.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="quern-checkpoint-")
    context.setCheckpointDir(named)
    return named
