"""Session helpers: local builder for tests and bench, shared scratch location."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession


def local_session(app: str, cores: str = "*", memory: str = "8g") -> SparkSession:
    """A port-free local session; on a cluster use the session that is given."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.timestampType", "TIMESTAMP_NTZ")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, from ``spark.checkpoint.dir``.

    In a local session, where driver and executors are one process, an unset folder is
    replaced by a temporary one. On a cluster that would scatter files over machines, so it raises.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return _local_dir()


@lru_cache(maxsize=1)
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="millwatch-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def reliable_checkpoint(df):
    """Materialise ``df`` in reliable storage so that lost executors cost no recompute."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)
