"""Session defaults and the checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A session for tests and single-machine runs; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ebbtide")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new path for tables of this session, in the shared checkpoint folder."""
    ensure_checkpoint_folder(spark)
    return f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/ebbtide-{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_folder(spark: SparkSession) -> None:
    """Use the folder named in ``spark.checkpoint.dir``; make one only on a single machine."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    named = spark.conf.get("spark.checkpoint.dir", "")
    if named:
        context.setCheckpointDir(named)
        return
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="ebbtide-checkpoint-"))
