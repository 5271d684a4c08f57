"""Session settings and the shared folder for checkpoints and scratch tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # join without sorting where the measured shuffle shows that every build partition is small
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": str(64 << 20),
    # split a skewed join input even when that costs one more exchange afterwards
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # lists of keys reach the Bloom filters of files
    "spark.sql.parquet.pushdown.inFilterThreshold": "256",
}

# of the session or of one stream: what an action has shuffled goes when it ends, not when the driver happens to collect its garbage
REMOVE_SHUFFLED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "loomvault", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only a local master may fall back to a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by the cluster")
    folder = os.path.join(tempfile.gettempdir(), "loomvault-shared")
    os.makedirs(folder, exist_ok=True)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/loomvault/{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Each action inside removes its shuffle files when it ends, so that steps of one job do not add up on disk.

    For actions that run once: one that is run again by the same frame makes them anew.
    """
    before = spark.conf.get(REMOVE_SHUFFLED, None)
    spark.conf.set(REMOVE_SHUFFLED, "true")
    try:
        yield
    finally:
        spark.conf.unset(REMOVE_SHUFFLED) if before is None else spark.conf.set(REMOVE_SHUFFLED, before)


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read again: computed once, safe from lost executors, and what they took to compute is gone from disk."""
    path = scratch_path(df.sparkSession, label)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows survive the loss of any executor."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)
