"""Session settings and reliable cuts of the lineage."""

from __future__ import annotations

import sys
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # An aggregate on the join key behind the join must not keep a hot key in one task.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Window state outgrows the heap when assets are many.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app_name: str = "tidemark", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    cleanup = {"spark.cleaner.referenceTracking.cleanCheckpoints": "true"}
    for key, value in {**SETTINGS, **cleanup, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Put the settings every operator relies on into a session made elsewhere."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


@contextmanager
def setting(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings for the jobs that run inside the block; those of before come back after it."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster; a temporary one only in local mode without the setting."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="tidemark-checkpoint-")
    context.setCheckpointDir(folder)
    return folder


def pin(df: DataFrame) -> DataFrame:
    """Compute once and keep in the shared folder, so that every later use sees the same rows."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def ship_with_jobs(module: str) -> None:
    """Send the functions of `module` with each job, so executors need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])
