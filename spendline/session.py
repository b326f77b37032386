"""Session factory and the shared folder used for cut lineage and staged tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "spendline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on (UTC, AQE with skew handling).

    Shuffle width and memory belong to the cluster and are left alone unless given.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: `spark.checkpoint.dir`, as the cluster names it.

    Only where neither the setting nor a checkpoint folder exists is a temporary one chosen, and only
    with a local master; on a cluster, executors would not see each other's files there.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir", None)
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spendline-"))
    return os.path.dirname(context.getCheckpointDir())


def stage_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one for a table that a job writes and reads again."""
    return f"{shared_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}-{name}-{uuid.uuid4().hex}"


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def shuffles_dropped(spark: SparkSession) -> AbstractContextManager[None]:
    """Shuffle files of the writes inside are deleted as each of them ends, not when the driver's collector next runs.

    For writes that are read back from their files: their plans are not run again, so nothing needs these shuffles.
    """
    return _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def small_sides_hashed(spark: SparkSession) -> AbstractContextManager[None]:
    """Joins of a large with a small side that is yet too large to broadcast hash the small one instead of sorting both (and spilling the large one).

    Adaptive execution does so where every partition of a side is below the limit as shuffled.
    """
    return _setting(spark, "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64m")


def reliable(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared checkpoint folder, so lost executors do not matter."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
