"""Session settings the engine relies on."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import SparkSession

# Instants are compared in UTC; months are replaced one partition at a time; skewed joins are split at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where that costs one more shuffle for the aggregate that follows it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A window over (series, block) must not settle for rows that are partitioned by series alone.
    "spark.sql.requireAllClusterKeysForDistribution": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to an existing session."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int = 8, shuffle_partitions: int | None = None, shared: str | None = None) -> SparkSession:
    """A single-machine session for tests and the bench; ``shared`` names its folder for settled tables."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("hindcast")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
    )
    settings = SETTINGS | ({"spark.checkpoint.dir": shared} if shared else {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    A cluster must name one. Only a local session may leave it out; its own folder goes when the process ends.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="hindcast-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def ready_checkpoints(spark: SparkSession) -> None:
    """Point ``checkpoint()`` at the shared folder unless the context already has one."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
