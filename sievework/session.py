"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# AQE splits skewed join partitions and picks the number of reducers at run time.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A join side whose shuffled size turns out to be at most this is sent to all executors.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    # A reducer's share of the smaller side up to this size is hashed, not sorted.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app_name: str = "sievework", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Let Python workers of this session import the package from where the driver has it.

    Where workers don't see that folder, install the package there or pass it with ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors see: ``spark.checkpoint.dir``.

    A temporary folder is used only where the setting is absent and the session
    is one process; it goes when that ends.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = context.getCheckpointDir()
    if not named:
        if not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="sievework-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    if not context.getCheckpointDir():
        context.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{_scratch_root(spark)}/{uuid.uuid4().hex}/{name}"


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/sievework/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete the tables this application has stored below the shared folder; its lazy results are void afterwards."""
    root = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    root.getFileSystem(spark._jsc.hadoopConfiguration()).delete(root, True)


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and keep it in the shared folder.

    For results that several later jobs read; it survives lost executors.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


# Shuffle files of a finished query go at once, not when the driver happens to collect garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, **options: str) -> DataFrame:
    """As :func:`settle`, but as a table: later plans know its size and read only the columns they need.

    The shuffles behind it are not needed again, so their files are deleted once it is written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.parquet(path)

