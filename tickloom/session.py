"""Session settings that the engine's results rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "tickloom", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session in UTC with adaptive execution; everything else is the cluster's own choice."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """This application's folder under ``spark.checkpoint.dir``, which all executors share.

    A temporary one is set only where none is configured and all runs on one machine.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="tickloom-checkpoints-"))
    return context.getCheckpointDir()


def materialise(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder, so that what several stages read is made once."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
