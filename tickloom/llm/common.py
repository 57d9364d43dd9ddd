"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import tempfile
from collections.abc import Callable, Iterator
from functools import wraps

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Rows and bytes of an Arrow batch of texts.
BATCH_ROWS, BATCH_BYTES = 2000, "8m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table as a DataFrame; only Spark's readers touch the path."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """This application's folder under ``spark.checkpoint.dir``, which all executors share.

    A temporary one is set only where none is configured and all runs on one machine, as in
    tests; on a cluster the setting is needed, for executors do not see the driver's disk.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="tickloom-checkpoints-"))
    return context.getCheckpointDir()


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and cut its lineage."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def partitions(df: DataFrame) -> int:
    """Shuffle partitions configured for the session that owns ``df``."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def small_batches(spark: SparkSession) -> None:
    """Let texts travel to Python in small batches, so that a worker's memory stays small; for the session."""
    rows = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    if rows <= 0 or rows > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


Batches = Iterator[pd.DataFrame]


def lean(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``run``, and afterwards what it freed goes back to the system: Python workers outlive their tasks."""

    @wraps(run)
    def wrapped(batches: Batches) -> Batches:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):  # another C library
            pass

    return wrapped


def settle(spark: SparkSession) -> None:
    """Between stages of one application: what the driver's Python and JVM no longer need goes back to the system."""
    gc.collect()  # frames that are gone here let go of their plans there
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass
    spark.sparkContext._jvm.System.gc()


class Memo(dict):
    """A dict that fills itself from ``make``; when full, it keeps one older generation to look in."""

    def __init__(self, make, entries: int) -> None:
        super().__init__()
        self.make, self.entries, self.older = make, entries, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.entries:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value

    def forget(self) -> None:
        """Give the memory back, at the end of a task whose worker lives on."""
        self.clear()
        self.older = {}
