"""Where a job keeps what must outlive a stage: the folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    A local session that names none, as in tests, gets a temporary folder, removed at exit. A cluster that names none is
    an error: its executors would not see a folder of the driver's.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="checkpoints-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
    return spark.conf.get("spark.checkpoint.dir", None) or named


#: Spark's setting by which an execution removes its shuffle files when it ends, not at some later garbage collection of the driver.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is made and run in here leaves no shuffle files; the caller's setting holds again afterwards.

    For rows that are written out whole: whoever reads them reads the files, not the shuffles that led to them.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder; Spark removes it once nothing refers to it. Its shuffles go at once."""
    shared_dir(df.sparkSession)
    with shuffles_removed(df.sparkSession):
        # A frame takes the setting when it is made.
        return df.select("*").checkpoint(eager=True)
