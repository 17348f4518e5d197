"""Cutting the lineage of a result that several outputs build on, and folders for such results."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


@functools.cache
def _own_folder() -> str:
    return "file://" + tempfile.mkdtemp(prefix="wattloom-")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: the session's ``spark.checkpoint.dir``.

    Only a local run may go without, and gets a folder of its own; on a cluster every executor
    would write to its own disk, so there an unset folder is an error.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that the driver and all executors share")
    return _own_folder()


def scratch(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """A copy of ``df`` in the shared folder, safe against lost executors.

    All outputs then see the same rows. Sums of doubles may differ in the last bits from run to
    run; decimal readings do not.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)
