"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame


@functools.cache
def _own_folder() -> str:
    """A folder for local runs, where no shared one is named."""
    return "file://" + tempfile.mkdtemp(prefix="wattloom-")


def keep(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet under ``spark.checkpoint.dir`` and read again.

    A lost executor then costs a read, not the whole plan. The files belong to the job's
    checkpoint folder and go when the cluster clears that.
    """
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = _own_folder()
    path = f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
