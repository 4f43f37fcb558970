"""The folder that driver and executors share, and tables cut off there."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where none is named, a local one for a local master only, as a cluster could not read it."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
    return sc.getCheckpointDir()


def shared_folder(spark: SparkSession) -> str:
    """The path of a new folder below the shared one."""
    return f"{_root(spark)}/files-{uuid.uuid4().hex}"


def cut(rows: DataFrame) -> DataFrame:
    """The rows, written to the shared folder and read from there on."""
    _root(rows.sparkSession)
    return rows.checkpoint()
