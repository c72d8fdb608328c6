"""Folders for what a job writes and reads again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def new_folder(spark: SparkSession) -> str:
    """A folder of its own below `spark.checkpoint.dir`, which all executors share. Where that is unset and driver and executors are one machine, as in tests, below the local temporary folder; on a cluster that is an error."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{shared or tempfile.gettempdir()}/tidecycle/{uuid.uuid4().hex}"
