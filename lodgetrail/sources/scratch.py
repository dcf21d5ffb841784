"""A folder every executor can reach, for tables written between two steps."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only where none is set and all runs in one process, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all machines share; master is {master}")
        folder = f"file://{tempfile.gettempdir()}/lodgetrail"
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has been written to."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
