"""The folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below spark.checkpoint.dir; where that isn't set, as in tests, below a folder of this machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="trailmark-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
