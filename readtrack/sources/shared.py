"""Folders that the driver and all executors see."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder that didn't exist, under spark.checkpoint.dir; where that is unset and all is one machine (tests), under a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="readtrack-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """A table written once and read back, for what several steps read."""
    folder = new_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
