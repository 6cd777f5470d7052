"""Folders that the driver and all executors share, for checkpoints and files between steps."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """The checkpoint folder: spark.checkpoint.dir, which a cluster must name; a local session may go without."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not re.fullmatch(r"local(\[[^]]*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoint-"))
    return context.getCheckpointDir()


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in that folder."""
    return f"{folder(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    folder(df.sparkSession)
    return df.checkpoint()
