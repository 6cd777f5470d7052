"""Session helpers of this subpackage."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid

from pyspark.sql import DataFrame
from pyspark.sql.functions import broadcast


#: Held while a checkpoint is written. Its shuffle files go once it is there, as nothing reads them any more; left to the
#: garbage collector they would all stay to the end. Arrow batches are bounded by bytes, as rows may hold whole texts.
WHILE_WRITTEN = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}


@contextlib.contextmanager
def settings(spark, held: dict[str, str]):
    before = {name: spark.conf.get(name, None) for name in held}
    try:
        for name, value in held.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def checkpointed(df: DataFrame) -> DataFrame:
    """df cut from its lineage by files in spark.checkpoint.dir. Where that is unset, a folder of this machine stands in
    if the session is local; on a cluster the setting is required."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.fullmatch(r"local(\[[^]]*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint-"))
    with settings(df.sparkSession, WHILE_WRITTEN):
        return df.select("*").checkpoint()  # a plan of its own: the settings are read where a plan begins


def dropped(*frames: DataFrame) -> None:
    """The files of checkpointed tables that nothing reads any more are deleted."""
    for df in frames:
        file = df._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
        if file.isDefined():
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(file.get())
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def small_or_shuffled(df: DataFrame, most: int = 400_000) -> DataFrame:
    """A table of keys for a join: checkpointed, and broadcast only if it has at most ``most`` rows."""
    return few_or_shuffled(checkpointed(df), most)


def few_or_shuffled(df: DataFrame, most: int = 400_000) -> DataFrame:
    """The same for a table that is cut from its lineage already."""
    return broadcast(df) if df.count() <= most else df


def staged(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet in the checkpoint folder and read again."""
    checkpointed(df.sparkSession.range(0))  # sets the folder where it is unset
    path = f"{df.sparkSession.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
