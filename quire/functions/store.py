"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Bound of an Arrow batch, and the engine's own.
BATCH_KEY, BATCH_BYTES, BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "4m", "67108864b"


def small_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, unless the session has a limit of its own: each side of a Python task holds several copies of one."""
    if spark.conf.get(BATCH_KEY, BATCH_DEFAULT) == BATCH_DEFAULT:
        spark.conf.set(BATCH_KEY, BATCH_BYTES)


def spread(df: DataFrame, task_bytes: int) -> DataFrame:
    """Rows dealt evenly over tasks, one for so many bytes of the files and two a core at least: a file of few splits would keep few cores busy."""
    spark = df.sparkSession
    size = float(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))  # of the files, for a scan
    return df.repartition(int(min(max(2 * spark.sparkContext.defaultParallelism, size // task_bytes), 20_000)))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table under spark.checkpoint.dir and read it again. Without that setting a local session uses a temporary folder."""
    spark = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="quire-")
        spark.sparkContext.setCheckpointDir(base)
    path = f"{base.rstrip('/')}/quire/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
