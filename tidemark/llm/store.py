"""Where the operators keep intermediate results: the folder in spark.checkpoint.dir, which every executor can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The session's shared folder. A temporary folder is set only where none is configured and the whole session runs on one machine, as in tests."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(configured)
        return configured.rstrip("/")
    found = spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="tidemark-"))
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def settled(df: DataFrame) -> DataFrame:
    """df computed once and cut from its lineage: a Parquet table in the shared folder, so that a lost executor costs only its running tasks.

    A written table has the size that it has. A checkpoint would pass on the estimate of its plan, and estimates of
    joins are products, which grow past all bounds over the rounds of an iteration.
    """
    folder = fresh_folder(df.sparkSession, "table")
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
