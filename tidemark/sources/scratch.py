"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def fresh_folder(spark: SparkSession, name: str = "stream") -> str:
    """A new path under spark.checkpoint.dir; under a temporary folder only where that is unset and the whole session runs on one machine, as in tests."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        shared = tempfile.mkdtemp(prefix="tidemark-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """df computed once, as a Parquet table in the shared folder: what follows reads it, and a lost executor costs its running tasks only."""
    folder = fresh_folder(df.sparkSession, "table")
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
