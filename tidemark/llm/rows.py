"""A number for each row of a table, so that rows with equal ids or none stay apart."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.store import settled


def numbered(docs: DataFrame, row: str) -> DataFrame:
    """docs with a number of each row that is the same whenever it is read: the file's place among all paths, and the row's place in it. What isn't read from Parquet files is written once."""
    try:
        meta = docs.metadataColumn("_metadata")
        placed = docs.select("*", meta["file_path"].alias("_path"), meta["row_index"].alias("_at"))
    except AnalysisException:
        return settled(docs.withColumn(row, F.monotonically_increasing_id()))
    # a row for each file, all of which the driver has listed to read docs
    files = placed.select("_path").distinct().withColumn("_file", F.row_number().over(Window.orderBy("_path")))
    return placed.join(F.broadcast(files), "_path").select(*docs.columns, F.shiftleft(F.col("_file").cast("long"), 40).bitwiseOR(F.col("_at")).alias(row))
