"""File listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``folder, name, size`` of the files below a path; their contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select(
            F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("folder"),
            F.substring_index("path", "/", -1).alias("name"),
            F.col("length").alias("size"),
        )
    )
