"""Tables in and out of streams."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stream_table(
    spark: SparkSession, folder: str, files: str = "*.parquet", per_trigger: int | None = None
) -> DataFrame:
    """Parquet files of a folder as a stream, with the schema they have now."""
    schema = spark.read.option("pathGlobFilter", files).parquet(folder).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", files)
    if per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.parquet(folder)


def stream_of(spark: SparkSession, path: str, per_trigger: int | None = None) -> DataFrame:
    """The Parquet table at ``path`` as a stream, be it one file or a folder of files.

    A stream reads folders only, so a single file is that of its name in the folder around it.
    """
    *_, folder, name = path = path.rstrip("/").split("/")
    files = spark.read.parquet("/".join(path)).inputFiles()
    if len(files) == 1 and unquote(files[0]).endswith(f"{folder}/{name}"):
        return stream_table(spark, "/".join(path[:-1]), name, per_trigger)
    return stream_table(spark, "/".join(path), "*", per_trigger)


def run_to_table(df: DataFrame, path: str) -> DataFrame:
    """Run a stream over what is there now, write it as Parquet, read it back.

    The sink and the stream's own checkpoint lie below ``path``, so a restart
    goes on where it stopped and writes no row twice.
    """
    done = (
        df.writeStream.format("parquet")
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{path}/table")
    )
    done.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{path}/table")


def write_slices(df: DataFrame, key: str, order: str, path: str, slices: int = 4) -> int:
    """Write a table as files that a stream reads in ``order``; returns the files of a slice.

    The table is cut at quantiles of ``order`` into ``slices`` (a fixed number) writes, one
    after the other, so later slices have later files. In a slice a key is in one file.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = df.select(F.percentile_approx(order, [i / slices for i in range(1, slices)], 10_000)).first()[0]
    at = F.coalesce(sum((F.col(order) > F.lit(c)).cast("int") for c in cuts or []), F.lit(0)) if cuts else F.lit(0)
    for n in range(slices):
        df.where(at == n).repartition(parts, key).write.mode("append").parquet(path)
    return parts
