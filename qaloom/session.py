"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: str | int = "*", app: str = "qaloom") -> SparkSession:
    """Session for tests and the bench. On a cluster the submitter's settings stand."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def work_dir(spark: SparkSession) -> str:
    """Folder shared by all executors, named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    current = spark.sparkContext.getCheckpointDir()
    if named:
        if current is None:
            spark.sparkContext.setCheckpointDir(named)
        return named.rstrip("/")
    if current is not None:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="qaloom-"))
    return spark.sparkContext.getCheckpointDir()


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below :func:`work_dir`."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a table on shared storage and go on from there.

    Needed after a function that may answer differently on each call, and
    before a table is scanned several times. Survives the loss of executors,
    and later steps read only the columns they use.
    """
    spark = df.sparkSession
    path = work_path(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
