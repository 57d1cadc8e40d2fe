"""Training logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

METRIC = (
    "step bigint, epoch double, loss double, grad_norm double, learning_rate double, "
    "train_runtime double, train_samples_per_second double, train_steps_per_second double, "
    "total_flos double, train_loss double"
)
_FIELDS = [f.split()[0] for f in METRIC.split(", ")]


def read_training_log(
    spark: SparkSession, path: str | list[str], lines: bool = False, run: Column | None = None
) -> DataFrame:
    """Metric rows of all runs: ``run_id``, the metrics and ``is_summary``.

    Takes an array of records, one object with a nested ``log_history``, or with
    ``lines`` one record per line, which is the form for large logs. NaN and
    Infinity are numbers. The run is the file's folder unless ``run`` is given
    or, for lines, a ``run_id`` field is there.
    """
    nested = ", ".join(f"{f.split()[0]}: {f.split()[1]}" for f in METRIC.split(", "))
    schema = f"run_id string, {METRIC}, log_history array<struct<{nested}>>"
    folder = F.regexp_extract("_metadata.file_path", r"([^/]+)/[^/]+$", 1)
    top = F.struct(*_FIELDS)
    rows = F.when(F.col("log_history").isNull(), F.array(top)).otherwise(F.col("log_history"))
    return (
        spark.read.schema(schema)
        .option("multiLine", not lines)
        .json(path)
        .select(
            (run if run is not None else F.coalesce("run_id", folder)).alias("run_id"),
            F.inline(rows),
        )
        .withColumn("is_summary", F.col("loss").isNull() & F.col("train_runtime").isNotNull())
    )
