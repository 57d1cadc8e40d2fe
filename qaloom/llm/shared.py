"""Helpers that several operators of this package use."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH_BYTES = 16 << 20
SLICE_BYTES = 2 << 20
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def text_of(column: str | Column) -> Column:
    """A text column with null read as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def size_in_bytes(setting: str) -> int:
    """A size as Spark's settings write it: a number with an optional unit (``64m``, ``1g``, ``512kb``)."""
    number, unit = re.fullmatch(r"\s*(-?[0-9]+)\s*([bkmgtp]?)b?\s*", setting.lower()).groups()
    return int(number) << 10 * "bkmgtp".index(unit or "b")


def bound_batches(spark: SparkSession) -> None:
    """Let no Arrow batch of this session grow far past ``BATCH_BYTES``; a smaller setting stays.

    Spark reads the setting when a plan runs, so it can't be given to one plan alone.
    """
    bound = size_in_bytes(spark.conf.get(ARROW_BYTES))
    if not 0 < bound <= BATCH_BYTES:
        spark.conf.set(ARROW_BYTES, str(BATCH_BYTES))


def slices(batch: pa.RecordBatch, column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose ``column`` holds about ``size`` bytes; a longer value comes alone."""
    lengths = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
    start = held = 0
    for i, n in enumerate(lengths):
        if held and held + n > size:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def map_texts(
    df: DataFrame, column: str, schema: str | T.StructType, job: Callable[[pa.RecordBatch], pa.RecordBatch]
) -> DataFrame:
    """Apply ``job`` to runs of rows of ``df`` whose texts are bounded in bytes."""
    bound_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, column):
                yield job(part)

    return df.mapInArrow(run, schema)


def runs_of(values) -> tuple:
    """Start and end of each run of equal neighbours in an array that is not empty."""
    import numpy as np

    edges = np.flatnonzero(values[1:] != values[:-1]) + 1
    return np.concatenate(([0], edges)), np.concatenate((edges, [len(values)]))


def whole(df: DataFrame) -> Column:
    """All columns as one struct, so that helper columns can't clash with them."""
    return F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row")
