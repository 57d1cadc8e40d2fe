"""Split datasets on shared storage, written as versions with a commit each.

A version lies in a folder of its own below ``_versions``; its commit, one small file below
``_commits``, is written last and says what the version holds. Readers follow the last
commit, so a write that breaks off leaves the dataset as it was, and readers of an older
version keep their files. A plain folder of Parquet files by split, without commits, is
read as it is.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_COMMIT = "commit bigint, folder string, schema string, n_rows bigint, measured string, measures string"


def from_rows(spark: SparkSession, rows: Sequence[str]) -> DataFrame:
    """A small list of texts as a sample table."""
    return spark.createDataFrame(list(enumerate(rows)), "sample_id bigint, text string")


def _last_commit(spark: SparkSession, path: str) -> Row | None:
    try:
        commits = spark.read.schema(_COMMIT).json(f"{path}/_commits/*")
        return commits.where("folder IS NOT NULL").orderBy(F.desc("commit")).first()
    except AnalysisException:  # nothing was committed here
        return None


def read_dataset(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """All parts of the last committed version, or only the folder of one."""
    last = _last_commit(spark, path)
    if last is None:
        df = spark.read.parquet(path)
    else:
        schema = StructType.fromJson(json.loads(last.schema))
        df = spark.read.schema(schema).parquet(f"{path}/_versions/{last.folder}")
    return df if split is None else df.where(F.col("split") == split)


def _usable(spark: SparkSession, path: str) -> bool:
    """Whether rows can be read back: all the commit tells of, by the files' footers."""
    try:
        df = read_dataset(spark, path)
        if "split" not in df.columns:
            return False
        last = _last_commit(spark, path)
        if last is None:
            df.limit(1).collect()
            return True
        return last.n_rows > 0 and df.count() == last.n_rows
    except (PySparkException, Py4JJavaError):
        return False


def write_dataset(
    df: DataFrame, path: str, overwrite: bool = False, measures: Mapping[str, Column] | None = None
) -> DataFrame:
    """Write by split as a new version, commit it and read back; reuse what is there unless told to overwrite.

    Data that cannot be read is rebuilt. ``measures`` are aggregates over the rows, taken
    while they are written and kept with the commit (:func:`read_measures`): no second
    pass. A writer that finds its version number committed by another gets an error.
    """
    spark = df.sparkSession
    if overwrite or not _usable(spark, path):
        last = _last_commit(spark, path)
        number = 0 if last is None else last.commit + 1
        folder = f"v{number}-{uuid.uuid4().hex}"
        wanted = {"n_rows": F.count(F.lit(1)), **(measures or {})}
        columns = [c.alias(name) for name, c in wanted.items()]
        types = df.agg(*columns).schema
        seen = Observation()
        df.observe(seen, *columns).write.partitionBy("split").parquet(f"{path}/_versions/{folder}")
        found = seen.get or df.limit(0).agg(*columns).first().asDict()  # an empty plan observes nothing
        values = [found[name] for name in types.names]
        commit = (number, folder, df.schema.json(), found["n_rows"], json.dumps(values, default=float), types.json())
        spark.createDataFrame([commit], _COMMIT).coalesce(1).write.json(f"{path}/_commits/{number:010d}")
    return read_dataset(spark, path)


def read_measures(spark: SparkSession, path: str) -> DataFrame:
    """One row: what was measured when the last version was written, and its ``n_rows``. Reads no data."""
    last = _last_commit(spark, path)
    if last is None:
        raise ValueError(f"no committed version in {path}")
    return spark.createDataFrame([tuple(json.loads(last.measured))], StructType.fromJson(json.loads(last.measures)))


def verify_written(spark: SparkSession, path: str) -> DataFrame:
    """One row: is there a train row to read back."""
    train = read_dataset(spark, path, "train").limit(1)
    return train.agg((F.count(F.lit(1)) > 0).alias("passed"))
