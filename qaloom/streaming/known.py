"""New texts of a stream: micro-batches against the digests of all texts seen before."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from qaloom.operators.curate import dedup_first, text_digest

_SEED = -1
_BATCH = StructField("batch", LongType())


def _digest_only(name: str) -> StructType:
    return StructType([StructField(name, BinaryType())])


class NewTexts:
    """First rows of texts never seen before, kept batch by batch below ``path`` (shared storage).

    A micro-batch is reduced to its first row per text by ``order``. The digests of
    earlier batches are narrowed to those the batch asks for (a semi join: Spark
    puts a Bloom filter of the batch's digests in front of a large table of known ones),
    and what is left is taken away by an anti join. New rows and their digests are
    written under the batch's id, its commit last. A batch that is replayed after its commit
    changes nothing; one that broke off is overwritten, since later steps see only
    lower ids. Rows without a text are no texts and are left out.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, order: Sequence[str]):
        self.spark, self.path, self.key, self.order = spark, path.rstrip("/"), key, list(order)

    def _exists(self, folder: str) -> bool:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}/_SUCCESS")
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(place)

    def _write(self, df: DataFrame, name: str, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/{name}/batch={batch}")

    def _read(self, spark: SparkSession, name: str, schema: StructType) -> DataFrame:
        return spark.read.schema(StructType([*schema, _BATCH])).parquet(f"{self.path}/{name}")

    def committed(self, batch: int) -> bool:
        return self._exists(f"commits/batch={batch}")

    def _commit(self, spark: SparkSession, batch: int) -> None:
        self._write(spark.range(1).select(F.lit(1).alias("one")), "commits", batch)

    def seed(self, existing: DataFrame, key: str | None = None) -> None:
        """The texts known before the stream; once."""
        if not self.committed(_SEED):
            texts = existing.where(F.col(key or self.key).isNotNull())
            self._write(texts.select(text_digest(key or self.key).alias("digest")).distinct(), "known", _SEED)
            self._commit(existing.sparkSession, _SEED)

    def add(self, batch: DataFrame, batch_id: int) -> None:
        """Take one micro-batch in; what ``foreachBatch`` calls."""
        if self.committed(batch_id):
            return
        spark = batch.sparkSession
        firsts = dedup_first(batch.where(F.col(self.key).isNotNull()), self.key, self.order)
        self._write(firsts.withColumn("_digest", text_digest(self.key)), "asked", batch_id)
        asked = self._read(spark, "asked", StructType([*batch.schema, *_digest_only("_digest")])).where(F.col("batch") == batch_id).drop("batch")
        new = asked
        if self._exists(f"known/batch={_SEED}") or batch_id > 0:
            digests = asked.select(F.col("_digest").alias("digest"))
            known = self._read(spark, "known", _digest_only("digest")).where(F.col("batch") < batch_id)
            met = known.select("digest").join(digests, "digest", "left_semi")
            new = asked.join(met, asked["_digest"] == met["digest"], "left_anti")
        self._write(new, "rows", batch_id)
        written = self._read(spark, "rows", _digest_only("_digest")).where(F.col("batch") == batch_id)
        self._write(written.select(F.col("_digest").alias("digest")), "known", batch_id)
        self._commit(spark, batch_id)

    def run(self, stream: DataFrame) -> DataFrame:
        """Take in what the stream holds now; a later call goes on where this one stopped."""
        writer = stream.writeStream.option("checkpointLocation", f"{self.path}/checkpoint")
        writer.trigger(availableNow=True).foreachBatch(self.add).start().awaitTermination()
        return self.rows(stream)

    def rows(self, like: DataFrame) -> DataFrame:
        """New rows of all committed batches, with the columns of ``like`` and their ``batch``."""
        if not self._exists("commits/batch=0"):
            return self.spark.createDataFrame([], like.schema).withColumn("batch", F.lit(0).cast("bigint"))
        commits = self._read(self.spark, "commits", StructType()).select("batch")
        return self._read(self.spark, "rows", like.schema).join(commits, "batch", "left_semi").select(*(f"`{c}`" for c in like.columns), "batch")
