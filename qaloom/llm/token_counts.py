"""Token counts as delta-maintained rollups: signed changes, additive totals, idempotent batches."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qaloom.llm.shared import text_of

#: What each tokenizer version counts as a token.
TOKENIZERS = {
    "words-1": r"[^\x20\x09-\x0D]+",
    "words-2": r"[\p{L}\p{N}]+",
}

KEY = ["doc_id", "tokenizer", "part"]
GROUP = ["tokenizer", "source", "lang"]
ENTRY = "doc_id long, tokenizer string, part long, source string, lang string, docs long, tokens long, batch string"
TOTAL = "tokenizer string, source string, lang string, docs long, tokens long, batch string"
CHANGE = "op string, doc_id long, tokenizer string, source string, lang string, tokens long"
#: columns that a table of changes may have as well, null where it hasn't
EXTRA = "part long, docs long"


def count_tokens(text: Column, tokenizer: str) -> Column:
    """Tokens of a text under a tokenizer version; null counts as empty."""
    return F.regexp_count(text_of(text), F.lit(TOKENIZERS[tokenizer])).cast("long")


def counted(docs: DataFrame, op: str, tokenizer: str, text_col: str = "text", *more: Column) -> DataFrame:
    """Changes ``op`` (insert or revise) of all rows of ``docs``, counted under ``tokenizer``."""
    return docs.select(
        F.lit(op).alias("op"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.lit(tokenizer).alias("tokenizer"),
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
        count_tokens(F.col(text_col), tokenizer).alias("tokens"),
        *more,
    )


def counted_rows(docs: DataFrame, op: str, tokenizer: str, text: Column | None = None) -> DataFrame:
    """Changes ``op`` of all rows of ``docs``, each a document of its own, whatever ids repeat or are null.

    ``part`` is a hash of the row's text, source and language, ``docs`` the number of equal rows.
    ``text`` is what is counted in place of the row's text; the part stays the row's.
    """
    names = ("text", "source", "lang")
    part = F.xxhash64(*names, *(F.col(c).isNull() for c in names)).alias("part")
    given = docs.withColumn("_counted", F.col("text") if text is None else text)
    rows = counted(given, op, tokenizer, "_counted", part)
    return rows.groupBy(*rows.columns).agg(F.count("*").alias("docs"))


def deletions(ids: DataFrame, tokenizer: str) -> DataFrame:
    """Changes that take the rows of ``ids`` (``doc_id``) out of ``tokenizer``'s totals."""
    none = F.lit(None).cast("string")
    return ids.select(
        F.lit("delete").alias("op"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.lit(tokenizer).alias("tokenizer"),
        none.alias("source"),
        none.alias("lang"),
        F.lit(None).cast("long").alias("tokens"),
    )


class TokenLedger:
    """Totals of documents and tokens by tokenizer version, source and language, kept by batches of changes.

    A batch is a table of changes ``op`` (insert, delete, revise), ``doc_id``,
    ``tokenizer``, ``source``, ``lang``, ``tokens``. It becomes signed entries: what a document counted
    for before goes with a minus, what it counts for now with a plus. Their sums by
    group are the batch's delta, and totals are the sums of all deltas.

    Each batch has folders of its own below ``path`` (shared storage), and a commit
    written last. Readers see committed batches only; a batch that broke off is
    overwritten when it is applied again, a committed one is left alone. So applying
    a batch twice, or losing executors or the driver in between, changes nothing.

    Inserting a document that is there revises it, revising one that isn't inserts
    it, deleting one that isn't does nothing. A null ``tokens`` counts 0; null sources and
    languages are groups of their own. Of several changes of a document in one batch the one
    with the most tokens stays, a delete only if it is alone; equal rows are one. An
    empty batch is committed and changes nothing.

    Changes may have a ``part``, which tells documents with the same id or without id
    apart, and ``docs``, how many equal documents one change stands for
    (:func:`counted_rows`). A delete without a part takes out all parts of its id that
    the batch doesn't state itself. Changes with a null tokenizer, or neither id nor part, are rejected
    with an error.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _table(self, name: str, schema: str) -> DataFrame:
        folder = f"{self.path}/{name}"
        jvm = self.spark._jvm
        place = jvm.org.apache.hadoop.fs.Path(folder)
        if not place.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(place):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(folder)

    def _committed(self, name: str, schema: str) -> DataFrame:
        return self._table(name, schema).join(self._table("commits", "one int, batch string"), "batch", "left_semi")

    def has(self, batch: str) -> bool:
        """Whether a batch is committed."""
        return bool(self._table("commits", "one int, batch string").where(F.col("batch") == batch).head(1))

    def _current(self) -> DataFrame:
        rows = self._committed("entries", ENTRY).groupBy(*KEY, "source", "lang")
        return rows.agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs > 0")

    def current(self) -> DataFrame:
        """What every document counts for now: ``doc_id``, the group, ``tokens`` (of equal documents together)."""
        return self._current().drop("docs", "part")

    def totals(self) -> DataFrame:
        """``tokenizer``, ``source``, ``lang``, ``n_docs``, ``n_tokens`` of groups with documents."""
        rows = self._committed("totals", TOTAL).groupBy(*GROUP)
        sums = rows.agg(F.sum("docs").alias("n_docs"), F.sum("tokens").alias("n_tokens"))
        return sums.where("n_docs <> 0")

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """Apply a batch; false if it is committed already."""
        if self.has(batch):
            return False
        keyless = F.col("tokenizer").isNull() | (F.col("doc_id").isNull() & F.col("part").isNull())
        bad = F.when(keyless, F.raise_error(F.lit("change without a key")))
        extra = (
            (F.col(name) if name in changes.columns else F.lit(None)).cast(kind).alias(name)
            for name, kind in map(str.split, EXTRA.split(", "))
        )
        given = changes.select(*(c.split()[0] for c in CHANGE.split(", ")), *extra)
        stated = F.struct(
            (F.col("op") != "delete").alias("stays"),
            F.coalesce("tokens", F.lit(0)).alias("tokens"),
            "source",
            "lang",
            F.coalesce("docs", F.lit(1)).alias("docs"),
        )
        last = (
            given.withColumn("doc_id", F.coalesce(bad, F.col("doc_id")))
            .groupBy(*KEY)
            .agg(F.max(stated).alias("c"))
        )
        now = last.where("c.stays").select(
            *KEY, "c.source", "c.lang", "c.docs", (F.col("c.tokens") * F.col("c.docs")).alias("tokens")
        )
        same = lambda names: reduce(and_, (F.col(f"b.{k}").eqNullSafe(F.col(f"l.{k}")) for k in names))
        wide = last.where("NOT c.stays AND part IS NULL").select("doc_id", "tokenizer", F.lit(True).alias("taken"))
        hit = F.col("met") | F.col("taken")
        before = (
            self._current()
            .alias("b")
            .join(last.select(*KEY, F.lit(True).alias("met")).alias("l"), same(KEY), "left")
            .select("b.*", "met")
            .alias("b")
            .join(wide.alias("l"), same(KEY[:2]), "left")
            .select("b.*", "taken")
            .where(F.coalesce(hit, F.lit(False)))
        )
        gone = before.select(*KEY, "source", "lang", (-F.col("docs")).alias("docs"), (-F.col("tokens")).alias("tokens"))
        entries = (
            now.unionByName(gone)
            .groupBy(*KEY, "source", "lang")
            .agg(F.sum("docs").cast("long").alias("docs"), F.sum("tokens").cast("long").alias("tokens"))
            .where("docs <> 0 OR tokens <> 0")
        )
        folder = f"{self.path}/entries/batch={batch}"
        entries.write.mode("overwrite").parquet(folder)
        written = self.spark.read.schema(ENTRY.removesuffix(", batch string")).parquet(folder)
        sums = written.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        sums.write.mode("overwrite").parquet(f"{self.path}/totals/batch={batch}")
        self.spark.range(1).select(F.lit(1).alias("one")).write.mode("overwrite").parquet(f"{self.path}/commits/batch={batch}")
        return True
