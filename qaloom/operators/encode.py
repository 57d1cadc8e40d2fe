"""Fixed-length integer rows from text, with a vocabulary learned from the corpus.

Rows are worked on one by one, whatever ids they bear: each gets a number of the library's
own, and its text is dealt out by that number once. Words then meet their ids in a join
for a vocabulary of any size. A small one is broadcast after a look at its size, and
the row's words are put together where they are, so no word or position is shuffled;
with a large one Spark shuffles words and splits the partitions of frequent ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qaloom import fixed_values as fv
from qaloom.functions.text import as_column, words
from qaloom.operators.ordered import number_all
from qaloom.session import materialise

PARTS = 4
_KEYS = ("input_ids", "attention_mask", "labels")


def tokens(col: Column | str, eos: str = fv.END_TOKEN, first: int | None = None) -> Column:
    """Words; the end token stands alone even where it touches a word."""
    return words(F.replace(as_column(col), F.lit(eos), F.lit(f" {eos} ")), first)


def learn_vocab(df: DataFrame, size: int | None, text: str = "text", eos: str = fv.END_TOKEN) -> DataFrame:
    """``token, n, token_id``: the most frequent words, ids from 1, ties by word; all words without ``size``.

    The end token's id stays free. Written as a table, so that it is learned once however often it is joined.
    """
    counts = (
        df.select(F.explode(tokens(text, eos)).alias("token"))
        .where(F.col("token") != eos)
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ranked = number_all(counts, [F.desc("n"), F.asc("token")], "_rank")
    if size is not None:
        ranked = ranked.where(F.col("_rank") <= size)
    free = F.col("_rank") + F.when(F.col("_rank") >= fv.END_TOKEN_ID, 1).otherwise(0)
    return materialise(ranked.withColumn("token_id", free).drop("_rank"))


def _padded(ids: Column, max_length: int, pad_id: int, multiple: int = 1) -> list[Column]:
    width = -(-max_length // multiple) * multiple
    kept = F.slice(ids, 1, max_length)
    fill = F.lit(width) - F.size(kept)
    row = F.concat(kept, F.array_repeat(F.lit(pad_id), fill))
    seen = F.concat(
        F.array_repeat(F.lit(1), F.size(kept)), F.array_repeat(F.lit(0), fill)
    )
    return [row.alias("input_ids"), seen.alias("attention_mask"), row.alias("labels")]


def _dealt(df: DataFrame, keep: Sequence[str], payload: Column) -> DataFrame:
    """``_keep`` (the columns ``keep`` as one value) and ``_given`` of every row, dealt out by ``_row``.

    A task sorts its places, over ten times its texts' size, in memory, so partitions are a ``PARTS``-th of a shuffle's, and
    given by number, which Spark doesn't put together again.
    """
    parts = PARTS * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kept = F.struct(F.lit(True).alias("_"), *(F.col(f"`{c}`") for c in keep)).alias("_keep")
    return df.select(kept, payload.alias("_given")).withColumn("_row", F.monotonically_increasing_id()).repartition(parts, "_row")


def _places(dealt: DataFrame, values: Column, out: str) -> DataFrame:
    """One row per value of each row: ``_row``, ``pos`` and ``out``; the first one alone carries ``_keep``."""
    places = dealt.select("_row", "_keep", F.posexplode_outer(values).alias("pos", out))
    return places.withColumn("_keep", F.when(F.coalesce("pos", F.lit(0)) == 0, F.col("_keep")))


def _together(places: DataFrame, value: Column, keep: Sequence[str], out: str) -> DataFrame:
    """The values of a row's places, in order, as the array ``out``; a row without places has an empty one."""
    entry = F.when(F.col("pos").isNotNull(), F.struct("pos", value.alias("v")))
    rows = places.groupBy("_row").agg(F.first("_keep", ignorenulls=True).alias("_keep"), F.array_sort(F.collect_list(entry)).alias("_entries"))
    return rows.select(*(F.col(f"_keep.`{c}`").alias(c) for c in keep), F.col("_entries.v").alias(out))


def token_ids(
    df: DataFrame,
    vocab: DataFrame,
    ids: Sequence[str],
    text: str = "text",
    max_length: int | None = None,
    eos: str = fv.END_TOKEN,
    eos_id: int = fv.END_TOKEN_ID,
    unknown_id: int = fv.UNKNOWN_ID,
) -> DataFrame:
    """``ids`` and ``token_ids`` of every row: the ids of its words, of the first ``max_length`` if given.

    ``ids`` are any columns to keep; they may repeat or be null.
    """
    dealt = _dealt(df, ids, F.col(f"`{text}`"))
    places = _places(dealt, tokens("_given", eos, max_length), "token")
    token_id = F.when(F.col("token") == eos, eos_id).otherwise(
        F.coalesce(F.col("token_id").cast("int"), F.lit(unknown_id))
    )
    return _together(places.join(vocab.select("token", "token_id"), "token", "left"), token_id, ids, "token_ids")


def encode(
    df: DataFrame,
    vocab: DataFrame,
    max_length: int,
    ids: Sequence[str] | None = None,
    text: str = "text",
    eos: str = fv.END_TOKEN,
    eos_id: int = fv.END_TOKEN_ID,
    unknown_id: int = fv.UNKNOWN_ID,
    multiple: int = 8,
) -> DataFrame:
    """``ids``, ``input_ids``, ``attention_mask`` and ``labels`` of every row.

    ``ids`` are the columns to keep, by default all but the text.
    """
    ids = [c for c in df.columns if c != text] if ids is None else list(ids)
    encoded = token_ids(df, vocab, ids, text, max_length, eos, eos_id, unknown_id)
    return encoded.select(*(F.col(f"`{c}`") for c in ids), *_padded(F.col("token_ids"), max_length, eos_id, multiple))


def decode(
    df: DataFrame,
    vocab: DataFrame,
    ids: Sequence[str] = ("doc_id",),
    encoded: str = "input_ids",
    unknown: str = "<unk>",
    eos_id: int = fv.END_TOKEN_ID,
) -> DataFrame:
    """``ids`` and ``decoded`` of every row: words joined by spaces, special ids skipped."""
    dealt = _dealt(df, ids, F.filter(F.col(f"`{encoded}`"), lambda i: i != eos_id))
    places = _places(dealt, F.col("_given"), "token_id")
    word = F.coalesce("token", F.lit(unknown))
    back = _together(places.join(vocab.select("token_id", "token"), "token_id", "left"), word, ids, "_words")
    return back.select(*(F.col(f"`{c}`") for c in ids), F.array_join("_words", " ").alias("decoded"))


def encode_by_join(df: DataFrame, vocab: DataFrame, max_length: int, ids: Sequence[str], **settings) -> DataFrame:
    """:func:`encode`, which joins for any vocabulary."""
    return encode(df, vocab, max_length, ids, **settings)


def check_round_trip(
    df: DataFrame,
    vocab: DataFrame,
    ids: Sequence[str] = (),
    text: str = "text",
    eos: str = fv.END_TOKEN,
) -> DataFrame:
    """One row: vocabulary size, rows, and rows all of whose words come back from their ids.

    Every row counts, whatever its ``ids``, which aren't read any more; a null text doesn't come back. A word's id and
    an id's word depend on nothing else in the row, so each distinct word is encoded and decoded once, and a row is
    exact if it has none of the words that come back as another.
    """
    asked = F.array_distinct(F.filter(tokens(F.col(f"`{text}`"), eos), lambda w: w != eos))
    rows = df.select(F.monotonically_increasing_id().alias("_row"), asked.alias("_words"))
    words = rows.select("_row", F.explode("_words").alias("word"))
    ids = token_ids(words.select("word").distinct(), vocab, ["word"], "word", None, eos)
    lost = materialise(decode(ids, vocab, ["word"], "token_ids").where(F.col("decoded") != F.col("word")).select("word"))
    inexact = words.join(lost, "word", "left_semi").select("_row").distinct()
    return (
        df.agg(F.count(F.lit(1)).alias("n_rows"), F.count(F.col(f"`{text}`")).alias("n_exact"))
        .withColumn("n_exact", F.col("n_exact") - inexact.agg(F.count(F.lit(1))).scalar())
        .withColumn("vocab_size", vocab.agg(F.count(F.lit(1))).scalar())
    )


def check_encoded(df: DataFrame, batch: int = 2) -> DataFrame:
    """One row: row count, key list, the length all rows share, a batch's shape."""
    n, m, k = (F.size(c) for c in ("input_ids", "attention_mask", "labels"))
    low = F.least(F.min(n), F.min(m), F.min(k))
    high = F.greatest(F.max(n), F.max(m), F.max(k))
    return df.agg(
        F.lit(",".join(c for c in df.columns if c in _KEYS)).alias("keys"),
        F.count(F.lit(1)).alias("n_rows"),
        low.cast("bigint").alias("min_length"),
        high.cast("bigint").alias("max_length"),
        (low == high).alias("is_uniform"),
        F.coalesce(F.bool_and(F.col("input_ids") == F.col("labels")), F.lit(True)).alias(
            "labels_match"
        ),
        F.concat_ws("x", F.least(F.count(F.lit(1)), F.lit(batch)), high).alias("batch_shape"),
    )
