"""From pages and conversations to a capped, de-duplicated, split sample table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qaloom import fixed_values as fv
from qaloom.functions.checks import valid_sample
from qaloom.functions.text import as_column, is_qa, qa_text, whole_division, words
from qaloom.operators.ordered import SPAN, number_rows, with_neighbours
from qaloom.operators.quantiles import quantiles
from qaloom.operators.reports import attainment_status
from qaloom.operators.selection import take_first
from qaloom.session import materialise


def text_digest(col: Column | str) -> Column:
    """Stands for the text in shuffles: 32 bytes, however long the text."""
    return F.unhex(F.sha2(as_column(col), 256))


def compose_qa(conversations: DataFrame, span: int = SPAN) -> DataFrame:
    """Every user turn directly followed by an assistant turn, as one marked text.

    What follows is the next row of the conversation by ``turn``, whatever its number.
    """
    w = Window.partitionBy("conv_id", "_block").orderBy("_nth")
    numbered = number_rows(
        conversations.select("conv_id", "turn", "role", "text"), ["conv_id"], "turn", "_nth", span
    )
    return (
        with_neighbours(numbered, "_nth", ahead=1, span=span)
        .withColumn("next_role", F.lead("role").over(w))
        .withColumn("next_text", F.lead("text").over(w))
        .where(F.col("_own") & (F.col("role") == "user") & (F.col("next_role") == "assistant"))
        .select(
            "conv_id",
            "turn",
            F.col("text").alias("question"),
            F.col("next_text").alias("answer"),
            qa_text("text", "next_text").alias("text"),
        )
    )


def _place(digest: Column, order: Sequence[str], by: Sequence[str]) -> Column:
    """A row's digest, group and order as one value, for which null equals null."""
    names = [*by, *order]
    return F.struct(digest.alias("digest"), *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)))


def _first_places(
    df: DataFrame, key: Column | str, order: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """``_digest``, ``by`` and ``order`` of the first row of each distinct text: no text is moved."""
    if len(order) == 1 and order[0] not in by:
        # one column of fixed width can be kept in a hash table
        least = F.min(F.col(f"`{order[0]}`")).alias(order[0])
        return df.groupBy(*by, text_digest(key).alias("_digest")).agg(least)
    at = F.min(F.struct(*(F.col(f"`{c}`") for c in order))).alias("_at")
    firsts = df.groupBy(*by, text_digest(key).alias("_digest")).agg(at)
    return firsts.select("_digest", *by, *(F.col(f"_at.`{c}`").alias(c) for c in order if c not in by))


def _rows_at(df: DataFrame, places: DataFrame, key: Column | str, order: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """The rows of ``df`` at the given places: the only step that moves whole rows."""
    wanted = places.select(_place(F.col("_digest"), order, by).alias("_place"))
    return df.withColumn("_place", _place(text_digest(key), order, by)).join(wanted, "_place", "left_semi").drop("_place")


def dedup_first(
    df: DataFrame,
    key: Column | str,
    order: Sequence[str],
    by: Sequence[str] = (),
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Keep the first row by ``order`` of each distinct ``key`` text (inside ``by``).

    ``order`` is unique. Copies are combined before the shuffle as a digest and the
    lowest order, so a text that makes up a third of the table sends one short row per task, and
    whole rows move once, to those places. ``keep`` names the columns to carry; if they
    are order or group columns, no row is fetched at all.
    """
    places = _first_places(df, key, order, by)
    if keep is not None and set(keep) <= {*order, *by}:
        return places.select(*keep)
    kept = _rows_at(df, places, key, order, by)
    return kept if keep is None else kept.select(*keep)


def new_only(
    df: DataFrame,
    existing: DataFrame,
    key: str,
    order: Sequence[str],
    existing_key: str | None = None,
) -> DataFrame:
    """First rows of the texts that the existing table does not hold.

    Both sides are reduced to one digest per text before they meet.
    """
    known = existing.select(text_digest(existing_key or key).alias("_digest")).distinct()
    places = _first_places(df, key, order).join(known, "_digest", "left_anti")
    return _rows_at(df, places, key, order)


def fan_out(
    pages: DataFrame, max_examples: int | Column, pages_per_run: Column | str | None = None
) -> DataFrame:
    """``max(1, max_examples // pages)`` attempts per page, numbered from 1.

    ``pages_per_run`` counts the pages the cap is shared by, e.g. ``n_pages``
    of the page scan for one run per document; by default the whole table.
    """
    if pages_per_run is None:
        n_pages = pages.select(F.count(F.lit(1))).scalar()
    else:
        n_pages = as_column(pages_per_run)
    cap = F.lit(max_examples) if isinstance(max_examples, int) else max_examples
    per_page = F.greatest(F.lit(1).cast("bigint"), whole_division(cap, F.greatest(n_pages, F.lit(1))))
    return pages.withColumn("attempt", F.explode(F.sequence(F.lit(1).cast("bigint"), per_page)))


def accept(
    candidates: DataFrame,
    max_examples: int,
    order: Sequence[str],
    text: str = "response",
    by: Sequence[str] = (),
    span: int = SPAN,
) -> DataFrame:
    """First ``max_examples`` candidates that are well formed and new, in generation order.

    With ``by`` the cap and the de-duplication hold per run. Places are found and
    capped first, for any cap and however large a run; whole rows move once, to them.
    """
    formed = candidates.where(is_qa(text))
    places = materialise(_first_places(formed, text, order, by))
    if not by:
        return _rows_at(formed, take_first(places, order, max_examples), text, order)
    inside = [c for c in order if c not in by] or list(order)
    numbered = number_rows(places, by, inside, "_rank", span)
    return _rows_at(formed, numbered.where(F.col("_rank") <= max_examples).drop("_rank"), text, order, by)


def attainment(df: DataFrame, target: int) -> DataFrame:
    """How much of the target was reached."""
    n = F.col("n_samples")
    return df.agg(F.count(F.lit(1)).alias("n_samples")).select(
        "n_samples",
        F.lit(target).cast("bigint").alias("target"),
        attainment_status(n, target).alias("status"),
    )


def split_union(split: DataFrame) -> DataFrame:
    """The two parts as one table with a label; a split never overlaps itself."""
    train = split.where(F.col("split") == "train").drop("split")
    test = split.where(F.col("split") == "test").drop("split")
    return train.withColumn("split", F.lit("train")).unionByName(
        test.withColumn("split", F.lit("test"))
    )


def valid_samples(df: DataFrame, text: str = "text", min_len: int = 50) -> DataFrame:
    return df.where(valid_sample(text, min_len))


def text_features(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``length`` and ``word_count``."""
    return df.withColumn("length", F.length(text).cast("bigint")).withColumn(
        "word_count", F.size(words(text)).cast("bigint")
    )


def length_histogram(df: DataFrame, length: str = "length", by: Sequence[str] = ()) -> DataFrame:
    """One row per distinct length: what quantiles need, whatever the row count."""
    return df.groupBy(*by, length).agg(F.count(F.lit(1)).alias("n"))


def trim_quantiles(
    df: DataFrame, low: float = 0.05, high: float = 0.95, length: str = "length"
) -> DataFrame:
    """Rows whose length lies within both quantiles, ends included.

    Exact, with linear interpolation, from sketches and counts of the length alone
    (:func:`qaloom.operators.quantiles.quantiles`), so that a column of distinct doubles
    costs no more than one of few lengths. Without a length no row is kept.
    """
    bounds = quantiles(materialise(df.select(length)), length, [low, high])
    if bounds is None:
        return df.where(F.lit(False))
    return df.where((F.col(length) >= bounds[0]) & (F.col(length) <= bounds[1]))


def describe_by_split(df: DataFrame, length: str = "length", valid: str = "is_valid") -> DataFrame:
    """Per split: count, sum and mean of validity; mean, median and sample std of length."""
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(valid)).alias("n_valid"),
        (F.count_if(F.col(valid)) / F.count(F.lit(1))).alias("valid_mean"),
        F.avg(length).alias("length_mean"),
        F.percentile(length, 0.5).alias("length_median"),
        F.stddev_samp(length).alias("length_std"),
    )


def extractive_pair(page: Column | str) -> Column:
    """A generator made of expressions: first sentence asks, the rest answers."""
    c = as_column(page)
    first = F.substring_index(c, ".", 1)
    rest = F.trim(F.substring(c, F.length(first) + 2, F.length(c)))
    return F.concat(
        F.lit(fv.HUMAN + "\n"), F.trim(first), F.lit("?\n" + fv.ASSISTANT + "\n"), rest
    )
