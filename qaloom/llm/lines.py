"""Cross-site boilerplate lines: distinct-site spread by sketches, exact near the limit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qaloom.llm.shared import text_of, whole
from qaloom.session import materialise

MIN_SITES = 8
SKETCH_BITS = 10
BAND = 1.5
LINE_END = "\n"


def line_key(line: Column) -> Column:
    """What makes two lines the same: their characters without spaces at the ends."""
    return F.unhex(F.md5(F.trim(line)))


def site_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source"
) -> DataFrame:
    """``key``, ``site``, ``id`` and the text's hash ``mark`` for every line of ``docs`` that isn't blank."""
    text = text_of(F.col(f"`{text_col}`"))
    return (
        docs.select(
            F.col(f"`{id_col}`").cast("long").alias("id"),
            F.col(f"`{site_col}`").cast("string").alias("site"),
            F.xxhash64(text).alias("mark"),
            F.explode(F.split(text, LINE_END)).alias("line"),
        )
        .where(F.trim("line") != "")
        .select(line_key(F.col("line")).alias("key"), "site", "id", "mark")
    )


def boilerplate(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    site_col: str = "source",
    min_sites: int = MIN_SITES,
) -> DataFrame:
    """Lines on ``min_sites`` or more distinct sites: ``key``, ``n_sites``, ``first_id``.

    Each line hash carries a HyperLogLog sketch of its sites, merged by the
    aggregation, so a line on a third of all rows costs one small sketch per task and
    never a list. Lines whose estimate lies within a factor ``BAND`` of the limit get
    an exact distinct count; the others are far outside the sketch's error (about
    3 %). ``n_sites`` is the exact count where there is one, else the estimate.
    """
    rows = site_lines(docs, id_col, text_col, site_col).where("site is not null")
    spread = materialise(
        rows.groupBy("key")
        .agg(
            F.count("*").alias("n"),
            F.min("id").alias("first_id"),
            F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(SKETCH_BITS))).alias("estimate"),
        )
        .where((F.col("n") >= min_sites) & (F.col("estimate") >= min_sites / BAND))
    )
    near = spread.where(F.col("estimate") < min_sites * BAND).select("key")
    exact = (
        rows.join(near, "key", "left_semi")
        .groupBy("key", "site")
        .agg(F.lit(1).alias("one"))
        .groupBy("key")
        .agg(F.count("*").alias("exact"))
    )
    return (
        spread.join(exact, "key", "left")
        .select("key", F.coalesce("exact", "estimate").alias("n_sites"), "first_id")
        .where(F.col("n_sites") >= min_sites)
    )


def drop_boilerplate(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    site_col: str = "source",
    min_sites: int = MIN_SITES,
) -> DataFrame:
    """``row`` (the row as it was), ``clean`` (its text without boilerplate) and ``n_dropped`` lines.

    A line on ``min_sites`` or more sites stays in the document with the smallest id
    (of those with a site) that holds it, so that nothing vanishes from the corpus (a group of copies keeps
    its first member whole), and goes from all others. Blank lines and line ends stay
    as they are between the lines that stay. Null text: stays null, nothing dropped.
    Rows with a null site don't count towards the spread but lose boilerplate lines
    too. A null id is never the first; if no row with the line has an id, all lose
    it. Repeated rows are treated alike. An empty table gives an empty table.

    Only hashes and ids are shuffled to find what goes; texts are moved once, with
    the list of their hashes to drop.
    """
    common = materialise(boilerplate(docs, id_col, text_col, site_col, min_sites)).select("key", "first_id")
    rows = site_lines(docs, id_col, text_col, site_col)
    drops = (
        rows.join(common, "key")
        .where(~F.col("id").eqNullSafe(F.col("first_id")) | F.col("first_id").isNull())
        .groupBy(*_owner(F.col("id")), "mark")
        .agg(F.collect_set("key").alias("drops"))
    )
    text = F.col(f"`{text_col}`")
    given = docs.select(
        whole(docs), *_owner(F.col(f"`{id_col}`").cast("long")), F.xxhash64(text_of(text)).alias("mark"), text.alias("text")
    )
    lines = F.split("text", LINE_END)
    kept = F.filter(lines, lambda x: ~F.array_contains("drops", line_key(x)))
    n = F.size(lines) - F.size(kept)
    untouched = F.col("drops").isNull() | F.col("text").isNull()
    return given.join(drops, ["owner", "no_owner", "mark"], "left").select(
        "row",
        F.when(untouched, F.col("text")).otherwise(F.array_join(kept, LINE_END)).alias("clean"),
        F.when(untouched, 0).otherwise(n).cast("long").alias("n_dropped"),
    )


def _owner(row_id: Column) -> list[Column]:
    """A row id as two columns without nulls."""
    return [F.coalesce(row_id, F.lit(0)).alias("owner"), row_id.isNull().alias("no_owner")]


def without_boilerplate(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``; other columns as they were."""
    cleaned = drop_boilerplate(docs, **settings)
    text_col = settings.get("text_col", "text")
    return cleaned.select(
        *(F.col("clean").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns)
    )
