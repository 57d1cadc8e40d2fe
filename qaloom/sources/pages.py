"""Documents to pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaloom.functions.text import as_column, non_blank


def _pages(text: str, sep: str):
    return F.transform(
        F.split(as_column(text), sep, -1),
        lambda page, i: F.struct((i + 1).alias("page_no"), page.alias("text")),
    )


def page_scan(df: DataFrame, doc: str = "doc_id", text: str = "text", sep: str = "\n") -> DataFrame:
    """Non-blank pages with both ordinals and the document's page count.

    ``page_no`` counts all pages from 1, ``page_ix`` the kept ones from 0. The
    work stays inside a document's row: no shuffle. ``sep`` is a pattern.
    """
    return (
        df.select(doc, F.filter(_pages(text, sep), lambda p: non_blank(p["text"])).alias("_pages"))
        .select(doc, "_pages", F.size("_pages").alias("n_pages"))
        # the outer form, because the other one adds a filter that splits the text again
        .select(doc, "n_pages", F.posexplode_outer("_pages"))
        .where(F.col("pos").isNotNull())
        .select(
            doc,
            "col.page_no",
            F.col("pos").alias("page_ix"),
            "n_pages",
            "col.text",
        )
    )


def page_summary(
    df: DataFrame, doc: str = "doc_id", text: str = "text", sep: str = "\n"
) -> DataFrame:
    """Per document: pages seen, kept and blank, and characters in kept pages."""
    kept = F.filter(_pages(text, sep), lambda p: non_blank(p["text"]))
    chars = F.aggregate(kept, F.lit(0).cast("bigint"), lambda acc, p: acc + F.length(p["text"]))
    return (
        df.select(doc, F.size(_pages(text, sep)).cast("bigint").alias("pages_seen"),
                  F.size(kept).cast("bigint").alias("pages_kept"), chars.alias("chars"))
        .withColumn("pages_blank", F.col("pages_seen") - F.col("pages_kept"))
    )
