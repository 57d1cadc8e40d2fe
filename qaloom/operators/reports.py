"""Quality and evaluation reports: one pass of conditional aggregates each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qaloom.functions.checks import PROFILES, Rules, any_inf, any_nan, flag_type, quality_flags
from qaloom.functions.text import answer_ok, extract_answer, is_qa, parse_qa, preview


def sample_flags(
    df: DataFrame, profile: str = "report", rules: Rules | None = None, text: str = "text"
) -> DataFrame:
    """Adds ``ok_format``, ``answer_len`` (null when badly formatted) and ``flags``."""
    return (
        df.withColumn("ok_format", is_qa(text))
        .withColumn("answer_len", F.when(is_qa(text), F.length(extract_answer(text))))
        .withColumn("flags", quality_flags(text, profile, rules or PROFILES[profile]))
    )


def _percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, 100.0 * part / whole)


def quality_report(flagged: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Total, good format, percent, mean answer length, number of flags.

    Counts the rows given, so pass the train part. An empty table has no percent.
    """
    measures = _report_measures(F.col("ok_format"), F.col("answer_len"), F.size("flags"))
    return flagged.groupBy(*by).agg(*(c.alias(name) for name, c in measures.items()))


def _report_measures(ok: Column, length: Column, n_flags: Column, of: Column | None = None) -> dict[str, Column]:
    """The report's aggregates, over all rows or those with ``of``."""
    of = F.lit(True) if of is None else of
    total, good = F.count_if(of), F.count_if(of & ok)
    return {
        "total": total,
        "good": good,
        "pct": _percent(good, total),
        "avg_len": F.coalesce(F.avg(F.when(of, length)), F.lit(0.0)),
        "n_flags": F.coalesce(F.sum(F.when(of, n_flags)), F.lit(0)),
    }


def written_measures(rules: Rules | None = None, target: int | None = None, text: str = "text") -> dict[str, Column]:
    """What a dataset's write can measure on its way: the train part's quality report, the
    sizes of both parts and, with a target, its attainment."""
    train, ok = F.col("split") == "train", is_qa(text)
    flags = F.size(quality_flags(text, "report", rules or PROFILES["report"]))
    measures = _report_measures(ok, F.when(ok, F.length(extract_answer(text))), flags, train)
    measures |= {"train_size": F.count_if(train), "test_size": F.count_if(F.col("split") == "test")}
    return measures if target is None else measures | {"status": attainment_status(F.count(F.lit(1)), target)}


def verdict(report: DataFrame) -> DataFrame:
    pct, length, flags = F.col("pct"), F.col("avg_len"), F.col("n_flags")
    return report.withColumn(
        "verdict",
        F.when((pct >= 95) & (length >= 150) & (flags == 0), "EXCELLENT")
        .when((pct >= 90) & (length >= 100) & (flags <= 5), "GOOD")
        .when(pct >= 80, "MODERATE")
        .otherwise("POOR"),
    )


def existing_report(
    df: DataFrame, rules: Rules | None = None, text: str = "text", by: Sequence[str] = ()
) -> DataFrame:
    """Check of a dataset found on disk: percent well formed and number of flags."""
    flagged = sample_flags(df, "existing", rules, text)
    return quality_report(flagged, by).drop("avg_len")


def flag_histogram(flagged: DataFrame) -> DataFrame:
    """Samples per flag type; each short length is a type of its own."""
    return (
        flagged.select(F.explode("flags").alias("flag"))
        .groupBy(flag_type("flag").alias("flag_type"))
        .agg(F.count(F.lit(1)).alias("n_samples"))
    )


def first_flags(flagged: DataFrame, order: Sequence[str], n: int = 10) -> DataFrame:
    """The first ``n`` flags in sample order, each with the count of those left out."""
    flags = flagged.select(*order, F.posexplode("flags").alias("flag_pos", "flag"))
    total = flagged.select(F.sum(F.size("flags"))).scalar()
    return (
        flags.orderBy(*order, "flag_pos")
        .limit(n)
        .withColumn("n_more", F.greatest(total - n, F.lit(0)).cast("bigint"))
    )


def first_samples(df: DataFrame, order: Sequence[str], n: int = 3, text: str = "text") -> DataFrame:
    """Previews of the first samples: question and answer, or the raw text."""
    parts = F.col("_qa")
    return (
        df.select(*order, text)
        .orderBy(*order)
        .limit(n)
        .withColumn("_qa", parse_qa(text))
        .select(
            *order,
            preview(parts["question"], 100, always=True).alias("question"),
            preview(parts["answer"], 150, always=True).alias("answer"),
            preview(parts["raw"], 200, always=True).alias("raw"),
        )
    )


def attainment_status(n: Column, target: int) -> Column:
    """How much of a target the count ``n`` reaches."""
    return F.when(n < target * 0.8, "below_target").when(n >= target, "reached").otherwise("near_target")


def split_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n_samples"))


def check_dataset(df: DataFrame) -> DataFrame:
    """One row: sizes of both parts and whether both are there."""
    train, test = (F.count_if(F.col("split") == s) for s in ("train", "test"))
    return df.agg(train.alias("train_size"), test.alias("test_size")).withColumn(
        "is_valid", (F.col("train_size") > 0) & (F.col("test_size") > 0)
    )


def evaluation_report(
    df: DataFrame, clean: str = "clean", by: Sequence[str] = ()
) -> DataFrame:
    """Success rate and mean length of cleaned answers, with verdict and length note."""
    ok = answer_ok(clean)
    rate, mean = F.col("success_pct"), F.col("avg_len")
    return (
        df.withColumn("_ok", ok)
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.count_if("_ok").alias("successes"),
            F.coalesce(F.sum(F.when(F.col("_ok"), F.length(clean))), F.lit(0)).alias("_chars"),
        )
        .withColumn("success_pct", _percent(F.col("successes"), F.col("total")))
        .withColumn("avg_len", F.col("_chars") / F.greatest(F.col("successes"), F.lit(1)))
        .withColumn(
            "verdict",
            F.when((rate >= 80) & (mean >= 100), "EXCELLENT")
            .when((rate >= 80) & (mean >= 50), "GOOD_MORE_DETAIL")
            .when(rate >= 60, "GOOD_MINOR")
            .when(rate >= 40, "FAIR")
            .otherwise("POOR"),
        )
        .withColumn(
            "length_note", F.when(mean < 50, "short").when(mean > 200, "good").otherwise("none")
        )
        .drop("_chars")
    )


def check_finite(
    df: DataFrame, vec: str, order: str, by: Sequence[str] = ()
) -> DataFrame:
    """Per group: counts, verdict and the first row with a NaN or an infinity.

    NaN is named before infinity when a row has both.
    """
    kind = F.when(any_nan(vec), "nan").when(any_inf(vec), "inf")
    first = F.min(F.when(F.col("_kind").isNotNull(), F.struct(F.col(order), F.col("_kind"))))
    return (
        df.select(*by, order, kind.alias("_kind"))
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count("_kind").alias("n_bad"),
            first.alias("_first"),
        )
        .select(
            *by,
            "n_rows",
            "n_bad",
            (F.col("n_bad") == 0).alias("is_finite"),
            F.col(f"_first.{order}").alias("first_bad"),
            F.col("_first._kind").alias("first_kind"),
        )
    )
