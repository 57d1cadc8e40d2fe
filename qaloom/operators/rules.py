"""Rule tables, suites, manifests and versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qaloom import fixed_values as fv
from qaloom.functions.text import as_column, whole_division


def cross_suite(
    subjects: DataFrame, questions: Sequence[str] = fv.EXTENDED_QUESTIONS
) -> DataFrame:
    """Every question of a suite put to every subject row, numbered from 1.

    The suite is an argument, not a table, so no join is needed.
    """
    suite = F.array(*[F.lit(q) for q in questions])
    return subjects.select("*", F.posexplode(suite).alias("_pos", "question")).withColumn(
        "question_no", (F.col("_pos") + 1).cast("bigint")
    ).drop("_pos")


def first_questions(suite: DataFrame, order: str, n: int = 5) -> DataFrame:
    return suite.orderBy(order).limit(n)


def model_class(base_model: Column | str, other: str) -> Column:
    """``small``, ``medium`` or ``large`` by name; ``other`` for any other name."""
    name = F.lower(as_column(base_model))
    return (
        F.when(name.contains("small"), "small")
        .when(name.contains("medium"), "medium")
        .when(name.contains("large"), "large")
        .otherwise(other)
    )


def epoch_rules(spark: SparkSession) -> DataFrame:
    rows = [(*r, fv.EPOCH_OPTIONS[r[3] - 1]) for r in fv.EPOCH_RULES]
    return spark.createDataFrame(
        rows, "class string, lo bigint, hi bigint, option int, risk string, epochs int"
    )


def size_rules(spark: SparkSession) -> DataFrame:
    rows = [(*r, fv.SIZE_OPTIONS[r[1] - 1]) for r in fv.SIZE_RULES]
    return spark.createDataFrame(
        rows, "class string, option int, optimal_lo int, optimal_hi int, examples int"
    )


def presets(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(fv.PRESETS),
        "name string, base_model string, examples int, epochs int, method string, min_gpu_gb int",
    )


def available_presets(spark: SparkSession, gpu_gb: float | None) -> DataFrame:
    """Presets the hardware can run; ``None`` means no GPU."""
    need = F.col("min_gpu_gb")
    fits = F.lit(False) if gpu_gb is None else need <= gpu_gb
    return presets(spark).where(need.isNull() | fits)


_TOP = 1 << 61  # sizes and bounds lie within this, either side of zero
_LEVELS = 62


def _bins(lo: Column, hi: Column) -> Column:
    """A band as the fewest bins ``(level, bin)`` of widths that are powers of two, which cover it exactly."""
    low = F.greatest(lo.cast("bigint"), F.lit(-_TOP)) + F.lit(_TOP)
    high = F.least(F.coalesce(hi.cast("bigint"), F.lit(_TOP)), F.lit(_TOP)) + F.lit(_TOP)
    kind = "array<struct<level:int,bin:bigint>>"

    def bin_at(level: Column, at: Column) -> Column:
        return F.array(F.struct(level.cast("int").alias("level"), at.alias("bin"))).cast(kind)

    def step(state: Column, level: Column) -> Column:
        left, right, out = state["left"], state["right"], state["out"]
        odd = (left < right) & (left % 2 == 1)
        out = F.when(odd, F.concat(out, bin_at(level, left))).otherwise(out)
        left = left + odd.cast("bigint")
        odd = (left < right) & (right % 2 == 1)
        right = right - odd.cast("bigint")
        out = F.when(odd, F.concat(out, bin_at(level, right))).otherwise(out)
        return F.struct(F.shiftright(left, 1).alias("left"), F.shiftright(right, 1).alias("right"), out.alias("out"))

    start = F.struct(low.alias("left"), high.alias("right"), F.array().cast(kind).alias("out"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(_LEVELS)), start, step)["out"]


def rule_join(df: DataFrame, rules: DataFrame, size: str = "size") -> DataFrame:
    """The rules of each row's ``class`` whose size band (``lo``, ``hi``; null is open) holds the row's size.

    An interval join for rule tables of any size: a band becomes a few bins of widths that
    are powers of two, a size the bins that hold it at the widths in use (at most
    ``_LEVELS``), and both meet in an equi-join by class, width and bin, whose strategy is
    Spark's choice. The bands of a class thus spread over many keys. A row and a band meet
    once; rows without a class or size have no rule.
    """
    added = [c for c in rules.columns if c not in ("class", "lo", "hi")]
    parts = rules.select(F.col("class").alias("_class"), F.explode(_bins(F.col("lo"), F.col("hi"))).alias("_at"), *(F.col(f"`{c}`").alias(f"_r_{c}") for c in added))
    levels = [r[0] for r in parts.select("_at.level").distinct().collect()]
    place = F.floor(F.col(f"`{size}`")).cast("bigint") + F.lit(_TOP)
    held = [F.struct(F.lit(k).alias("level"), F.shiftright(place, k).alias("bin")) for k in sorted(levels)]
    spread = F.array(*held).cast("array<struct<level:int,bin:bigint>>")
    asked = df.select("*", F.explode(spread).alias("_bin"))
    met = (F.col("class") == F.col("_class")) & (F.col("_bin.level") == F.col("_at.level")) & (F.col("_bin.bin") == F.col("_at.bin"))
    joined = asked.join(parts, met)
    return joined.select(*(F.col(f"`{c}`") for c in df.columns), *(F.col(f"_r_{c}").alias(c) for c in added))


def time_estimate(
    df: DataFrame, size: str = "size", options: Sequence[int] = fv.EPOCH_OPTIONS
) -> DataFrame:
    """Training time per epoch option on GPU and CPU, as hours and minutes.

    ``cpu_epochs`` is what a full fine-tuning on CPU would run instead.
    """
    menu = F.array(*[F.lit(e) for e in options])
    devices = F.array(
        F.struct(F.lit("GPU").alias("device"), F.lit(1).alias("factor")),
        F.struct(F.lit("CPU").alias("device"), F.lit(3).alias("factor")),
    )
    total = whole_division(F.col(size), 20) * F.col("epochs") * F.col("_d.factor")
    return (
        df.select("*", F.posexplode(menu).alias("_pos", "epochs"))
        .select("*", F.explode(devices).alias("_d"))
        .withColumn("option", F.col("_pos") + 1)
        .withColumn("device", F.col("_d.device"))
        .withColumn("_total", total)
        .withColumn("hours", whole_division(F.col("_total"), 60))
        .withColumn("minutes", F.col("_total") % 60)
        .withColumn(
            "cpu_epochs", F.greatest(F.lit(4).cast("bigint"), whole_division(F.col("epochs"), 2))
        )
        .drop("_pos", "_d", "_total")
    )


def check_manifest(
    files: DataFrame,
    required: Sequence[str],
    any_of: Sequence[str],
    by: Sequence[str] = ("folder",),
) -> DataFrame:
    """Per folder: missing names, the alternative in use, file count and megabytes.

    Only names on the two lists are gathered, so a folder's state stays small
    however many files it holds.
    """
    name = F.col("name")
    wanted = F.array(*[F.lit(r) for r in required])
    options = F.array(*[F.lit(a) for a in any_of])
    rank = F.when(name.isin(*any_of), F.array_position(options, name))
    return (
        files.groupBy(*by)
        .agg(
            F.collect_set(F.when(name.isin(*required), name)).alias("_found"),
            F.min(rank).alias("_rank"),
            F.count(F.lit(1)).alias("n_files"),
            (F.sum("size") / F.lit(1024 * 1024)).alias("total_mb"),
        )
        .withColumn("missing", F.array_except(wanted, "_found"))
        .withColumn("chosen", F.when(F.col("_rank").isNotNull(), F.get(options, F.col("_rank") - 1)))
        .withColumn("is_complete", (F.size("missing") == 0) & F.col("chosen").isNotNull())
        .drop("_found", "_rank")
    )


def version_number(name: Column | str, prefix: str = "checkpoint") -> Column:
    """N of ``prefix-N``; null when the name has another form."""
    c = as_column(name)
    part = F.split_part(c, F.lit("-"), F.lit(2))
    return F.when(c.startswith(prefix + "-"), part.try_cast("bigint"))


def latest_version(
    df: DataFrame, name: str = "name", by: Sequence[str] = (), prefix: str = "checkpoint"
) -> DataFrame:
    """The name with the largest number, numerically, and how many names had one."""
    n = version_number(name, prefix)
    top = F.max(F.struct(F.col("_n"), F.col(name)))
    return (
        df.select(*by, name, n.alias("_n"))
        .where(F.col("_n").isNotNull())
        .groupBy(*by)
        .agg(top.alias("_top"), F.count(F.lit(1)).alias("n_versions"))
        .select(
            *by,
            F.col(f"_top.{name}").alias("latest"),
            F.col("_top._n").alias("version"),
            "n_versions",
        )
    )
