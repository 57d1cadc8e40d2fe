"""Ordered work inside a key, for keys of any size.

A window partitioned by the key alone would put a key with a third of all rows
into one task. Here a large key is cut into blocks of about equally many rows, and
what crosses a block's edge travels as one summary row per block. Keys are compared
as structs, for which null equals null, so no row is lost.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qaloom.functions.text import as_column, whole_division
from qaloom.session import materialise

SPAN = 100_000
CUTS = 1_000


def block_of(position: Column | str, span: int = SPAN) -> Column:
    return whole_division(as_column(position), span)


def key_of(keys: Sequence[str]) -> Column:
    return F.struct(*(F.col(f"`{c}`") for c in keys))


def row_tie(df: DataFrame) -> Column:
    """Orders rows whose order columns are equal: a hash of the whole row (maps aside)."""
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    return F.xxhash64(*(F.col(f"`{c}`") for c in plain))


def place_of(order: Sequence[str], tie: Column) -> Column:
    """The whole order as one value; structs compare field by field, nulls first."""
    return F.struct(*(F.col(f"`{c}`").alias(f"o{i}") for i, c in enumerate(order)), tie.alias("tie"))


def _cuts(rows: DataFrame, place: Column, span: int) -> DataFrame | None:
    """``_key`` and ``_cuts``, the places where blocks of large keys start; None if no key is large.

    The places of large keys alone are sorted, range by range, and counted, and every
    ``span``-th place of a key starts a block. So blocks are cut by row count, and only
    a place that many equal rows share can't be cut.
    """
    counts = rows.groupBy("_key").agg(F.count("*").alias("_n"))
    most = counts.agg(F.max("_n")).first()[0]
    if most is None or most <= span:
        return None
    large = materialise(counts.where(F.col("_n") > span))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    places = rows.select("_key", place.alias("_place")).join(large, "_key")
    in_order = places.repartitionByRange(parts, "_key", "_place").sortWithinPartitions("_key", "_place")
    sorted_ = materialise(in_order.withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", 33).alias("_part")
    before = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per key and range; ids count up inside a range
    runs = sorted_.groupBy("_key", part).agg(F.min("_id").alias("_from"), F.count("*").alias("_rows"))
    shifts = runs.select("_key", "_part", (F.col("_from") - F.coalesce(F.sum("_rows").over(before), F.lit(0))).alias("_shift"))
    step = F.greatest(F.lit(span), F.ceil(F.col("_n") / CUTS))
    starts = sorted_.withColumn("_part", part).join(shifts, ["_key", "_part"])
    starts = starts.where(F.pmod(F.col("_id") - F.col("_shift"), step) == 0)
    return materialise(starts.groupBy("_key").agg(F.array_sort(F.collect_set("_place")).alias("_cuts")))


def _assigned(rows: DataFrame, place: Column, cuts: DataFrame) -> DataFrame:
    """``rows`` with ``_block``, the number of cuts of its key at or before its place."""
    at = F.size(F.filter("_cuts", lambda cut: cut <= F.col("_place")))
    joined = rows.withColumn("_place", place).join(cuts, "_key", "left")
    return joined.withColumn("_block", F.when(F.col("_cuts").isNull(), 0).otherwise(at)).drop("_cuts", "_place")


def with_blocks(
    df: DataFrame, keys: Sequence[str], order: str | Sequence[str], span: int = SPAN, tie: Column | None = None
) -> DataFrame:
    """Add ``_key`` and ``_block``: a key of over ``span`` rows is cut into blocks by ``order`` and ``tie``.

    A block holds at most ``span`` rows, or a ``CUTS``-th of the key if that is more, and
    blocks count up with the order. Order columns have any type that can be sorted, null
    ones come first. Rows with equal order values are told apart by ``tie``, by default a
    hash of the row, so that ties and nulls split as well; only rows that are equal
    altogether share a block. ``df`` is read again for large keys, so it must not vary.
    """
    order = [order] if isinstance(order, str) else list(order)
    rows = df.withColumn("_key", key_of(keys))
    place = place_of(order, row_tie(df) if tie is None else tie)
    cuts = _cuts(rows, place, span)
    if cuts is None:
        return rows.withColumn("_block", F.lit(0))
    return _assigned(rows, place, cuts)


def number_rows(
    df: DataFrame, keys: Sequence[str], order: str | Sequence[str], out: str, span: int = SPAN
) -> DataFrame:
    """Add ``out``: position of the row in its key by ``order``, from 1.

    Null keys are keys, a null order value comes first, and ties go by a hash of the
    row. One row shuffle, by (key, block); the counts of earlier blocks come from a
    table with one row per block, and are not looked for where no key is large.
    """
    order = [order] if isinstance(order, str) else list(order)
    tie = row_tie(df)
    by_place = [*(F.col(f"`{c}`") for c in order), tie]
    rows = df.withColumn("_key", key_of(keys))
    cuts = _cuts(rows, place_of(order, tie), span)
    if cuts is None:
        in_key = Window.partitionBy("_key").orderBy(*by_place)
        return rows.withColumn(out, F.row_number().over(in_key).cast("long")).drop("_key")
    blocked = _assigned(rows, place_of(order, tie), cuts)
    before = Window.partitionBy("_key").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        blocked.groupBy("_key", "_block")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_key", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    return (
        blocked.withColumn("_rank", F.row_number().over(Window.partitionBy("_key", "_block").orderBy(*by_place)))
        .join(offsets, ["_key", "_block"])
        .withColumn(out, F.col("_before") + F.col("_rank"))
        .drop("_key", "_block", "_rank", "_before")
    )


def number_all(df: DataFrame, order: Sequence[Column], out: str) -> DataFrame:
    """``df`` with ``out``: the row's place in the whole table by ``order``, from 1, written as a table.

    Rows are sorted range by range, and a range starts after the row counts of the
    ranges before it, of which there are as many as shuffle partitions.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    in_order = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = materialise(in_order.withColumn("_id", F.monotonically_increasing_id()))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    part = F.shiftright("_id", 33).alias("_part")
    ranges = placed.groupBy(part).agg(F.count("*").alias("_n"))
    starts = ranges.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(out, F.col("_before") + F.col("_id") - F.shiftleft("_part", 33) + 1)
        .drop("_id", "_part", "_before")
    )


def with_neighbours(
    df: DataFrame, position: str, back: int = 0, ahead: int = 0, span: int = SPAN
) -> DataFrame:
    """Copy the rows near a block's edge into the next block.

    ``position`` must be consecutive in its key (see :func:`number_rows`). A
    window over (key, ``_block``) then sees ``back`` rows before and ``ahead``
    rows after each row of its own block; keep the rows with ``_own``.
    """
    if max(back, ahead) > span:
        raise ValueError("a frame must fit into one block")
    p = F.col(position)
    blocks = [F.struct(block_of(p, span).alias("block"), F.lit(True).alias("own"))]
    for reach in (r for r in (back, -ahead) if r):
        other = block_of(p + reach, span)
        copy = F.struct(other.alias("block"), F.lit(False).alias("own"))
        blocks.append(F.when(other != block_of(p, span), copy))
    return (
        df.withColumn("_at", F.explode(F.array_compact(F.array(*blocks))))
        .withColumn("_block", F.col("_at.block"))
        .withColumn("_own", F.col("_at.own"))
        .drop("_at")
    )
