"""First n rows of a table by any columns, for any n, and exact splits.

``orderBy().limit(n)`` keeps n rows in one task, which is wrong for a fifth of a
large table. Here the key of the n-th row is found first, and rows are then kept by
comparing keys. Keys of integers are selected by radix: a histogram of the leading bits
says which bucket holds the n-th key, and the next one is of that bucket alone, so that
nothing is sorted. Keys of other types are sorted range by range, and the ranges' row
counts say where the n-th is.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qaloom.operators.ordered import place_of, row_tie
from qaloom.session import materialise

_RANGE_BITS = 33  # of monotonically_increasing_id, for the row in its partition


BUCKETS = 4_096
FEW = 10_000
_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


class Nth(NamedTuple):
    """The n-th key, the rows with smaller keys, and the rows with the same key."""

    key: tuple
    before: int
    same: int


def _by_radix(rows: DataFrame, n: int) -> Nth | None:
    """The n-th row of a table of integer columns, ordered by them from left to right, nulls first.

    At most ``BUCKETS`` bucket counts, or ``FEW`` rows of the last bucket, reach the driver at a time.
    """
    names, found = rows.columns, []
    size = rows.count()
    if not 1 <= n <= size:
        return None
    before = 0  # rows before the bucket in hand
    for name in names:
        low = high = None
        while size > FEW and (low is None or low < high):
            shift = 0
            if low is not None:
                while (high >> shift) - (low >> shift) >= BUCKETS:
                    shift += 1
                bucket = F.shiftright(name, shift)
            else:
                bucket = F.isnotnull(name).cast("long")
            parts = rows.groupBy(bucket.alias("at")).agg(F.count("*").alias("n"), F.min(name).alias("low"), F.max(name).alias("high"))
            for part in sorted(parts.collect(), key=lambda r: r["at"]):
                if before + part["n"] >= n:
                    break
                before += part["n"]
            rows = rows.where(bucket == part["at"])
            size, low, high = part["n"], part["low"], part["high"]
            if low is None:
                break
        if size <= FEW:
            break
        found.append(low)
    if size > FEW:  # all columns are alike
        return Nth(tuple(found), before, size)
    listed = sorted((tuple(r) for r in rows.collect()), key=lambda r: [(v is not None, v or 0) for v in r])
    key = listed[n - before - 1]
    return Nth(key, before + listed.index(key), listed.count(key))


def ranked_keys(df: DataFrame, order: Sequence[str], tie: Column | None = None) -> DataFrame:
    """A table ``key, id`` of ``df``'s keys, whose ids count up inside each range of keys.

    Equal keys may lie in one range only, and ranges are about equally long, so no
    key column can fill a task unless one key does.
    """
    keys = df.select(place_of(order, row_tie(df) if tie is None else tie).alias("key"))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    in_order = keys.repartitionByRange(parts, "key").sortWithinPartitions("key")
    return materialise(in_order.withColumn("id", F.monotonically_increasing_id()))


def nth_ranked(ranked: DataFrame, n: int) -> Nth | None:
    """The n-th key of :func:`ranked_keys`."""
    if n < 1:
        return None
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)  # one row per range
    part = F.shiftright("id", _RANGE_BITS).alias("part")
    ranges = ranked.groupBy(part).agg(F.count("*").alias("n")).withColumn("upto", F.sum("n").over(upto))
    hit = ranges.where(F.col("upto") >= n).orderBy("part").first()
    if hit is None:
        return None
    at = (hit["part"] << _RANGE_BITS) + n - (hit["upto"] - hit["n"]) - 1
    key = ranked.where(F.col("id") == at).first()["key"]
    bound = F.struct(*(F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(key, ranked.schema["key"].dataType.fields)))
    before, same = ranked.agg(F.count_if(F.col("key") < bound), F.count_if(F.col("key") == bound)).first()
    return Nth(tuple(key), before, same)


def nth(df: DataFrame, order: Sequence[str], n: int, tie: Column | None = None) -> Nth | None:
    """The key (order columns and tie) of the n-th row by ``order``; None if there are fewer rows."""
    tie = row_tie(df) if tie is None else tie
    if all(isinstance(df.schema[c].dataType, _INTEGERS) for c in order):
        keys = [*(F.col(f"`{c}`").alias(f"o{i}") for i, c in enumerate(order)), tie.cast("long").alias("tie")]
        return _by_radix(materialise(df.select(*keys)), n)
    return nth_ranked(ranked_keys(df, order, tie), n)


def nth_key(df: DataFrame, order: Sequence[str], n: int) -> tuple | None:
    """Order columns of the n-th row, or None if there are fewer rows."""
    found = nth(df, order, n)
    return None if found is None else found.key[:-1]


def _bound(df: DataFrame, order: Sequence[str], key: tuple) -> Column:
    kinds = [*(df.schema[c].dataType for c in order), T.LongType()]
    return F.struct(
        *(F.lit(v).cast(k).alias(f"o{i}") for i, (v, k) in enumerate(zip(key, kinds[:-1]))),
        *([F.lit(key[-1]).cast("long").alias("tie")] if len(key) > len(order) else []),
    )


def up_to(df: DataFrame, order: Sequence[str], key: tuple) -> Column:
    """Rows whose order columns are at or before ``key``; nulls come first."""
    return F.struct(*(F.col(f"`{c}`").alias(f"o{i}") for i, c in enumerate(order))) <= _bound(df, order, key)


def after(df: DataFrame, order: Sequence[str], key: tuple) -> Column:
    """Rows whose order columns come after ``key``."""
    return ~up_to(df, order, key)


def mark_first(
    df: DataFrame,
    order: Sequence[str],
    n: int,
    out: str,
    tie: Column | None = None,
) -> DataFrame:
    """Add the boolean ``out``: whether a row is among the first ``n`` by ``order``.

    The order is total for any column types: nulls come first, ties go by a hash of the
    whole row, and of equal rows any are as good. Exactly ``min(n, rows)`` rows are
    marked. ``df`` is read twice, so it must not vary. With a ``tie`` of its own rows are
    hashed only if that leaves equals on both sides of the cut.
    """
    order = list(order)
    found = nth(df, order, n, tie)
    if found is None:
        return df.withColumn(out, F.lit(n >= 1))
    key, bound = place_of(order, row_tie(df) if tie is None else tie), _bound(df, order, found.key)
    before, same = found.before, found.same
    marked = df.withColumn(out, key <= bound)
    if before + same == n:
        return marked
    if tie is not None:
        return mark_first(df, order, n, out)
    # equal rows on both sides of the cut: one of them stands for all
    copies = F.explode(F.transform(F.sequence(F.lit(1), F.lit(same)), lambda i: i <= n - before))
    one = df.where(key == bound).limit(1)
    return marked.where(key != bound).unionByName(one.withColumn(out, copies))


def take_first(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows by ``order``, in the order of :func:`mark_first`."""
    return mark_first(df, order, n, "_first").where("_first").drop("_first")


def split_hash(ids: Sequence[str], seed: int = 42) -> Column:
    """60 bits of md5 over seed and ids; the same number in any engine."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in ids]))
    return F.conv(F.left(digest, F.lit(15)), 16, 10).cast("bigint")


def split_exact(df: DataFrame, ids: Sequence[str], test_fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``split``: the ``ceil(fraction * n)`` rows with the lowest hash are the test part.

    Sizes are exact, also over repeated or null ids, and the choice depends on ids and
    seed (and the row, where ids repeat) only. Nothing is sorted where ids are integers.
    ``df`` must not vary between two runs; write it first if it may.
    """
    ids = list(ids)
    hashed = df.withColumn("_h", split_hash(ids, seed))
    same = F.lit(0).cast("long")  # ids are mostly unique, so rows need no hash
    n_test = math.ceil(test_fraction * df.count())
    marked = mark_first(hashed, ["_h", *ids], n_test, "_test", same)
    return marked.withColumn("split", F.when(F.col("_test"), "test").otherwise("train")).drop("_h", "_test")


def split_by_hash(
    df: DataFrame, ids: Sequence[str], test_fraction: float = 0.2, seed: int = 42
) -> DataFrame:
    """Add ``split`` row by row, for streams: sizes hold only on average."""
    bound = int(test_fraction * 2**60)
    return df.withColumn(
        "split", F.when(split_hash(ids, seed) < bound, "test").otherwise("train")
    )
