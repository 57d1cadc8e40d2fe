"""Exact quantiles by mergeable sketches: no sort and no table of distinct values."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

K = 4096
# ranks to either side of the wanted one, several times the usual error of a sketch of size K
SLACK = 0.005
OTHER_ROWS = "the sketches given are not those of the table's rows"
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


@dataclass
class _Search:
    """A rank, and the open interval known to hold it: ``before`` values lie at or below ``low``."""

    rank: int
    inside: int
    sketch: bytes | None = None
    before: int = 0
    low: float | None = None
    high: float | None = None
    answer: float | None = None

    def holds(self, v: Column) -> Column:
        held = F.lit(True)
        if self.low is not None:
            held = held & (v > F.lit(self.low))
        if self.high is not None:
            held = held & (v < F.lit(self.high))
        return held

    def ends(self) -> tuple[float, float]:
        """Sketch ranks around the wanted one; a short interval's sketch is exact."""
        at = (self.rank - self.before + 0.5) / self.inside
        slack = 0.0 if self.inside <= K else SLACK
        return max(at - slack, 0.0), min(at + slack, 1.0)

    def narrow(self, a, b, less: int, at_a: int, between: int, at_b: int, sketch: bytes) -> None:
        """Take the part that the exact counts say holds the rank, its ends or the middle."""
        k = self.rank - self.before
        if k < less:
            self.high, self.inside, self.sketch = a, less, None
        elif k < less + at_a:
            self.answer = a
        elif k < less + at_a + between:
            self.low, self.high, self.sketch = a, b, sketch
            self.before, self.inside = self.before + less + at_a, between
        elif k < less + at_a + between + at_b:
            self.answer = b
        else:
            passed = less + at_a + between + at_b
            self.low, self.sketch = b, None
            self.before, self.inside = self.before + passed, self.inside - passed
        if self.inside <= 0:
            raise ValueError(OTHER_ROWS)


def _typed(df: DataFrame, col: str) -> tuple[DataFrame, str]:
    """The values as ``v``, without nulls and NaN, and the kind of their sketch."""
    c = F.col(f"`{col}`")
    if isinstance(df.select(c).schema[0].dataType, _WHOLE):
        return df.select(c.cast("bigint").alias("v")).where("v IS NOT NULL"), "bigint"
    return df.select(c.cast("double").alias("v")).where("v IS NOT NULL AND NOT isnan(v)"), "double"


def _agg(kind: str, v: Column) -> Column:
    return getattr(F, f"kll_sketch_agg_{kind}")(v, F.lit(K))


def sketches(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """One sketch of ``col`` per group, such as a day: what :func:`quantiles` can start from."""
    typed, kind = _typed(df, col)
    if not by:
        return typed.agg(_agg(kind, F.col("v")).alias("sketch"))
    v = F.col(f"`{col}`").cast(kind)
    return df.groupBy(*by).agg(_agg(kind, v if kind == "bigint" else F.when(~F.isnan(v), v)).alias("sketch"))


def nth_values(values: DataFrame, kind: str, ranks: Sequence[int], n: int, sketch: bytes) -> dict[int, float]:
    """The values at the given ranks (from 0) of the ``n`` values ``v``, by bracket and exact count."""
    spark, v = values.sparkSession, F.col("v")
    quantile = getattr(F, f"kll_sketch_get_quantile_{kind}")
    searches = [_Search(rank, n, sketch) for rank in sorted(set(ranks))]
    while active := [s for s in searches if s.answer is None]:
        if lost := [s for s in active if s.sketch is None]:
            made = values.agg(*(c.alias(f"{name}{i}") for i, s in enumerate(lost) for name, c in (("n", F.count_if(s.holds(v))), ("s", _agg(kind, F.when(s.holds(v), v)))))).first()
            for i, s in enumerate(lost):
                if made[2 * i] != s.inside:
                    raise ValueError(OTHER_ROWS)
                s.sketch = bytes(made[2 * i + 1])
        asked = [quantile(F.lit(s.sketch), F.lit(float(r))).alias(f"q{i}_{j}") for i, s in enumerate(active) for j, r in enumerate(s.ends())]
        ends = spark.range(1).select(*asked).first()
        counts, pairs = [], []
        for i, s in enumerate(active):
            a, b = ends[2 * i], ends[2 * i + 1]
            held, middle = s.holds(v), (v > F.lit(a)) & (v < F.lit(b))
            pairs.append((a, b))
            counts += [
                F.count_if(held & (v < F.lit(a))),
                F.count_if(v == F.lit(a)),
                F.count_if(middle),
                F.count_if((v == F.lit(b)) & F.lit(a != b)),
                _agg(kind, F.when(middle, v)),
            ]
        seen = values.agg(*(c.alias(f"c{i}") for i, c in enumerate(counts))).first()
        for i, (s, (a, b)) in enumerate(zip(active, pairs)):
            *numbers, inner = seen[5 * i : 5 * i + 5]
            s.narrow(a, b, *numbers, bytes(inner))
    return {s.rank: s.answer for s in searches}


def quantiles(df: DataFrame, col: str, shares: Sequence[float], parts: DataFrame | None = None) -> list[float] | None:
    """Exact quantiles with linear interpolation; None without a value.

    A sketch of a few kilobytes brackets each rank, one pass counts what lies below, at and
    between the ends, and a sketch of what is inside brackets it again: a rank of 10^12
    values takes about five passes over one column, and every answer is counted, not estimated.
    ``parts`` are sketches of exactly these rows (:func:`sketches`, column ``sketch``), which
    are merged in place of the first pass. Nulls and NaN count as no value.
    """
    typed, kind = _typed(df, col)
    if parts is None:
        first = typed.agg(F.count("v").alias("n"), _agg(kind, F.col("v")).alias("sketch")).first()
    else:
        merged = parts.agg(getattr(F, f"kll_merge_agg_{kind}")("sketch", F.lit(K)).alias("sketch"))
        first = merged.select(getattr(F, f"kll_sketch_get_n_{kind}")("sketch").alias("n"), "sketch").first()
    if not first.n:
        return None
    places = [share * (first.n - 1) for share in shares]
    ranks = [r for p in places for r in (math.floor(p), math.ceil(p))]
    at = nth_values(typed, kind, ranks, first.n, bytes(first.sketch))
    out = []
    for p in places:
        low, high = math.floor(p), math.ceil(p)
        out.append(float(at[low]) if low == high else (high - p) * at[low] + (p - low) * at[high])
    return out
