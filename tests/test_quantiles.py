"""Exact quantiles from sketches against sorted lists."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from qaloom.operators import quantiles as Q
from qaloom.operators.curate import trim_quantiles

SHARES = [0.0, 0.05, 0.31, 0.5, 0.95, 1.0]


@pytest.mark.parametrize("kind", ["distinct", "ties", "edge", "large_ints", "short"])
def test_same_as_a_sorted_list(spark, kind):
    rng = random.Random(kind)
    n = 7 if kind == "short" else 60_000
    rows = {
        "distinct": lambda i: rng.random() * 1e6 - 5e5,
        "ties": lambda i: float(rng.choice([1, 1, 1, 2, 2, rng.random()])),
        # the rank of 0.5 is the last of many equal values
        "edge": lambda i: 3.0 if i <= n // 2 else 4.0 + rng.random(),
        "large_ints": lambda i: 2**60 + rng.randrange(10**9),
        "short": lambda i: rng.random(),
    }[kind]
    values = [rows(i) for i in range(n)]
    rng.shuffle(values)
    df = spark.createDataFrame([(x,) for x in values], "v bigint" if kind == "large_ints" else "v double").repartition(8)
    found = Q.quantiles(df, "v", SHARES)
    assert found == pytest.approx([float(x) for x in np.quantile(np.array(values), SHARES)], rel=1e-12)


def test_nth_values_are_exact_in_large_numbers(spark):
    values = [2**60 + 3 * i for i in range(30_000)]
    df = spark.createDataFrame([(x,) for x in values], "v bigint")
    sketch = bytes(Q.sketches(df, "v").first().sketch)
    ranks = [0, 1, 12_345, 29_999]
    assert Q.nth_values(df, "bigint", ranks, len(values), sketch) == {r: values[r] for r in ranks}


def test_merged_days_give_the_same(spark):
    df = spark.range(50_000).select((F.col("id") % 7).alias("day"), F.sin("id").alias("odd name"))
    days = Q.sketches(df, "odd name", ["day"])
    assert days.count() == 7
    assert Q.quantiles(df, "odd name", SHARES, days) == Q.quantiles(df, "odd name", SHARES)


def test_sketches_of_other_rows_are_refused(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("v"))
    with pytest.raises(ValueError):
        Q.quantiles(df.where("v < 10"), "v", [0.9], Q.sketches(df, "v"))


def test_nulls_nan_and_no_rows(spark):
    df = spark.createDataFrame([(1.0,), (None,), (math.nan,), (3.0,)], "v double")
    assert Q.quantiles(df, "v", [0.5]) == [2.0]
    assert Q.quantiles(df.limit(0), "v", [0.5]) is None
    assert trim_quantiles(df.limit(0), length="v").count() == 0
