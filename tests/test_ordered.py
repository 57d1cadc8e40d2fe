"""Numbering and neighbours must not depend on how keys are cut into blocks."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from qaloom.operators.ordered import number_rows, with_blocks, with_neighbours
from qaloom.operators import selection
from qaloom.operators.selection import after, nth_key, split_by_hash, split_exact, take_first


@pytest.fixture(scope="module")
def keyed(spark):
    rng = random.Random(1)
    rows = []
    # one key holds a third of the rows, with gaps in its order column
    for key, n in [(0, 120), (1, 1), (2, 80), (3, 80), (4, 79)]:
        rows += [(key, o) for o in rng.sample(range(1000), n)]
    return spark.createDataFrame(rows, "k int, o bigint"), rows


@pytest.mark.parametrize("span", [1, 7, 100_000])
def test_number_rows(keyed, span):
    df, rows = keyed
    want = {(k, o): sorted(x for j, x in rows if j == k).index(o) + 1 for k, o in rows}
    got = {(r.k, r.o): r.n for r in number_rows(df, ["k"], "o", "n", span).collect()}
    assert got == want


@pytest.mark.parametrize("span", [5, 100_000])
def test_neighbours(spark, span):
    df = spark.range(23).select(F.lit(1).alias("k"), F.col("id").alias("p"))
    near = with_neighbours(df, "p", back=3, ahead=2, span=span)
    blocks = {}
    for r in near.collect():
        blocks.setdefault(r["_block"], []).append((r.p, r["_own"]))
    assert sorted(p for b in blocks.values() for p, own in b if own) == list(range(23))
    for b in blocks.values():
        inside = {p for p, _ in b}
        for p, own in b:
            if own:
                assert {x for x in range(p - 3, p + 3) if 0 <= x < 23} <= inside


def test_neighbours_frame_fits():
    with pytest.raises(ValueError):
        with_neighbours(None, "p", back=9, span=5)


@pytest.fixture(scope="module")
def ordered(spark):
    rng = random.Random(2)
    rows = sorted({(rng.choice([7, 7, 7, rng.randrange(-50, 10**6)]), rng.randrange(10**4)) for _ in range(500)})
    shuffled = rng.sample(rows, len(rows))
    return spark.createDataFrame(shuffled, "a bigint, b bigint"), rows


def test_nth_key(ordered):
    df, rows = ordered
    for n in (1, 2, 137, len(rows) - 1, len(rows)):
        assert nth_key(df, ["a", "b"], n) == rows[n - 1]
    assert nth_key(df, ["a", "b"], len(rows) + 1) is None
    assert nth_key(df.limit(0), ["a", "b"], 1) is None


def test_take_first(ordered):
    df, rows = ordered
    got = sorted(tuple(r) for r in take_first(df, ["a", "b"], 200).collect())
    assert got == rows[:200]
    assert take_first(df, ["a", "b"], 10**5).count() == len(rows) and take_first(df, ["a", "b"], 0).count() == 0
    rest = sorted(tuple(r) for r in df.where(after(df, ["a", "b"], rows[199])).collect())
    assert rest == rows[200:]


@pytest.mark.parametrize("few, buckets", [(0, 4), (3, 2), (0, 4096), (10**6, 4096)])
def test_radix_finds_every_key(spark, monkeypatch, few, buckets):
    rng = random.Random(4)
    values = [None, 0, -1, 1, -(2**63), 2**63 - 1, 7, 7, 7]
    rows = [(rng.choice(values), rng.choice([None, 1, 2, -5])) for _ in range(60)]
    df = spark.createDataFrame(rows, "a bigint, b int").coalesce(1).cache()
    monkeypatch.setattr(selection, "FEW", few)
    monkeypatch.setattr(selection, "BUCKETS", buckets)
    by = sorted(rows, key=lambda r: [(v is not None, v or 0) for v in r])
    for n in (1, 5, 33, 60):
        found = selection._by_radix(df, n)
        assert found == (by[n - 1], by.index(by[n - 1]), by.count(by[n - 1]))
    assert selection._by_radix(df, 61) is None and selection._by_radix(df, 0) is None


def test_integer_keys_are_not_sorted(spark, monkeypatch):
    monkeypatch.setattr(selection, "ranked_keys", None)
    df = spark.range(100).withColumnRenamed("id", "sample_id")
    for picked in (split_exact(df, ["sample_id"]), take_first(df, ["sample_id"], 7)):
        assert "rangepartitioning" not in picked._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("kind", ["bigint", "string", "double", "timestamp"])
def test_take_first_with_ties_nulls_and_equal_rows(spark, kind):
    rows = [(None, 1), (None, 2), (3, 1), (3, 1), (3, 1), (3, 2), (5, None), (7, 0)]
    df = spark.createDataFrame(rows, "a bigint, b bigint").withColumn("a", F.col("a").cast(kind))
    order = df.select(F.col("a").cast("string").alias("a"), "b").collect()
    for n in range(10):
        got = take_first(df, ["a"], n).select(F.col("a").cast("string").alias("a"), "b").collect()
        assert len(got) == min(n, 8)
        # all rows with smaller keys, and of the last key only as many as there is room for
        ranks = sorted((r.a is not None, float(r.a) if kind != "timestamp" and r.a else str(r.a)) for r in got)
        want = sorted((r.a is not None, float(r.a) if kind != "timestamp" and r.a else str(r.a)) for r in order)
        assert ranks == want[:n]


@pytest.mark.parametrize("n, n_test", [(0, 0), (1, 1), (4, 1), (101, 21), (200, 40)])
def test_split_exact(spark, n, n_test):
    df = spark.range(n).withColumnRenamed("id", "sample_id")
    parts = [
        {(r.sample_id, r.split) for r in split_exact(d, ["sample_id"]).collect()}
        for d in (df, df.repartition(13))
    ]
    assert parts[0] == parts[1]
    assert len(parts[0]) == n and sum(s == "test" for _, s in parts[0]) == n_test
    other = split_exact(df, ["sample_id"], seed=7).collect()
    assert n < 100 or {(r.sample_id, r.split) for r in other} != parts[0]


def test_split_exact_of_equal_rows(spark):
    df = spark.range(10).select((F.col("id") % 1).alias("sample_id"))
    assert sorted(r.split for r in split_exact(df, ["sample_id"]).collect()) == ["test"] * 2 + ["train"] * 8


def test_no_row_is_lost(spark):
    rows = [(None, 1), (None, None), (1, None), (1, 10**12), (1, 5)]
    df = spark.createDataFrame(rows, "k bigint, o bigint")
    for span in (1, 100):
        got = sorted(((r.k, r.o, r.n) for r in number_rows(df, ["k"], "o", "n", span).collect()), key=repr)
        assert got == sorted([(None, None, 1), (None, 1, 2), (1, None, 1), (1, 5, 2), (1, 10**12, 3)], key=repr)


def test_sparse_orders_make_few_blocks(spark):
    # milliseconds, one key with a third of the rows
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        (F.lit(1_700_000_000_000) + F.col("id") * 977_777).alias("o"),
    )
    blocks = with_blocks(df, ["k"], "o", span=100).groupBy("k", "_block").count()
    hot = [r["count"] for r in blocks.where("k = 0").collect()]
    assert 8 <= len(hot) <= 13 and max(hot) <= 130 and blocks.where("k <> 0").count() == 2000


def test_a_key_with_one_order_value_is_split(spark):
    # an order column that is tied or null throughout: the row's hash cuts it
    df = spark.range(2000).select(F.lit(1).alias("k"), F.lit(None).cast("bigint").alias("o"), F.col("id").alias("v"))
    sizes = [r["count"] for r in with_blocks(df, ["k"], "o", span=100).groupBy("_block").count().collect()]
    assert sum(sizes) == 2000 and max(sizes) <= 100 and 20 <= len(sizes) <= 30
    tied = df.withColumn("o", F.lit(3))
    small, large = (number_rows(tied, ["k"], "o", "n", span).collect() for span in (100, 10**6))
    assert sorted((r.v, r.n) for r in small) == sorted((r.v, r.n) for r in large)
    assert sorted(r.n for r in small) == list(range(1, 2001))


def test_cuts_follow_all_order_columns(spark):
    # few pages, many attempts: blocks are cut inside a page, in the order of attempts
    df = spark.range(1000).select(F.lit("r").alias("k"), (F.col("id") % 2).alias("a"), F.col("id").cast("string").alias("b"))
    got = number_rows(df, ["k"], ["a", "b"], "n", span=64).orderBy("n").collect()
    rows = [(r.a, r.b) for r in got]
    assert rows == sorted(rows) and [r.n for r in got] == list(range(1, 1001))


def test_split_by_hash_is_about_right(spark):
    df = split_by_hash(spark.range(5000), ["id"])
    assert 850 < df.where("split = 'test'").count() < 1150
