"""Curation against plain loops over lists."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from qaloom.functions.text import is_qa
from qaloom.operators import curate, generate
from qaloom.operators.selection import split_exact
from qaloom.plans import jobs
from qaloom.plans.generation import extract
from qaloom.sources.pages import page_scan, page_summary

ORDER = ["doc_id", "page_ix", "attempt"]


@pytest.fixture(scope="module")
def candidates(spark):
    rng = random.Random(3)
    rows = []
    for i in range(600):
        # a third of all texts are copies of one
        text = "### Human: a ### Assistant: hot" if i % 3 == 0 else rng.choice(
            [f"### Human: {rng.randrange(150)} ### Assistant: x", "no markers", ""]
        )
        rows.append((i // 20, i % 20 // 4, i % 4, text))
    df = spark.createDataFrame(rng.sample(rows, len(rows)), "doc_id bigint, page_ix bigint, attempt bigint, response string")
    return df, sorted(rows)


def accepted(rows, cap):
    kept, seen = [], set()
    for row in rows:
        text = row[-1]
        if len(kept) < cap and "### Human:" in text and "### Assistant:" in text and text not in seen:
            seen.add(text)
            kept.append(row)
    return kept


@pytest.mark.parametrize("cap", [1, 17, 90, 1000])
def test_accept(candidates, cap):
    df, rows = candidates
    got = curate.accept(df, cap, ORDER).collect()
    assert sorted(tuple(r) for r in got) == accepted(rows, cap)


def test_accept_by_run(candidates):
    df, rows = candidates
    want = [r for d in range(30) for r in accepted([x for x in rows if x[0] == d], 3)]
    got = curate.accept(df, 3, ORDER, by=["doc_id"]).collect()
    assert sorted(tuple(r) for r in got) == want


def test_dedup_keeps_whole_rows(candidates):
    df, rows = candidates
    first = {}
    for r in rows:
        first.setdefault(r[-1], r)
    got = curate.dedup_first(df, "response", ORDER).collect()
    assert sorted(tuple(r) for r in got) == sorted(first.values())
    ids = curate.dedup_first(df, "response", ORDER, keep=["doc_id"]).collect()
    assert sorted(r[0] for r in ids) == sorted(r[0] for r in first.values())


def test_new_only(candidates):
    df, rows = candidates
    known = {r[-1] for r in rows if r[0] < 10}
    first = {}
    for r in rows:
        if r[0] >= 10 and r[-1] not in known:
            first.setdefault(r[-1], r)
    got = curate.new_only(df.where("doc_id >= 10"), df.where("doc_id < 10"), "response", ORDER)
    assert got.columns == df.columns
    assert sorted(tuple(r) for r in got.collect()) == sorted(first.values())


def test_pages(spark):
    docs = spark.createDataFrame([(1, "a\n \n\nb\x1c\n\x1c"), (2, "  \n"), (3, "x")], "doc_id bigint, text string")
    got = sorted(tuple(r) for r in page_scan(docs).collect())
    assert got == [(1, 1, 0, 2, "a"), (1, 4, 1, 2, "b\x1c"), (3, 1, 0, 1, "x")]
    stats = {r.doc_id: (r.pages_seen, r.pages_kept, r.pages_blank, r.chars) for r in page_summary(docs).collect()}
    assert stats == {1: (5, 2, 3, 3), 2: (2, 0, 2, 0), 3: (1, 1, 0, 1)}


@pytest.mark.parametrize("cap, per_page", [(1, 1), (7, 2), (9, 3)])
def test_fan_out(spark, cap, per_page):
    docs = spark.createDataFrame([(1, "a\nb"), (2, "c")], "doc_id bigint, text string")
    pages = page_scan(docs)
    assert curate.fan_out(pages, cap).count() == 3 * per_page
    own = curate.fan_out(pages, cap, "n_pages").groupBy("doc_id").count().collect()
    assert {r[0]: r[1] for r in own} == {1: 2 * max(1, cap // 2), 2: cap}


def test_compose_blocks(spark):
    rows = [(c, t, "user" if (t + c) % 2 else "assistant", f"{c}-{t}") for c in range(3) for t in range(11)]
    rows += [(9, 0, "user", "q"), (9, 1, "system", "s"), (9, 2, "assistant", "a"), (9, 3, "user", "open")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    whole, cut = (
        sorted((r.conv_id, r.turn, r.question, r.answer) for r in curate.compose_qa(df, span).collect())
        for span in (100_000, 2)
    )
    assert whole == cut
    assert not [r for r in whole if r[0] == 9]
    assert len(whole) == 5 + 5 + 5


def test_attainment(spark):
    df = spark.range(79)
    status = [curate.attainment(df, n).first()["status"] for n in (79, 90, 100)]
    assert status == ["reached", "near_target", "below_target"]


def test_split_union(spark):
    split = split_exact(spark.range(50), ["id"])
    both = curate.split_union(split)
    assert both.count() == 50 and both.select("id").distinct().count() == 50


# --- generation -----------------------------------------------------------------------


def test_errors_become_text(spark):
    df = spark.createDataFrame([("a.b",), ("none",), (None,)], "prompt string")
    got = [tuple(r) for r in generate.generate(df, extract).orderBy("prompt").collect()]
    failed = generate.ERROR_TEXT.format(error="no sentence")
    assert got == [
        (None, None, None),
        ("a.b", "### Human:\na?\n### Assistant:\nb", None),
        ("none", failed, "no sentence"),
    ]


def test_retry_replaces_even_when_worse(spark):
    def model(prompt):
        if "IMPORTANT" in prompt:
            return "worse"
        if prompt == "fine":
            return "### Human: q ### Assistant: " + "heap " * 30
        return "### Human: q ### Assistant: short" if prompt == "short" else "unmarked"

    df = spark.createDataFrame([("fine",), ("short",), ("plain",)], "prompt string")
    got = {r.prompt: (r.response, r.retried) for r in generate.generate_with_retry(df, model).collect()}
    assert got["short"] == ("worse", True)
    assert got["plain"] == ("unmarked", False)
    assert got["fine"][1] is False and got["fine"][0].startswith("### Human: q ### Assistant: heap")


@pytest.mark.parametrize("cap, factor", [(5, 1.5), (40, 0.4), (500, 1.5)])
def test_rounds_equal_one_go(spark, sf_dir, cap, factor):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    attempts = generate.candidates_of(page_scan(docs), cap, template="{text}").select(
        *[F.col(c).cast("bigint").alias(c) for c in ORDER], "prompt"
    )
    calls = spark.sparkContext.accumulator(0)

    def model(prompt):
        calls.add(1)
        return extract(prompt)

    got = generate.generate_until(attempts, model, cap, ORDER, factor=factor)
    rows = sorted((r.doc_id, r.page_ix, r.attempt, r.response) for r in got.collect())
    made = generate.generate_with_retry(attempts, extract).where(is_qa("response"))
    want = curate.accept(made, cap, ORDER).collect()
    assert rows == sorted((r.doc_id, r.page_ix, r.attempt, r.response) for r in want)
    assert calls.value <= 2 * attempts.count()
    if cap == 5:
        assert 0 < calls.value < attempts.count()


def test_generator_is_called_once_per_prompt(spark):
    calls = spark.sparkContext.accumulator(0)

    def model(prompt):
        calls.add(1)
        return f"### Human: {prompt} ### Assistant: " + "heap " * 30

    rows = [(1, 0, i, f"p{i}") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, page_ix bigint, attempt bigint, prompt string")
    got = generate.generate_until(df, model, 40, ORDER)
    assert got.count() == 40 and got.count() == 40 and calls.value == 40


def test_build_dataset(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    samples = jobs.build_dataset(docs, extract, 50, partitions=4, template="{text}")
    sizes = {r.split: r["count"] for r in samples.groupBy("split").count().collect()}
    assert sizes == {"train": 40, "test": 10}
    assert samples.select("text").distinct().count() == 50
    rows = jobs.prepare_training(samples, vocab_size=100, max_length=16)
    assert rows.count() == 50 and rows.selectExpr("min(size(input_ids))").first()[0] == 16


def test_ids_pass_a_python_generator_untouched(spark):
    big = 2**53 + 1
    rows = [(big, "p", [1], None), (None, "fine", None, 0.5), (big + 2, None, [], 1.5)]
    df = spark.createDataFrame(rows, "id bigint, prompt string, a array<int>, x double")
    got = generate.generate(df, lambda p: p.upper()).collect()
    assert [tuple(r) for r in got] == [(big, "p", [1], None, "P", None), (None, "fine", None, 0.5, "FINE", None), (big + 2, None, [], 1.5, None, None)]
    retried = generate.generate_with_retry(df, lambda p: "### Human: a ### Assistant: b").collect()
    assert sorted((r.id is None, r.id, r.retried) for r in retried) == [(False, big, True), (False, big + 2, False), (True, None, True)]


def test_second_calls_see_flagged_rows_only(spark):
    calls = spark.sparkContext.accumulator(0)

    def model(prompt):
        calls.add(1)
        return "### Human: a ### Assistant: b" if prompt == "bad" else "no markers"

    df = spark.createDataFrame([("bad",), ("good",), ("fine",)], "prompt string")
    made = generate.generate_with_retry(df, model)
    assert "Filter" in made._jdf.queryExecution().executedPlan().toString()
    assert len(made.collect()) == 3 and calls.value == 4


def test_pairs_over_gaps_in_turns(spark):
    rows = [(1, 10, "user", "a"), (1, 20, "assistant", "b"), (1, 30, "user", "c"), (1, 31, "system", "s"),
            (1, 32, "assistant", "d"), (None, 1, "user", "e"), (None, 7, "assistant", "f")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    for span in (1, 2, 100_000):
        got = {(r.conv_id, r.turn, r.question, r.answer) for r in curate.compose_qa(df, span).collect()}
        assert got == {(1, 10, "a", "b"), (None, 1, "e", "f")}


def test_std_of_lengths_far_from_zero(spark):
    df = spark.range(1000).select(F.lit("train").alias("split"), (F.lit(10**9) + F.col("id") % 2).alias("length"), F.lit(True).alias("is_valid"))
    row = curate.describe_by_split(df).first()
    assert row.length_std == pytest.approx(0.50025, abs=1e-5) and row.length_median == 10**9 + 0.5


def test_texts_stay_out_of_the_grouping(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    plan = curate.dedup_first(docs, "text", ["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "partial_min(" in plan
    assert "min_by" not in plan


def test_large_caps_per_run(spark):
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("run"), F.col("id").alias("attempt"),
        F.format_string("### Human: %d ### Assistant: x", "id").alias("response"),
    )
    got = curate.accept(df, 2000, ["attempt"], by=["run"], span=500)
    assert got.where("run = 0").agg(F.max("attempt"), F.count("*")).first()[:] == (5997, 2000) and got.count() == 8000
